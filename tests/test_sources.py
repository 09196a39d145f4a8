from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tessera.operators import text
from tessera.session import scratch_path
from tessera.sources import files


def test_csv_permissive_bad_cell_is_null(spark):
    path = scratch_path(spark, "csv-test")
    spark.createDataFrame([("1", "a", "2.5"), ("x", "b", "oops")], "a string, b string, c string") \
        .write.csv(path)
    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()),
                         StructField("v", DoubleType())])
    got = sorted(files.read_csv_schema(spark, path, schema).collect(), key=lambda r: r.name)
    assert [tuple(r) for r in got] == [(1, "a", 2.5), (None, "b", None)]


def test_csv_inferred_types(spark):
    path = scratch_path(spark, "csv-test")
    spark.createDataFrame([(1, "a", 2.5)], "a int, b string, c double").write.csv(path)
    df = files.read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "string", "double"]


def test_text_roundtrip_keeps_newlines(spark):
    docs = spark.createDataFrame([(1, "line one\nline two", "u")], "doc_id long, text string, url string")
    path = scratch_path(spark, "text-test")
    files.write_text(files.doc_lines(docs, "doc_id", "text", "url"), path, "\u001e")
    parsed = text.parse_docs(files.read_text(spark, path, "\u001e"))
    assert [tuple(r) for r in parsed.collect()] == [("1", "line one\nline two")]


def test_small_result_sink_single_file(spark):
    import glob
    path = scratch_path(spark, "sink-test")
    files.write_small_result(spark.range(5).repartition(3), path, "csv")
    assert len(glob.glob(path.replace("file:", "") + "/part-*")) == 1


def test_corrupt_records(spark, tmp_path):
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
    (tmp_path / "x.csv").write_text("1,2.5\nx,3.0\n2\n3,4.0,5\n4,\n")
    schema = StructType([StructField("a", IntegerType()), StructField("b", DoubleType())])
    got = [tuple(r) for r in files.read_csv_schema(spark, str(tmp_path), schema, corrupt_col="bad").collect()]
    assert got == [(1, 2.5, None), (None, 3.0, "x,3.0"), (2, None, "2"), (3, 4.0, "3,4.0,5"), (4, None, None)]
    assert files.read_csv_schema(spark, str(tmp_path), schema).columns == ["a", "b"]
