"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.columns import ID_CLOSE, ID_OPEN, TEXT_OPEN


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Headerless CSV with inferred column types (``_c0`` .. ``_cN``).

    Inference costs an extra pass over the input; on large inputs prefer
    ``read_csv_schema`` with a declared schema.
    """
    return spark.read.csv(path, header=False, inferSchema=True, sep=sep)


def read_csv_schema(spark: SparkSession, path: str, schema: StructType,
                    sep: str = ",", header: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """CSV with a fixed schema; cells that do not parse become null (PERMISSIVE).

    ``corrupt_col`` adds a column with the whole line of every record that has
    such a cell, or more or fewer cells than the schema, and null for the rest.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt_col is not None:
        schema = StructType([*schema.fields, StructField(corrupt_col, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).csv(path, sep=sep, header=header)


def read_text(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """One record per line, column ``value``.  ``line_sep`` lets records
    carry embedded newlines (they are written with the same separator)."""
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)


def write_text(df: DataFrame, path: str, line_sep: str | None = None) -> None:
    """Write a single string column as text, one record per ``line_sep``."""
    writer = df.write.mode("overwrite")
    if line_sep is not None:
        writer = writer.option("lineSep", line_sep)
    writer.text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=header)


def write_small_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Single-file sink, only for results already bounded by a limit or an
    aggregate (``coalesce(1)`` funnels every row through one task)."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def parse_links(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``"PAGE","CATEGORY"`` lines -> (page, category): first two comma
    fields with double quotes removed; a category containing a comma is cut
    at that comma."""
    parts = F.split(F.col(value_col), ",")
    return lines.select(
        F.replace(parts.getItem(0), F.lit('"'), F.lit("")).alias("page"),
        F.replace(F.get(parts, 1), F.lit('"'), F.lit("")).alias("category"),
    ).where(F.col("category").isNotNull())


def doc_lines(docs: DataFrame, id_col: str, text_col: str, url_col: str) -> DataFrame:
    """Render documents as corpus lines ``<doc id="ID" url="URL">TEXT</doc>``."""
    return docs.select(F.concat(
        F.lit("<doc " + ID_OPEN), F.col(id_col).cast("string"), F.lit(ID_CLOSE + '"'),
        F.col(url_col).cast("string"), F.lit(TEXT_OPEN), F.col(text_col), F.lit("</doc>"),
    ).alias("value"))
