import numpy as np
import pytest

from tessera.llm import line_dedup
from tests.llm import brute
from tests.llm.brute import order_key


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_against_brute_force(docs, corpus, window):
    want = brute.line_dedup(corpus, window)
    clash = docs.withColumnRenamed("lang", "fp").withColumnRenamed("source", "starts").withColumnRenamed("n_chars", "D")
    out = line_dedup.drop_repeated_runs(clash, window=window, removed_col="gone")
    assert out.columns == [*clash.columns, "gone"]
    got = sorted((order_key(r.doc_id), r.text or "") for r in out.collect())
    assert got == sorted((order_key(r[0]), want[order_key(r[0]), r[1]] or "") for r in corpus)


def test_window_unlike_the_first_position(spark):
    """The run of documents 2 and 3 shares its fingerprints with document 1, whose neighbours differ."""
    rows = [(1, "x\nA\ny"), (2, "p\nA\nq\nA\nr"), (3, "p\nA\nq\nA\nr"), (4, "q\nA\nr\nz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_runs(docs, window=3).collect()}
    assert got == {1: "x\nA\ny", 2: "p\nA\nq\nA\nr", 3: "", 4: "z"}


def test_null_and_empty(spark, empty):
    assert line_dedup.drop_repeated_runs(empty).count() == 0
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "\n\n")], "doc_id long, text string")
    assert sorted(line_dedup.drop_repeated_runs(docs).collect()) == [(1, None), (2, ""), (3, "\n\n")]


def test_winnow_takes_the_rightmost_minimum():
    assert line_dedup.winnow(np.array([3, 1, 1, 5, 9]), 3).tolist() == [2, 2, 2]
    assert line_dedup.winnow(np.array([3, 1]), 3).tolist() == []


def plain_runs(rows, window, long_words):
    """id -> text after dedup, all lines non-blank and ids in order."""
    seen, out = set(), {}
    for d, text in rows:
        lines = text.split("\n")
        dead = set()
        for n in range(1, window + 1):
            for s in range(len(lines) - n + 1):
                run = tuple(lines[s:s + n])
                goes = n == window or n == len(lines) or sum(len(x.split()) for x in run) > long_words
                if run in seen and goes:
                    dead |= set(range(s, s + n))
                seen.add(run)
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in dead)
    return out


def test_short_runs_that_are_long_in_words_and_whole_texts(spark):
    def line(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))

    rows = [(1, "\n".join(("a", line("l", 51), "b"))), (2, "\n".join(("c", line("l", 51), "d"))),
            (3, "\n".join(("e", line("m", 50), "f"))), (4, "\n".join(("g", line("m", 50), "h"))),
            (5, "\n".join(("i", line("p", 30), line("q", 30), "j"))), (6, "\n".join(("k", line("p", 30), line("q", 30), "l"))),
            (7, "\n".join((line("q", 30), line("p", 30), "m"))), (8, "one line"), (9, "one line"), (10, "two\nlines"),
            (11, "two\nlines"), (12, "lines\ntwo"), (13, "f"), (14, "f\nn\no"), (15, "n\no"), (16, line("l", 51))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = line_dedup.drop_repeated_runs(docs, window=3, long_words=50, removed_col="gone").collect()
    got = {r.doc_id: r.text for r in out}
    assert got == plain_runs(rows, 3, 50)
    assert (got[2], got[4], got[6], got[9], got[11], got[12]) == ("c\nd", rows[3][1], "k\nl", "", "", "lines\ntwo")
    assert (got[13], got[14], got[15], got[16]) == ("", "f\nn\no", "", "")
    assert {r.doc_id: r.gone for r in out}[6] == [1, 2]


def test_short_runs_against_plain_code(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "\n".join(" ".join("ab"[b] for b in rng.integers(0, 2, rng.integers(1, 5))) for _ in range(rng.integers(1, 6))))
            for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for window in (2, 3, 4):
        got = {r.doc_id: r.text for r in line_dedup.drop_repeated_runs(docs, window=window, long_words=6).collect()}
        assert got == plain_runs(rows, window, 6)


def test_the_query_takes_a_long_line_and_a_short_text(spark, tmp_path):
    from tessera.llm import queries
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"a\n{line}\nb"), (2, f"c\n{line}\nd"), (3, "short text"), (4, "short text")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.text, r.n_removed) for r in queries.op1_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("c\nd", 1), 3: ("short text", 0), 4: ("", 1)}
