import re
from datetime import datetime as D

from tessera.llm import url_filters

ENTRIES = "kind string, pattern string, category string, action string, at timestamp"


def entries(spark, rows):
    return spark.createDataFrame(rows, ENTRIES)


def test_intervals(spark):
    log = [("host", "A.com", "x", "add", D(2024, 1, 1)), ("host", "a.com", "x", "add", D(2024, 1, 5)),
           ("host", "a.com", "x", "remove", D(2024, 2, 1)), ("host", "a.com", "x", "remove", D(2024, 2, 5)),
           ("host", "a.com", "x", "add", D(2024, 3, 1)), ("host", "b.com", None, "remove", D(2024, 1, 1)),
           ("host", "c.com", None, "add", D(2024, 1, 1)), ("host", "c.com", None, "remove", D(2024, 1, 1)),
           (None, "c.com", "x", "add", D(2024, 1, 1)), ("host", None, "x", "add", D(2024, 1, 1)),
           ("host", "d.com", "x", None, D(2024, 1, 1)), ("host", "d.com", "x", "add", None)]
    got = sorted(tuple(r) for r in url_filters.validity_intervals(entries(spark, log + log)).collect())
    assert got == [("host:a.com", "x", D(2024, 1, 1), D(2024, 2, 1)), ("host:a.com", "x", D(2024, 3, 1), D(9999, 12, 31))]


def test_as_of_join(spark):
    log = entries(spark, [("domain", "bad.com", "spam", "add", D(2024, 1, 10)), ("domain", "bad.com", "spam", "remove", D(2024, 6, 1)),
                          ("host", "www.ok.org", "adult", "add", D(2024, 2, 1)), ("path", "ok.org/a/b", "spam", "add", D(2024, 2, 1)),
                          ("path", "ok.org/a", "malware", "add", D(2024, 2, 1))])
    rows = [(1, "http://x.BAD.com./p", D(2024, 1, 10)), (2, "http://x.bad.com/p", D(2024, 1, 9)), (3, "https://bad.com", D(2024, 5, 31)),
            (4, "http://bad.com/", D(2024, 6, 1)), (5, "http://notbad.com/", D(2024, 3, 1)), (6, "http://www.ok.org/", D(2024, 3, 1)),
            (7, "http://u@ok.org:80/a/b/c?q", D(2024, 3, 1)), (8, "http://ok.org/ab", D(2024, 3, 1)), (9, None, D(2024, 3, 1)),
            (10, "http://bad.com", None), (11, "no url", D(2024, 3, 1)), (12, "", D(2024, 3, 1)), (1, "http://x.BAD.com./p", D(2024, 1, 10))]
    caps = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, fetched_at timestamp, key string")
    out = url_filters.filter_urls(caps, log, id_cols=["page_id"])
    got = sorted((r.page_id, r.n_entries, r.categories, r.blocked) for r in out.collect())
    want = {1: (1, "spam"), 3: (1, "spam"), 6: (1, "adult"), 7: (2, "malware,spam")}
    assert got == sorted((r[0], *want.get(r[0], (0, "")), r[0] in want) for r in rows)
    assert url_filters.filter_urls(caps.limit(0), log, id_cols=["page_id"]).count() == 0
    assert url_filters.filter_urls(caps, log.limit(0), id_cols=["page_id"]).where("blocked").count() == 0
    assert not re.search("Python|Pandas|Arrow|Cartesian", out._jdf.queryExecution().toString())


def test_paths_keep_their_case(spark):
    log = entries(spark, [("path", "OK.org/News", "spam", "add", D(2024, 1, 1)), ("path", "ok.org/news", "adult", "add", D(2024, 2, 1)),
                          ("path", "ok.org/news", "adult", "remove", D(2024, 3, 1))])
    rows = [(1, "http://ok.ORG/News/a", D(2024, 4, 1)), (2, "http://ok.org/news", D(2024, 2, 5)), (3, "http://ok.org/news", D(2024, 4, 1)),
            (4, "http://ok.org/NEWS", D(2024, 2, 5))]
    caps = spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp")
    got = {r.page_id: r.categories for r in url_filters.filter_urls(caps, log, id_cols=["page_id"]).collect()}
    assert got == {1: "spam", 2: "adult", 3: "", 4: ""}


def test_deep_entries(spark):
    deep, path = ".".join("abcdefghijkl"), "/".join("abcdefghijklmnop")
    log = entries(spark, [("domain", deep, "spam", "add", D(2024, 1, 1)), ("path", f"ok.org/{path}", "adult", "add", D(2024, 1, 1))])
    rows = [(1, f"http://www.{deep}/x", D(2024, 2, 1)), (2, f"http://{deep[2:]}/x", D(2024, 2, 1)),
            (3, f"http://ok.org/{path}/q/r", D(2024, 2, 1)), (4, f"http://ok.org/{path[:-2]}", D(2024, 2, 1))]
    caps = spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp")
    got = {r.page_id: r.categories for r in url_filters.filter_urls(caps, log, id_cols=["page_id"]).collect()}
    assert got == {1: "spam", 2: "", 3: "adult", 4: ""}
    hosts = log.where("kind = 'path'").selectExpr("'host' as kind", "'ok.org' as pattern", "category", "action", "at")
    got = {r.page_id: r.categories for r in url_filters.filter_urls(caps, hosts, id_cols=["page_id"]).collect()}
    assert got == {1: "", 2: "", 3: "adult", 4: "adult"}
