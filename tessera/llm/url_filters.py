"""URL filters against dated lists, with DataFrame functions only.

A list is a log of dated entries that add or remove a pattern.  The log becomes
validity intervals per pattern, and an as-of join evaluates every capture
against the entries active at the time it was fetched.

A pattern is a host (``host``: that host only), a domain (``domain``: the host
and all hosts below it) or a host with the beginning of a path (``path``: whole
path segments).  All three become equality keys of a capture, so the join is by
key and, lest a key with many entries meet a host with many captures, by a
slice of time: an interval is listed under every slice that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_DAYS = 32
FOREVER = "9999-12-31 00:00:00"

# The parts of a URL.
HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL without a trailing dot; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST_PATTERN, 1)), F.lit("."))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH_PATTERN, 1)


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def _depths(entries: DataFrame) -> DataFrame:
    """One row: the most labels of a listed domain and the most segments of a listed path, its host included."""
    def most(kind: str, levels: Column) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == kind, levels)), F.lit(0))

    return entries.agg(most("domain", F.size(F.split("pattern", r"\."))).alias("labels"),
                       most("path", F.size(_segments(F.col("pattern")))).alias("segments"))


def _lookup_keys(host: Column, path: Column, most_labels: Column, most_segments: Column) -> Column:
    """Keys under which a capture can be listed: its host, the domains above
    it, and every leading run of its path's segments, as deep as the list goes."""
    def upto(n: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), n), lambda k: k > 0)

    labels, parts = F.split(host, r"\."), _segments(path)
    domains = F.transform(upto(F.least(F.size(labels), most_labels)),
                          lambda n: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, -n, n), ".")))
    paths = F.transform(upto(F.least(F.size(parts), most_segments)),
                        lambda n: F.concat(F.lit("path:"), host, F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.concat(F.array(F.concat(F.lit("host:"), host)), domains, paths))


def _pattern_key() -> Column:
    """A pattern as the lookup keys have it: hosts in lower case, a path as it is written."""
    host, rest = (F.regexp_extract("pattern", "(?s)^([^/]*)(.*)$", k) for k in (1, 2))
    return F.when(F.col("kind") == "path", F.concat(F.lower(host), rest)).otherwise(F.lower("pattern"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(key, category, valid_from, valid_to)`` from the log ``entries(kind,
    pattern, category, action, at)``: from an ``add`` up to the next entry of
    the same pattern and category, or for ever.

    Of several entries at the same time a ``remove`` counts.  An ``add`` while
    active goes on; a ``remove`` while inactive does nothing.  Entries with a
    null in kind, pattern, action or time are void; a null category is the
    category ``''``.  Hosts have no case, paths have.
    """
    log = entries.where("kind is not null and pattern is not null and action is not null and at is not null").select(
        F.concat_ws(":", "kind", _pattern_key()).alias("key"), F.coalesce("category", F.lit("")).alias("category"),
        "at", (F.col("action") == "add").alias("adds"))
    once = log.groupBy("key", "category", "at").agg(F.min("adds").alias("adds"))
    turn = Window.partitionBy("key", "category").orderBy("at")
    edges = once.withColumn("before", F.coalesce(F.lag("adds").over(turn), F.lit(False))).where("adds <> before")
    return (edges.withColumn("valid_to", F.coalesce(F.lead("at").over(turn), F.lit(FOREVER).cast("timestamp")))
            .where("adds").select("key", "category", F.col("at").alias("valid_from"), "valid_to"))


def _slice(at: Column) -> Column:
    return F.floor(F.datediff(at, F.lit("1970-01-01").cast("date")) / F.lit(SLICE_DAYS)).cast("int")


def filter_urls(captures: DataFrame, entries: DataFrame, *, url_col: str = "url", time_col: str = "fetched_at",
                id_cols: list[str]) -> DataFrame:
    """One row per capture: ``id_cols``, ``host``, ``n_entries`` active entries
    that match, ``categories`` (theirs, sorted, comma-joined) and ``blocked``.

    A capture at the very start of an interval is inside, at its end outside.
    A null or hostless URL or a null time matches nothing.  Captures are rows:
    repeated ones count each, as long as they are equal in ``id_cols``, URL and
    time they give equal rows.  Empty lists block nothing; empty captures give
    no rows.  Hosts and paths are looked up to the depth of the deepest entry.
    """
    cap = captures.select(*[F.col(c).alias(f"_id{i}") for i, c in enumerate(id_cols)],
                          F.col(url_col).alias("_url"), F.col(time_col).alias("_at"))
    distinct = cap.select("_url", "_at").where("_url is not null and _at is not null").distinct()
    keyed = distinct.join(F.broadcast(_depths(entries))).select("_url", "_at", F.explode(_lookup_keys(     # one row
        host_of(F.col("_url")), path_of(F.col("_url")), F.col("labels"), F.col("segments"))).alias("key"))
    # intervals end with the last capture, so the slices of one without an end stay few
    span = cap.agg(F.min("_at").alias("lo"), F.max("_at").alias("hi"))
    listed = (validity_intervals(entries).join(F.broadcast(span))       # one row
              .where("valid_from <= hi and valid_to > lo")
              .withColumn("slice", F.explode(F.sequence(_slice(F.greatest("valid_from", "lo")),
                                                        _slice(F.least("valid_to", "hi"))))).drop("lo", "hi"))
    hits = (keyed.withColumn("slice", _slice(F.col("_at"))).join(listed, ["key", "slice"])
            .where("_at >= valid_from and _at < valid_to")
            .groupBy("_url", "_at").agg(F.count("*").alias("n"), F.collect_set("category").alias("cats")))
    out = cap.join(hits, ["_url", "_at"], "left")
    n = F.coalesce("n", F.lit(0).cast("long"))
    return out.select(*[F.col(f"_id{i}").alias(c) for i, c in enumerate(id_cols)], host_of(F.col("_url")).alias("host"),
                      n.alias("n_entries"), F.coalesce(F.array_join(F.array_sort("cats"), ","), F.lit("")).alias("categories"),
                      (n > 0).alias("blocked"))


# ------------------------------------------------------------- the registered query's inputs
# ``pages`` has neither fetch times nor a list.  A page's fetch time follows
# from its id; the list is a log over the table's own hosts, domains and first
# path segments, whose dates and actions follow from an MD5 of the pattern.

EPOCH = "2024-01-01"
DAYS = 365


def captures_of(pages: DataFrame) -> DataFrame:
    at = F.timestamp_add("HOUR", F.pmod(F.coalesce("page_id", F.lit(0).cast("long")) * 7, F.lit(24 * DAYS)).cast("int"),
                         F.lit(EPOCH).cast("timestamp"))
    return pages.select("page_id", "url", at.alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    host = host_of(F.col("url"))
    first = F.regexp_extract(path_of(F.col("url")), "^/([^/]+)", 1)
    patterns = (pages.select(host.alias("h"), first.alias("p")).where("h <> ''").distinct()
                .select(F.explode(F.array(
                    F.struct(F.lit("host").alias("kind"), F.col("h").alias("pattern")),
                    F.struct(F.lit("domain").alias("kind"), F.regexp_replace("h", r"^[^.]*\.", "").alias("pattern")),
                    F.struct(F.lit("path").alias("kind"), F.concat("h", F.lit("/"), "p").alias("pattern")))).alias("e"))
                .select("e.kind", "e.pattern").distinct())
    code = F.conv(F.substring(F.md5(F.concat_ws(":", "kind", "pattern").cast("binary")), 1, 8), 16, 10).cast("long")
    coded = patterns.withColumn("c", code)
    # a quarter of the patterns are listed, each with four entries: add, remove, add, remove
    step = F.explode(F.sequence(F.lit(0), F.lit(3)))
    day = (F.col("c") % 120 + F.col("i") * (F.lit(30) + F.col("c") % 53)).cast("int")
    return coded.where("c % 4 = 0").withColumn("i", step).select(
        "kind", "pattern", F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")),
                                        (F.col("c") % 3 + 1).cast("int")).alias("category"),
        F.when(F.col("i") % 2 == 0, "add").otherwise("remove").alias("action"),
        F.timestamp_add("DAY", day, F.lit(EPOCH).cast("timestamp")).alias("at"))


ORACLE_SQL = r"""
WITH pg AS (
  SELECT page_id, url,
         rtrim(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.') AS host,
         regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) AS path,
         ((coalesce(page_id, 0) * 7 % 8760) + 8760) % 8760 AS hour
  FROM pages),
pat AS (
  SELECT 'host:' || host AS key FROM pg WHERE host <> ''
  UNION SELECT 'domain:' || regexp_replace(host, '^[^.]*\.', '') FROM pg WHERE host <> ''
  UNION SELECT 'path:' || host || '/' || regexp_extract(path, '^/([^/]+)', 1) FROM pg WHERE host <> ''),
coded AS (SELECT key, CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) AS c FROM pat),
iv AS (
  SELECT key, ['adult', 'malware', 'spam'][c % 3 + 1] AS category,
         24 * (c % 120 + i * (30 + c % 53)) AS lo, 24 * (c % 120 + (i + 1) * (30 + c % 53)) AS hi
  FROM coded, (SELECT unnest([0, 2]) AS i) WHERE c % 4 = 0),
parts AS (
  SELECT page_id, url, host, hour, string_split(host, '.') AS labels,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS segs FROM pg WHERE host <> ''),
keys AS (
  SELECT DISTINCT url, hour, 'host:' || host AS key FROM parts
  UNION SELECT url, hour, 'domain:' || array_to_string(labels[-n:], '.')
  FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS n FROM parts)
  UNION SELECT url, hour, 'path:' || host || '/' || array_to_string(segs[:n], '/')
  FROM (SELECT *, unnest(range(1, len(segs) + 1)) AS n FROM parts)),
hits AS (
  SELECT url, hour, count(*) AS n, string_agg(DISTINCT category, ',' ORDER BY category) AS cats
  FROM keys JOIN iv USING (key) WHERE hour >= lo AND hour < hi GROUP BY url, hour)
SELECT page_id, host, coalesce(n, 0) AS n_entries, coalesce(cats, '') AS categories, coalesce(n, 0) > 0 AS blocked
FROM pg LEFT JOIN hits ON pg.url = hits.url AND pg.hour = hits.hour
"""
