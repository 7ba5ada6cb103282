"""URL filters whose lists change over time: every capture against what was listed when it was fetched.

Entries are dated: on a day, a key (a domain, or a host with the start of a path) joins or leaves the
blocking or the allowing list. The dated entries of a key become disjoint validity intervals. A capture
has a key for its host, each parent domain and each leading part of its path; an as-of join finds
for each the interval that its time lies in. Of the keys listed at that time the longest decides, and
on the same key an allowing entry beats a blocking one.

The intervals of a key are one row, an ordered list as long as the number of days on which the key
changed, so the as-of join is an equi-join on the key that makes no more rows than the captures have
keys, followed by a search of that list. Frequent keys are broadcast, see ``lookup``.

Defined results: on one day a key that both leaves and joins a list is on it from that day; repeated
entries and entries that change nothing have no effect; entries without key, day, list or action are
left out; an interval holds from its day up to, not including, the day of leaving; a capture without
url, host or time has the verdict ``none``; repeated captures each get their row; an empty list gives
``none`` throughout, empty captures an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import lookup, table
from tidegrid.session import materialise

#: Scheme, optional user, host; the port is left out.
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[^/]*//[^/?#]+(/[^?#]*)"
#: Equal captures that one row stands for.
COPIES = 10_000


def validity(entries: DataFrame) -> DataFrame:
    """Each key with its intervals, for entries ``key``, ``list`` (block, allow), ``action`` (add, remove), ``day``.

    What happens to a key on a day is one row before anything is ordered.
    """
    days = (
        entries.filter("key IS NOT NULL AND day IS NOT NULL AND list IN ('block', 'allow') AND action IN ('add', 'remove')")
        .groupBy("key", "list", "day").agg(F.max(F.col("action") == "add").alias("on"))
    )
    changes = days.selectExpr("*", "lag(on) OVER (PARTITION BY key, list ORDER BY day) AS was").filter(
        "on <> coalesce(was, false)"
    )
    spans = changes.selectExpr(
        "*", "lead(day) OVER (PARTITION BY key, list ORDER BY day) AS until"
    ).filter("on")
    return spans.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct(F.col("day").alias("since"), "until", "list"))).alias("spans")
    )


def capture_keys(url: str) -> str:
    """SQL for the keys of a url: host, parent domains down to two labels, host with leading parts of the path."""
    low = f"lower({url})"
    host = f"regexp_extract({low}, r'{HOST}', 1)"
    labels = f"split({host}, '[.]')"
    parts = f"split(regexp_extract({url}, r'{PATH}', 1), '/')"
    return (
        f"CASE WHEN {host} <> '' THEN array_distinct(concat("
        f"transform(sequence(1, greatest(size({labels}) - 1, 1)), i -> array_join(slice({labels}, i, size({labels})), '.')),"
        f"transform(filter(sequence(2, greatest(size({parts}), 2)), i -> i <= size({parts}) AND get({parts}, i - 1) <> ''),"
        f" i -> concat({host}, array_join(slice({parts}, 1, i), '/'), '/')))) END"
    )


def evaluate(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """``id``, ``url``, ``at`` of every capture with ``verdict``, the deciding ``key`` and since when it is listed."""
    once = captures.select("id", "url", "at").groupBy("id", "url", "at").agg(F.count("*").alias("copies"))
    keyed = materialise(
        once.withColumn("keys", F.expr(capture_keys("url"))).select("id", "url", "at", "copies", F.explode_outer("keys").alias("key")),
        "capture-keys",
    )
    used = keyed.groupBy("key").agg(F.count("*").alias("n"))
    listed = materialise(intervals.join(used, "key"), "listed")
    met = lookup(keyed, listed, "key", F.col("n"))
    active = met.withColumn(
        "span",
        # allow sorts before block, and a list's intervals do not overlap: the first that holds decides
        F.expr("try_element_at(array_sort(transform(filter(spans, s -> s.since <= at AND (s.until IS NULL OR at < s.until)),"
               " s -> struct(s.list AS list, s.since AS since))), 1)"),
    )
    decided = active.groupBy("id", "url", "at", "copies").agg(
        F.max(F.when(F.col("span").isNotNull(), F.struct(F.length("key").alias("size"), "key", "span"))).alias("best")
    )
    verdicts = decided.select(
        "id", "url", "at", F.coalesce("best.span.list", F.lit("none")).alias("verdict"),
        F.col("best.key").alias("key"), F.col("best.span.since").alias("since"), "copies",
    )
    # a row repeated very often is given back by several tasks
    blocks = verdicts.select(
        "*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")).alias("block")
    ).withColumn("copies", F.expr(f"least({COPIES}, copies - block * {COPIES})"))
    spread = blocks.filter("block = 0").unionByName(blocks.filter("block > 0").repartition("id", "url", "at", "block"))
    return spread.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).drop("copy", "copies", "block")


#: The test tables have neither fetch times nor lists. Both are made from the pages themselves, by whole-number
#: arithmetic that DuckDB repeats: a page is fetched on a day of a year that its id gives, and hosts, their
#: domains and first path parts join and leave the lists on days that the MD5 of the key gives.
FETCH_DAY = "CAST((page_id * 37 + 11) % 365 AS INT)"
ENTRIES = """
    SELECT key, 'block' AS list, 'add' AS action, h % 300 AS day FROM keys WHERE h % 4 = 0
    UNION ALL SELECT key, 'block', 'remove', h % 300 + 40 + h % 50 FROM keys WHERE h % 4 = 0
    UNION ALL SELECT key, 'block', 'add', h % 300 + 150 FROM keys WHERE h % 8 = 0
    UNION ALL SELECT key, 'allow', 'add', h % 200 FROM keys WHERE h % 4 = 1
    UNION ALL SELECT key, 'allow', 'remove', h % 200 + 60 FROM keys WHERE h % 8 = 1
    UNION ALL SELECT key, 'block', 'add', 30 * k + h % 20 FROM domains, months
    UNION ALL SELECT key, 'block', 'remove', 30 * k + h % 20 + 5 FROM domains, months
"""
_DUCK_HASH = "CAST('0x' || substr(md5(key), 1, 4) AS INTEGER)"
_DUCK_HOST = f"regexp_extract(lower(url), '{HOST}', 1)"

OP10_SQL = f"""
    WITH p AS (SELECT page_id, url, {FETCH_DAY} AS day, {_DUCK_HOST} AS host,
                      string_split(regexp_extract(url, '{PATH}', 1), '/') AS parts FROM pages),
    l AS (SELECT *, string_split(host, '.') AS labels FROM p WHERE host <> ''),
    ck AS (SELECT DISTINCT page_id, url, day, key FROM (
        SELECT page_id, url, day, array_to_string(labels[i:], '.') AS key
          FROM (SELECT *, unnest(range(1, greatest(len(labels) - 1, 1) + 1)) AS i FROM l)
        UNION ALL SELECT page_id, url, day, host || array_to_string(parts[1:i], '/') || '/'
          FROM (SELECT *, unnest(range(2, len(parts) + 1)) AS i FROM l) WHERE parts[i] <> '')),
    hosts AS (SELECT DISTINCT host AS key FROM l), firsts AS (SELECT DISTINCT host || '/' || parts[2] || '/' AS key FROM l WHERE parts[2] <> ''),
    keys AS (SELECT key, {_DUCK_HASH} AS h FROM (SELECT * FROM hosts UNION ALL SELECT * FROM firsts)),
    domains AS (SELECT key, {_DUCK_HASH} AS h FROM (SELECT DISTINCT array_to_string(labels[-2:], '.') AS key FROM l WHERE len(labels) > 2)),
    months AS (SELECT unnest(range(0, 12)) AS k),
    entries AS ({ENTRIES}),
    states AS (SELECT key, list, day, max(action = 'add') AS "on" FROM entries GROUP BY ALL),
    changes AS (SELECT * FROM (SELECT *, coalesce(lag("on") OVER (PARTITION BY key, list ORDER BY day), false) AS was FROM states)
                WHERE "on" <> was),
    active AS (SELECT ck.page_id, ck.url, ck.day, ck.key, c.list, c.day AS since
               FROM (SELECT ck.*, v.list FROM ck, (VALUES ('allow'), ('block')) v(list)) ck
               ASOF JOIN changes c ON ck.key = c.key AND ck.list = c.list AND ck.day >= c.day WHERE c."on"),
    best AS (SELECT * FROM active QUALIFY row_number() OVER (
               PARTITION BY page_id, url, day ORDER BY length(key) DESC, key DESC, list) = 1)
    SELECT p.page_id, p.day AS fetch_day, coalesce(b.list, 'none') AS verdict, b.key AS matched_key, CAST(b.since AS INTEGER) AS active_since
    FROM p LEFT JOIN best b ON p.page_id IS NOT DISTINCT FROM b.page_id AND p.url IS NOT DISTINCT FROM b.url AND p.day IS NOT DISTINCT FROM b.day"""


def derived_entries(pages: DataFrame) -> DataFrame:
    """The dated entries made from the pages' hosts."""
    spark = pages.sparkSession
    hashed = "CAST(conv(substr(md5(CAST(key AS BINARY)), 1, 4), 16, 10) AS INT)"
    hosts = pages.selectExpr(
        f"regexp_extract(lower(url), r'{HOST}', 1) AS host",
        f"get(split(regexp_extract(url, r'{PATH}', 1), '/'), 1) AS part",
    ).filter("host <> ''").distinct()
    keys = hosts.selectExpr("host AS key").union(
        hosts.filter("part <> ''").selectExpr("concat(host, '/', part, '/') AS key")
    ).distinct().selectExpr("key", f"{hashed} AS h")
    domains = hosts.filter("size(split(host, '[.]')) > 2").selectExpr(
        "substring_index(host, '.', -2) AS key"
    ).distinct().selectExpr("key", f"{hashed} AS h")
    return spark.sql(
        f"WITH months AS (SELECT explode(sequence(0, 11)) AS k) {ENTRIES}".replace("FROM keys", "FROM {keys}").replace("FROM domains", "FROM {domains}"),
        keys=keys, domains=domains,
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page at the day it was fetched."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.selectExpr("page_id AS id", "url", f"{FETCH_DAY} AS at")
    return evaluate(captures, validity(derived_entries(pages))).selectExpr(
        "id AS page_id", "at AS fetch_day", "verdict", "key AS matched_key", "CAST(since AS INT) AS active_since"
    )
