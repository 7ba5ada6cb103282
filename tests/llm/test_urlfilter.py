"""Verdicts against a plain evaluation of the dated entries, and rows out of the ordinary."""

import random
from urllib.parse import urlsplit

from tidegrid.llm import urlfilter


def test_equals_sql(against_sql):
    assert against_sql("op10_url_filters") is None


def plain(url, at, entries):
    """(verdict, key, since) by replaying all entries up to the day."""
    if url is None or at is None:
        return ("none", None, None)
    parts = urlsplit(url)
    host = (parts.hostname or "") if "://" in url else ""
    if not host:
        return ("none", None, None)
    labels = host.split(".")
    keys = {".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))}
    steps = parts.path.split("/")
    keys |= {host + "/".join(steps[:i]) + "/" for i in range(2, len(steps) + 1) if steps[i - 1]}
    best = None
    for key in keys:
        for name in ("allow", "block"):
            days = sorted({d for k, n, _, d in entries if k == key and n == name and d is not None and d <= at})
            on, since = False, None
            for day in days:
                now = any(a == "add" for k, n, a, d in entries if (k, n, d) == (key, name, day))
                if now and not on:
                    since = day
                on = now
            if on:
                rank = (len(key), key, name == "allow")
                if best is None or rank > best[0]:
                    best = (rank, (name, key, since))
    return best[1] if best else ("none", None, None)


def test_verdicts_equal_a_replay(spark):
    rng = random.Random(9)
    hosts = ["a.b.com", "b.com", "x.a.b.com", "c.org", "localhost"]
    paths = ["", "/", "/p/q/r.html", "/p/", "/P/q?x=/no/#/f", "/p//q"]
    keys = [*hosts, "com", "a.b.com/p/", "a.b.com/p/q/", "b.com/p/", "c.org/P/", "b.com/p//q/"]
    entries = [(rng.choice(keys), rng.choice(["block", "allow"]), rng.choice(["add", "remove"]), rng.randrange(30)) for _ in range(160)]
    entries += entries[:20] + [(None, "block", "add", 1), ("b.com", "block", "add", None), ("b.com", "other", "add", 1), ("b.com", "block", None, 1)]
    captures = [(i, f"http{'s' * (i % 2)}://{'u@' * (i % 3 == 0)}{rng.choice(hosts)}{':80' * (i % 5 == 0)}{rng.choice(paths)}", rng.randrange(35)) for i in range(300)]
    captures += [(1000, None, 3), (1001, "no url", 3), (1002, "http://", 3), (1003, "http://b.com/", None), (None, "http://b.com/p/", 20), (5, "http://b.com/", 9), (5, "http://b.com/", 9)]
    e = spark.createDataFrame([(*x, "z") for x in entries], "key string, list string, action string, day int, verdict string")
    c = spark.createDataFrame([(*x, "z") for x in captures], "id long, url string, at int, since string")
    got = sorted((str(r["id"]), str(r["url"]), str(r["at"]), r["verdict"], str(r["key"]), str(r["since"])) for r in urlfilter.evaluate(c, urlfilter.validity(e)).collect())
    want = sorted((str(i), str(u), str(t), v, str(k), str(s)) for i, u, t in captures for v, k, s in [plain(u, t, entries)])
    assert got == want
    assert len({g[3] for g in got}) == 3
    none = urlfilter.evaluate(c, urlfilter.validity(e.limit(0))).collect()
    assert len(none) == len(captures) and {r["verdict"] for r in none} == {"none"}
    assert urlfilter.evaluate(c.limit(0), urlfilter.validity(e)).collect() == []


def test_very_often_repeated_captures(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "COPIES", 10)
    c = spark.range(47).selectExpr("1L AS id", "'http://b.com/' AS url", "3 AS at")
    e = spark.createDataFrame([("b.com", "block", "add", 1)], "key string, list string, action string, day int")
    got = urlfilter.evaluate(c, urlfilter.validity(e)).collect()
    assert len(got) == 47 and {r["verdict"] for r in got} == {"block"}
