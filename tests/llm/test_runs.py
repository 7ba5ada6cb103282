import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidegrid.llm import runs

SF_DIR = "/root/testdata/sf0.001"


def by_definition(words):
    """Runs by comparing every word with the one q places on, for every q."""
    n, found = len(words), []
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.array([number[w] for w in words], int)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]]).astype(np.int8)
        for i, j in np.flatnonzero(np.diff(same)).reshape(-1, 2).tolist():
            length, period = j + q - i, words[i : i + q]
            if length >= max(6, 4 * q):
                if not any(q % d == 0 and period == period[:d] * (q // d) for d in range(1, q)):
                    found.append((i, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def digests(doc_id, text):
    """The row of op13 by the contract's words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = by_definition(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    return {
        "doc_id": doc_id,
        "n_runs": len(found),
        "start": best and best[0],
        "length": best and best[1],
        "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(
            " ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    }


@pytest.mark.parametrize("seed", range(4))
def test_random_words_against_the_definition(seed):
    rnd = random.Random(seed)
    for _ in range(400):
        n, kinds = rnd.randint(0, 70), rnd.choice([1, 2, 2, 3, 4, 8])
        words = [rnd.randrange(kinds) for _ in range(n)]
        if n and rnd.random() < 0.6:
            a = rnd.randrange(n)
            p = rnd.randint(1, min(9, n - a))
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        assert runs.find_runs(words) == by_definition(words)
        # and without cutting words out first
        assert runs.runs_of_letters([w + 1 for w in words]) == by_definition(words)


def test_nested_runs_of_all_periods():
    words = (["a"] * 6 + ["b"]) * 5
    assert runs.find_runs(words) == by_definition(words)
    assert {q for _, _, q in runs.find_runs(words)} == {1, 7}
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    assert runs.find_runs(list(fib[-1])) == by_definition(list(fib[-1]))
    assert runs.find_runs(list(fib[-1] * 4)) == by_definition(list(fib[-1] * 4))


def test_extensions_equal_plain_comparison():
    rnd = random.Random(9)
    letters = [rnd.randint(1, 2) for _ in range(400)]
    tree = runs.SuffixTree([*letters, 0])
    depths, place, order = tree.tour()
    word = [*letters, 0]
    assert order == sorted(range(401), key=lambda i: word[i:])
    flipped = [0 if x == 0 else 3 - x for x in word]
    assert tree.opposite() == sorted(range(401), key=lambda i: flipped[i:])
    a = np.array([rnd.randrange(400) for _ in range(3000)])
    b = np.array([rnd.randrange(400) for _ in range(3000)])
    a, b = a[a != b], b[a != b]
    got = runs.Extensions(depths, place).of(a, b)
    for x, y, g in zip(a, b, got):
        n = 0
        while word[x + n] == word[y + n]:
            n += 1
        assert g == n


def test_long_text_whole():
    words = [f"w{i}" for i in range(20_000)] + [f"v{i % 4000}" for i in range(20_000)] + ["end"]
    assert runs.find_runs(words) == [(20_000, 20_000, 4000)]


def test_planting_and_digests(spark, tmp_path):
    rnd = random.Random(4)
    texts = [None, "", " \t\n", "a", "a a a a a a", "é " * 7 + " x y", "x\x0by\x1cz"]
    texts += [" ".join(rnd.choice(["so", "la", "mi", " "]) for _ in range(rnd.randint(1, 80))) for _ in range(150)]
    rows = [(i, t, "n") for i, t in enumerate(texts)] + [(3, "b b b b b b b", "again"), (None, "b " * 9, "n")]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{path}/documents.parquet")
    got = [r.asDict() for r in runs.op13(spark, path).collect()]
    expected = [digests(i, t) for i, t, _ in rows]
    key = lambda r: str(sorted(r.items()))
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 5


def test_query_on_whole_table(spark, documents):
    got = {r["doc_id"]: r.asDict() for r in runs.op13(spark, SF_DIR).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["doc_id"]] == digests(r["doc_id"], r["text"])
    assert any(r["n_runs"] for r in got.values())


def test_clashing_names_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a " * 8, 5, "x", "y")], "id long, text string, runs int, Collapsed string, _text string")
    marked = runs.mark_runs(docs)
    assert marked.columns == ["id", "text", "runs", "Collapsed", "_text", "n_words", "runs_", "collapsed_"]
    row = marked.first()
    assert row["runs"] == 5 and row["Collapsed"] == "x" and row["collapsed_"] == "a"
    assert [tuple(r) for r in row["runs_"]] == [(0, 8, 1)]
    assert runs.mark_runs(docs.limit(0)).collect() == []
