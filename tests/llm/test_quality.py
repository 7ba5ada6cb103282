"""Base counts against a plain count, fences, and rows out of the ordinary."""

import re
from collections import Counter

from tidegrid.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = [
    None, "", " \t\n", "one", "a b", "a b c a b c", "a a a a a", "x\x0by\x0cz\r\nq", "# * $ % & | < >", "é ü ß 日本",
    "same line\nsame line\n\nsame line \nother", "a b c\na b c\na b c d a b c", " a b\x85c", "w " * 5000,
    " ".join(f"w{i % 97}" for i in range(3000)),
]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
    }


def test_counts_equal_plain_counts(docs_of):
    rows = quality.measured(docs_of(list(enumerate(TEXTS)), "n_words"), "text", "q").collect()
    for row in rows:
        assert {k: row["q"][k] for k in quality.BASE} == plain(TEXTS[row["doc_id"]])


def test_equals_sql(against_sql):
    assert against_sql("op1_quality_rules") is None


def test_fences_adapt_to_the_source(spark):
    # symbols are usual in one source and a sign of junk in the other
    words = [f"word{i}" for i in range(80)]
    rows = [(i, " ".join(w + "&" * (i % 4) for w in words), "en", "menus") for i in range(200)]
    rows += [(1000 + i, " ".join(words), "en", "news") for i in range(200)]
    rows += [(2000, " ".join(w + "&&&" for w in words), "en", "news")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality.apply_quality(docs).collect()}
    assert kept == {r[0] for r in rows} - {2000}


def test_few_texts_use_the_sketch_of_their_language(spark):
    words = " ".join(f"word{i}" for i in range(80))
    rows = [(i, words, "en", "news") for i in range(150)] + [(900, words.replace(" ", "### "), "en", "rare"), (901, words, "en", "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality.apply_quality(docs).collect()}
    assert 900 not in kept and 901 in kept


def test_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(None, good, None, None, "a", 1), (1, good, "en", None, "b", 2), (1, good, "en", None, "b", 2),
            (2, None, "en", "s", "c", 3), (3, "", None, "s", "d", 4), (4, "short", "-", "+", None, None)]
    schema = "doc_id long, text string, lang string, source string, _quality string, max_symbols long"
    docs = spark.createDataFrame(rows, schema)
    out = quality.apply_quality(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in docs.collect() if r["text"] == good)
    assert quality.apply_quality(docs.limit(0)).collect() == []
