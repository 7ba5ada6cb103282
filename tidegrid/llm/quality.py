"""Quality rules whose thresholds adapt to language and source.

Every text gets a few whole-number measures. For each language and source, a sketch counts how
many texts fall in each of a few hundred logarithmic buckets of a measure. Sketches add up: those
of the sources of a language give the language's, those of all languages the whole's, and what a
task has counted is summed before it is shuffled. A bucket is at most 1/32 of its value wide, so
quantiles read from a sketch are off by no more than that. A text is rejected if one of its
measures lies above the fence of its language and source, which is the upper quartile plus a
multiple of the distance between the quartiles.

Everything is DataFrame and SQL functions.

Defined results: a null text counts as empty; null language or source is a group of its own; an
empty table gives an empty result; repeated rows are each judged, alike; columns of any other name
are carried along untouched by ``apply_quality``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import BROADCAST_BYTES, fresh, table
from tidegrid.operators.skew import meet
from tidegrid.session import materialise

#: A word, as a regular expression in SQL text (fixed by the contract).
WORD = r"[^\\x20\\x09-\\x0D]+"
#: Characters counted as symbols (fixed by the contract).
SYMBOLS = "#*$%&|<>"
#: Marks counted as shouting.
SHOUTS = "!?"
#: Fixed cut-offs that hold for every language and source (fixed by the contract).
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Measures, all in thousandths, and the least distance between quartiles that is taken for real:
#: where nearly all texts agree, a difference below it is no sign of bad quality.
SPREADS = {"symbols": 20, "dup_lines": 200, "repeats": 120, "shouts": 15, "capitals": 50, "word_length": 1000}
#: How many quartile distances above the upper quartile the fence stands.
FENCE = 3
#: A language and source with fewer texts than this uses the sketch of its language, and a
#: language with fewer uses that of all texts.
MIN_TEXTS = 100

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_shouts", "n_capitals"]


def measured(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with a struct ``out`` of the base counts and the measures of column ``text``."""
    names = ["t", "w", "lines", "h", "s", "p", "c", *COUNTS]
    step = {n: fresh([*docs.columns, out], f"_{n}") for n in names}
    t, w, lines, h, s, p, c = (step[n] for n in names[:7])

    def then(df: DataFrame, *exprs: str, drop: tuple[str, ...] = ()) -> DataFrame:
        # arrays are dropped as soon as they are used up: each projection copies what it is given
        return df.selectExpr("*", *exprs).drop(*drop)

    df = then(docs, f"coalesce(`{text}`, '') AS `{t}`")
    df = then(
        df,
        f"array_remove(split(regexp_replace(`{t}`, '[\\\\x09-\\\\x0D]', ' '), ' ', -1), '') AS `{w}`",
        f"filter(split(`{t}`, '\\n', -1), x -> x RLIKE '{WORD}') AS `{lines}`",
        f"CAST(regexp_count(`{t}`, '[{SYMBOLS}]') AS BIGINT) AS `{step['n_symbols']}`",
        f"CAST(regexp_count(`{t}`, '[{SHOUTS}]') AS BIGINT) AS `{step['n_shouts']}`",
        f"CAST(regexp_count(`{t}`, '\\\\p{{Lu}}') AS BIGINT) AS `{step['n_capitals']}`",
        drop=(t,),
    )
    # one number per window of three words
    df = then(
        df,
        f"slice(transform(`{w}`, (x, i) -> xxhash64(x, get(`{w}`, i + 1), get(`{w}`, i + 2))),"
        f" 1, greatest(size(`{w}`) - 2, 0)) AS `{h}`",
        f"CAST(size(`{w}`) AS BIGINT) AS `{step['n_words']}`",
        f"CAST(length(array_join(`{w}`, '')) AS BIGINT) AS `{step['word_chars']}`",
        f"CAST(size(`{lines}`) AS BIGINT) AS `{step['n_lines']}`",
        f"CAST(size(`{lines}`) - size(array_distinct(`{lines}`)) AS BIGINT) AS `{step['n_dup_lines']}`",
        drop=(w, lines),
    )
    # Windows with equal leading bits stand next to each other once sorted; the position takes the
    # bits that follow. Only what stands beside such a one is compared in full, and texts whose
    # windows all differ skip this.
    bits = f"length(bin(size(`{h}`)))"
    df = then(
        df,
        f"CASE WHEN size(array_distinct(`{h}`)) < size(`{h}`) THEN sort_array(transform(`{h}`, (x, i) ->"
        f" shiftleft(shiftright(x, {bits}), {bits}) + i)) ELSE CAST(array() AS array<bigint>) END AS `{s}`",
    )
    df = then(
        df,
        f"sort_array(transform(filter(`{s}`, (e, i) -> shiftright(e, {bits}) <=> shiftright(get(`{s}`, i - 1), {bits})"
        f" OR shiftright(e, {bits}) <=> shiftright(get(`{s}`, i + 1), {bits})),"
        f" e -> CAST(e - shiftleft(shiftright(e, {bits}), {bits}) AS INT))) AS `{p}`",
        drop=(s,),
    )
    df = then(
        df, f"sort_array(transform(`{p}`, i -> struct(get(`{h}`, i) AS h, i AS p))) AS `{c}`", drop=(h, p)
    )
    df = then(
        df,
        f"sort_array(transform(filter(`{c}`, (e, i) -> e.h <=> get(`{c}`, i - 1).h"
        f" OR e.h <=> get(`{c}`, i + 1).h), e -> e.p)) AS `{p}`",
        drop=(c,),
    )
    df = then(
        df,
        f"aggregate(transform(`{p}`, (x, i) -> CAST(least(3, coalesce(get(`{p}`, i + 1) - x, 3))"
        f" AS BIGINT)), 0L, (a, b) -> a + b) AS `{step['n_repeat_words']}`",
        drop=(p,),
    )
    fields = F.struct(*[F.col(f"`{step[n]}`").alias(n) for n in COUNTS])
    return df.select("*", fields.alias(out)).drop(*[step[n] for n in COUNTS])


def measures(c: str) -> dict[str, Column]:
    """Each measure in thousandths, from the struct column ``c``."""
    def share(part: str, whole: str) -> Column:
        return F.expr(f"`{c}`.{part} * 1000 div greatest(`{c}`.{whole}, 1L)")

    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "shouts": share("n_shouts", "word_chars"),
        "capitals": share("n_capitals", "word_chars"),
        "word_length": share("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """The lower end of the value's bucket: its six leading bits, the others zero."""
    low = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(judged: DataFrame, struct: str, lang: str, source: str) -> DataFrame:
    """One row for each language, source, measure and bucket that holds texts, with their number."""
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), bucket(v).alias("bucket")) for n, v in measures(struct).items()])
    return (
        judged.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.inline(pairs))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketch: DataFrame, group: list[str]) -> DataFrame:
    """Both quartiles of each measure in each group of the sketch, summed over what else it holds.

    A group and measure has a few hundred buckets at most, whatever the number of texts.
    """
    merged = sketch.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))
    keys = ", ".join([*group, "measure"])
    return (
        merged.selectExpr(
            *group, "measure", "bucket",
            f"sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS upto",
            f"sum(n) OVER (PARTITION BY {keys}) AS texts",
        )
        .groupBy(*group, "measure", "texts")
        .agg(
            F.min(F.expr("CASE WHEN upto * 4 >= texts THEN bucket END")).alias("q1"),
            F.min(F.expr("CASE WHEN upto * 4 >= texts * 3 THEN bucket END")).alias("q3"),
        )
    )


def fences(sketch: DataFrame) -> DataFrame:
    """The fence of each measure, a column ``max_<measure>`` each, for every language and source."""
    own = quartiles(sketch, ["lang", "source"]).alias("o")
    of_lang = quartiles(sketch, ["lang"]).alias("l")
    of_all = quartiles(sketch, []).alias("a")
    joined = own.join(
        of_lang, F.expr("o.lang <=> l.lang AND o.measure = l.measure")
    ).join(F.broadcast(of_all), F.expr("o.measure = a.measure"))
    spread = F.create_map(*[F.lit(x) for pair in SPREADS.items() for x in pair])
    level = (
        F.when(F.expr(f"o.texts >= {MIN_TEXTS}"), F.expr("struct(o.q1, o.q3)"))
        .when(F.expr(f"l.texts >= {MIN_TEXTS}"), F.expr("struct(l.q1, l.q3)"))
        .otherwise(F.expr("struct(a.q1, a.q3)"))
    )
    fenced = joined.select(
        F.expr("o.lang").alias("lang"), F.expr("o.source").alias("source"), F.expr("o.measure").alias("measure"),
        level.alias("q"), spread[F.expr("o.measure")].cast("long").alias("least"),
    ).select(
        "lang", "source", "measure",
        (F.expr("q.q3") + FENCE * F.greatest(F.expr("q.q3 - q.q1"), F.col("least"))).alias("fence"),
    )
    return fenced.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == n, F.col("fence"))).alias(f"max_{n}") for n in SPREADS]
    )


def judge(judged: DataFrame, struct: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add the struct ``<struct>_v`` (base_failed, the fences, kept) to a written table of measures."""
    bounds = materialise(fences(sketches(judged, struct, lang, source)), "fences")
    limit = fresh(judged.columns, "_fence")
    keys = [fresh([*judged.columns, limit], "_kl"), fresh([*judged.columns, limit], "_ks")]
    # a null is written as '-', any other value follows a '+', so the pair can be an ordinary join key
    marked = [
        F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")).alias(k)
        for c, k in zip((lang, source), keys, strict=True)
    ]
    bound_keys = [
        F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")).alias(k)
        for c, k in zip(("lang", "source"), keys, strict=True)
    ]
    right = bounds.select(*bound_keys, F.struct(*[f"max_{n}" for n in SPREADS]).alias(limit))
    measured_bytes = right.select(
        F.sum(F.octet_length(keys[0]) + F.octet_length(keys[1]) + 8 * len(SPREADS) + 64)
    ).first()[0] or 0
    left = judged.select("*", *marked)
    joined = meet(left, right, keys, [keys[0], f"{struct}"], measured_bytes <= BROADCAST_BYTES)
    base = F.expr(
        f"`{struct}`.n_words < {MIN_WORDS}"
        f" OR 100 * `{struct}`.n_repeat_words > {MAX_REPEAT_PERCENT} * `{struct}`.n_words"
    )
    within = F.lit(True)
    for name, value in measures(struct).items():
        within = within & (value <= F.col(f"`{limit}`.max_{name}"))
    return joined.withColumn(
        f"{struct}_v", F.struct(base.alias("base_failed"), (~base & within).alias("kept"))
    ).drop(*keys)


def apply_quality(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    The rows are written once with their measures, so texts are neither measured twice nor shuffled.
    """
    struct = fresh([c + "_v" for c in docs.columns] + docs.columns, "_quality")
    written = materialise(measured(docs, text, struct), "quality")
    return judge(written, struct, lang, source).filter(F.col(f"`{struct}_v`.kept")).select(*docs.columns)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    written = materialise(measured(docs, "text", "_q").select("doc_id", "lang", "source", "_q"), "quality")
    verdict = judge(written, "_q")
    return verdict.select(
        "doc_id", *[F.col(f"_q.{c}").alias(c) for c in BASE], "_q_v.base_failed", "_q_v.kept"
    )


def op1_sql() -> str:
    """The same for DuckDB: windows and sketches as plain relations."""
    def chars(c: str) -> str:
        return f"length(t) - length(translate(t, '{c}', ''))"

    ws = "[^ \\t\\n\\x0B\\f\\r]"
    spreads = ", ".join(f"('{n}', {v})" for n, v in SPREADS.items())
    quart = """SELECT {g} measure, sum(n) AS texts,
        min(CASE WHEN upto * 4 >= total THEN bucket END) AS q1, min(CASE WHEN upto * 4 >= total * 3 THEN bucket END) AS q3
      FROM (SELECT *, sum(n) OVER (PARTITION BY {g} measure ORDER BY bucket) AS upto,
                   sum(n) OVER (PARTITION BY {g} measure) AS total
            FROM (SELECT {g} measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY {g} measure"""
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{ws}+') AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{ws}')) AS ls FROM d),
    win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
    rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
    cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY r),
    q AS (SELECT w.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
            CAST(length(regexp_replace(t, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS BIGINT) AS word_chars,
            CAST({chars(SYMBOLS)} AS BIGINT) AS n_symbols,
            CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
            {chars(SHOUTS)} AS n_shouts, length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS n_capitals
          FROM w LEFT JOIN cov ON w.r = cov.r),
    m AS (SELECT r, lang, source, unnest([
            {{'measure': 'symbols', 'v': n_symbols * 1000 // greatest(word_chars, 1)}},
            {{'measure': 'dup_lines', 'v': n_dup_lines * 1000 // greatest(n_lines, 1)}},
            {{'measure': 'repeats', 'v': n_repeat_words * 1000 // greatest(n_words, 1)}},
            {{'measure': 'shouts', 'v': n_shouts * 1000 // greatest(word_chars, 1)}},
            {{'measure': 'capitals', 'v': n_capitals * 1000 // greatest(word_chars, 1)}},
            {{'measure': 'word_length', 'v': word_chars * 1000 // greatest(n_words, 1)}}], recursive := true) FROM q),
    sketch AS (SELECT lang, source, measure, (v >> s) << s AS bucket, count(*) AS n
               FROM (SELECT *, CAST(greatest(length(bin(v)) - 6, 0) AS INTEGER) AS s FROM m) GROUP BY ALL),
    own AS ({quart.format(g="lang, source,")}), of_lang AS ({quart.format(g="lang,")}), of_all AS ({quart.format(g="")}),
    fence AS (SELECT o.lang, o.source, o.measure,
                CASE WHEN o.texts >= {MIN_TEXTS} THEN o.q3 + {FENCE} * greatest(o.q3 - o.q1, s.least)
                     WHEN l.texts >= {MIN_TEXTS} THEN l.q3 + {FENCE} * greatest(l.q3 - l.q1, s.least)
                     ELSE a.q3 + {FENCE} * greatest(a.q3 - a.q1, s.least) END AS top
              FROM own o JOIN of_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure
              JOIN of_all a ON o.measure = a.measure JOIN (VALUES {spreads}) s(measure, least) ON s.measure = o.measure),
    verdict AS (SELECT m.r, bool_and(m.v <= f.top) AS within FROM m JOIN fence f
                ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source AND m.measure = f.measure
                GROUP BY m.r)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
           NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND within AS kept
    FROM q JOIN verdict USING (r)"""
