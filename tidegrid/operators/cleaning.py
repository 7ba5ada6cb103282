"""Cleaning of arriving records: first-wins duplicates, types, blanks, dates, control columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.text import parse_date, tidy, try_parse_date
from tidegrid.operators.validity import check_points, check_rings, split_valid

# Columns of the cleaned tables, the phone stand-in and the quality mark.
NO_PHONE = "N/A"
QUALITY_SCORE = 1.0
QUALITY_MARK = "validated"
LOWERCASE_BELOW = 100


def keep_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``.

    An aggregate rather than a window, so that each task first reduces what it holds; a key
    with very many rows then costs no more than any other. Rows equal in ``order`` are told
    apart by a hash of the whole row, so that the choice does not vary between runs.
    """
    whole = ", ".join(f"`{c}`" for c in df.columns)
    by = ", ".join([*[f"`{c}`" for c in order], f"xxhash64({whole})"])
    kept = df.groupBy(*key).agg(F.expr(f"min_by(struct({whole}), struct({by})) AS _row"))
    return kept.select("_row.*")


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``."""
    whole = ", ".join(f"`{c}`" for c in df.columns)
    by = ", ".join([*[f"`{c}`" for c in order], f"xxhash64({whole})"])
    kept = df.groupBy(*key).agg(F.expr(f"max_by(struct({whole}), struct({by})) AS _row"))
    return kept.select("_row.*")


def control_columns(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumns(
        {"normalized_date": F.expr(f"TIMESTAMP '{run_ts}'"), "data_quality_score": F.lit(QUALITY_SCORE)}
    )


def source_columns(df: DataFrame, source_type: str, run_ts: str) -> DataFrame:
    """Where a converted record comes from; the date as ISO text."""
    return df.withColumns(
        {
            "_processed_date": F.lit(run_ts.replace(" ", "T")),
            "_source_type": F.lit(source_type),
            "_data_quality": F.lit(QUALITY_MARK),
        }
    )


def _standard(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{rules[c]} AS `{c}`" if c in rules else f"`{c}`" for c in df.columns])


def standard_citizens(df: DataFrame) -> DataFrame:
    """Types, the phone stand-in and trimmed text, for the columns that exist."""
    rules = {
        "citizen_id": "CAST(citizen_id AS BIGINT)",
        "registration_date": "CAST(registration_date AS TIMESTAMP)",
        "phone": f"coalesce(phone, '{NO_PHONE}')",
        "name": tidy("name"),
        "address": tidy("address"),
    }
    if dict(df.dtypes).get("registration_date") == "string":
        rules["registration_date"] = parse_date("registration_date")
    return _standard(df, rules)


def standard_areas(df: DataFrame) -> DataFrame:
    rules = {
        "area_id": "CAST(area_id AS BIGINT)",
        "flood_date": "CAST(flood_date AS TIMESTAMP)",
        "affected_population": "CAST(affected_population AS BIGINT)",
    }
    if dict(df.dtypes).get("flood_date") == "string":
        rules["flood_date"] = parse_date("flood_date")
    return _standard(df, rules)


def clean_citizens(raw: DataFrame, order: list[str], run_ts: str) -> tuple[DataFrame, DataFrame]:
    """``(silver, quarantine)`` for citizens: valid points, first record per id, standard types."""
    usable, bad = split_valid(check_points(raw))
    first = keep_first(usable, ["citizen_id"], order)
    return control_columns(standard_citizens(first), run_ts), bad


def clean_areas(raw: DataFrame, order: list[str], run_ts: str) -> tuple[DataFrame, DataFrame]:
    """``(silver, quarantine)`` for areas."""
    usable, bad = split_valid(check_rings(raw))
    first = keep_first(usable, ["area_id"], order)
    return control_columns(standard_areas(first), run_ts), bad


def text_profile(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, int, int]]:
    """For each text column: how many values there are, how many read as dates, and the greatest length.

    One pass over the data, one row back.
    """
    if not columns:
        return {}
    row = df.selectExpr(
        *[f"count(`{c}`) AS `n_{c}`" for c in columns],
        *[f"count({try_parse_date(f'`{c}`')}) AS `d_{c}`" for c in columns],
        *[f"coalesce(max(length(`{c}`)), 0) AS `l_{c}`" for c in columns],
    ).first()
    return {c: (row[f"n_{c}"], row[f"d_{c}"], row[f"l_{c}"]) for c in columns}


def auto_types(
    df: DataFrame, dates: list[str] | None = None, skip: tuple[str, ...] = (), lowercase: list[str] | None = None
) -> DataFrame:
    """Dates and lower case for text columns.

    A text column with at least one value that reads as a date becomes a timestamp; text in it that is
    no date is kept in a column ``<name>_text``, so nothing is lost. Any other text column goes to lower
    case if its longest value has fewer than 100 characters. Both are decided by the data; ``dates`` and
    ``lowercase`` name the columns instead, and with both given the data are not looked at.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    profile = None if dates is not None and lowercase is not None else text_profile(df, text)
    rules, kept = {}, []
    for c in text:
        values, n_dates, longest = profile[c] if profile is not None else (None, None, None)
        if (c in dates) if dates is not None else n_dates > 0:
            rules[c] = try_parse_date(f"`{c}`")
            if profile is None or n_dates < values:
                kept.append(f"CASE WHEN {rules[c]} IS NULL THEN `{c}` END AS `{c}_text`")
        elif (c in lowercase) if lowercase is not None else longest < LOWERCASE_BELOW:
            rules[c] = f"lower(`{c}`)"
    if not rules:
        return df
    return df.selectExpr(
        *[f"{rules[c]} AS `{c}`" if c in rules else f"`{c}`" for c in df.columns],
        *[k for k in kept if k.rsplit("`", 2)[1] not in df.columns],
    )


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing values replaced; columns that do not exist are added."""
    for name, value in defaults.items():
        filled = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        df = df.withColumn(name, filled)
    return df
