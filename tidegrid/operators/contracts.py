"""Typed table contracts: what a loaded table must look like, and which rows do not."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geometry import point_problem, ring_problem
from tidegrid.operators.grid import BROADCAST_BYTES
from tidegrid.operators.skew import meet
from tidegrid.session import materialise


@dataclass(frozen=True)
class Contract:
    """Column types in order, the key, and the limits of a table."""

    columns: dict[str, str]
    key: str
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    geometry: str = ""


# The two loaded tables and their limits.
CITIZENS = Contract(
    columns={
        "citizen_id": "BIGINT", "name": "STRING", "address": "STRING", "phone": "STRING",
        "registration_date": "DATE", "lon": "DOUBLE", "lat": "DOUBLE", "affected_by_flooding": "BOOLEAN",
    },
    key="citizen_id",
    not_null=("citizen_id", "name"),
    max_length={"name": 255, "phone": 20},
    defaults={"affected_by_flooding": "false"},
    geometry="point",
)
FLOODING_AREAS = Contract(
    columns={
        "area_id": "BIGINT", "area_name": "STRING", "flood_date": "DATE", "severity": "STRING",
        "affected_population": "BIGINT", "ring": "ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>",
    },
    key="area_id",
    not_null=("area_id",),
    max_length={"area_name": 255, "severity": 50},
    defaults={
        "area_name": "'Area_' || CAST(area_id AS STRING)",
        "severity": "'unknown'",
        "affected_population": "0",
    },
    geometry="ring",
)


def conform(df: DataFrame, contract: Contract, run_ts: str | None = None) -> DataFrame:
    """The contract's columns, cast, with its defaults; ``created_at`` if a run time is given."""
    out = []
    for name, kind in contract.columns.items():
        value = f"`{name}`" if name in df.columns else "NULL"
        if name in contract.defaults:
            value = f"coalesce({value}, {contract.defaults[name]})"
        out.append(f"CAST({value} AS {kind}) AS `{name}`")
    if run_ts:
        out.append(f"TIMESTAMP '{run_ts}' AS created_at")
    return df.selectExpr(*out)


def _row_problem(contract: Contract) -> str:
    tests = [f"WHEN `{c}` IS NULL THEN 'null_{c}'" for c in contract.not_null]
    tests += [f"WHEN length(`{c}`) > {n} THEN 'too_long_{c}'" for c, n in contract.max_length.items()]
    if contract.geometry == "point":
        tests.append(f"WHEN {point_problem('lon', 'lat')} IS NOT NULL THEN 'bad_geometry'")
    elif contract.geometry == "ring":
        tests.append(f"WHEN {ring_problem('ring')} IS NOT NULL THEN 'bad_geometry'")
    return f"CASE {' '.join(tests)} END"


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows breaking the contract, with ``violation``; one row for each reason of a row.

    Keys are counted first and only those occurring twice are looked up again, a key with very
    many rows in pieces.
    """
    key = contract.key
    by_row = df.selectExpr("*", f"{_row_problem(contract)} AS violation").filter("violation IS NOT NULL")
    twice = materialise(
        df.filter(f"`{key}` IS NOT NULL").groupBy(key).count().filter("count > 1").select(key), "twice"
    )
    size = twice.selectExpr(f"sum(octet_length(CAST(`{key}` AS STRING)) + 64)").first()[0] or 0
    by_key = meet(df, twice, [key], df.columns, small=size <= BROADCAST_BYTES, how="left_semi")
    return by_row.unionByName(by_key.select(*df.columns, F.lit("duplicate_key").alias("violation")))


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    return violations(df, contract).groupBy("violation").agg(F.count(F.lit(1)).alias("rows"))
