"""Sample citizens at any scale, fixed by their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.functions.text import days_from, hash_int, normal_draw, zero_padded

# Base points near and away from risk, with the spread of each (degrees).
RISK_BASES = [(-51.24, -30.01), (-51.22, -30.01), (-51.20, -29.90)]
RISK_SIGMA = 0.03
SAFE_BASES = [(-51.10, -29.80), (-51.40, -30.15)]
SAFE_SIGMA = 0.05
RISK_SHARE = 60  # per hundred


def _base(key: str, stream: str, bases: list[tuple[float, float]], axis: int) -> str:
    values = ", ".join(f"{b[axis]!r}D" for b in bases)
    return f"array({values})[CAST({hash_int(key, stream)} % {len(bases)} AS INT)]"


def citizens_from_ids(ids: DataFrame, key: str) -> DataFrame:
    """A sample citizen for each id: of every hundred ids, 60 near risk areas and 40 away.

    Points are normal draws about a base point chosen by the id; the same id always gives
    the same citizen, whatever the partitioning.
    """
    k = f"`{key}`"

    def axis(name: str, i: int) -> str:
        risk = normal_draw(k, f"risk/{name}", _base(k, "risk/base", RISK_BASES, i), RISK_SIGMA)
        safe = normal_draw(k, f"safe/{name}", _base(k, "safe/base", SAFE_BASES, i), SAFE_SIGMA)
        return f"CASE WHEN {k} % 100 < {RISK_SHARE} THEN {risk} ELSE {safe} END AS {name}"

    number = f"CAST(1 + {hash_int(k, 'house')} % 999 AS INT)"
    return ids.selectExpr(
        f"{k} AS citizen_id",
        f"'Citizen_' || {zero_padded(k, 3)} AS name",
        f"'Rua ' || CAST({k} AS STRING) || ', nº ' || CAST({number} AS STRING) || ', Porto Alegre' AS address",
        f"'51 99999-' || {zero_padded(k, 4)} AS phone",
        f"{days_from('2024-01-01', f'{k} % 36500')} AS registration_date",
        axis("lon", 0),
        axis("lat", 1),
    )


def sample_citizens(spark: SparkSession, n: int = 100) -> DataFrame:
    return citizens_from_ids(spark.range(n), "id")
