"""Run registered queries against their SQL counterparts: python tests/check_queries.py [sf] [name…]."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tidegrid.session import local_session  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_cell(row[i]) for i in order]) for row in rows)


# how each side names the same type
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
}


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if TYPES.get(t) != kinds[c]}
    if wrong:
        return f"types {wrong}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lost = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows against {len(want)}; only here {extra}; only there {lost}"
    return None if got else "no rows"


def main() -> None:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name) if name in oracle_sql() else "no SQL"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
