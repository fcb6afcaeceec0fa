"""Run registered queries next to their SQL checks and compare rows, names and values.

Usage: python tools/check_oracles.py [folder] [name-part ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans import catalog  # noqa: E402
from tidemark.plans.views import TABLES  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def rows_of(frame) -> list[tuple]:
    names = sorted(frame.columns)
    out = []
    for row in frame[names].itertuples(index=False):
        out.append(tuple(None if v is None or v is pandas.NA or v != v else v for v in row))
    return sorted(out, key=repr)


def compare(spark_frame, sql_frame) -> str:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    left, right = rows_of(spark_frame), rows_of(sql_frame)
    bad = [(a, b) for a, b in zip(left, right, strict=True) if tuple(map(str, a)) != tuple(map(str, b))]
    if not bad:
        return "ok"
    return f"{len(bad)} of {len(left)} rows differ, first: {str(bad[0])[:700]}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = local_session("check")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    oracles = catalog.oracle_sql()
    failed = 0
    for name, query in catalog.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            spark_frame = query(spark, folder).toPandas()
            middle = time.time()
            verdict = "rows only" if name not in oracles else compare(
                spark_frame, db.execute(oracles[name]).fetch_df()
            )
        except Exception as error:
            middle = time.time()
            verdict = f"error {type(error).__name__}: {str(error)[:900]}"
        failed += verdict not in ("ok", "rows only")
        n = len(spark_frame) if "error" not in verdict else "-"
        print(f"{name:42s} {n!s:>7} rows  {middle - start:6.2f}s spark {time.time() - middle:6.2f}s sql  {verdict}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
