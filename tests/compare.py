"""Run the named queries against DuckDB on the same Parquet files.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

LOCAL = {
    "spark__master": "local[8]",
    "spark__driver__memory": "8g",
    "spark__ui__enabled": "false",
    "spark__ui__showConsoleProgress": "false",
    "spark__sql__shuffle__partitions": "8",
}


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return ("0",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return ("0",) if math.isnan(number) else ("n", round(number, 9))
    return ("s", str(value))


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, name: str, folder: str) -> str | None:
    """What is different between the two engines, or None."""
    from catalog import ORACLES, QUERIES

    frame = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    if name not in ORACLES:
        return None if rows else "no rows"
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    ours, theirs = normal(frame.columns, rows), normal(columns, expected)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None if ours else "no rows on either side"


if __name__ == "__main__":
    from catalog import QUERIES
    from tablewright.session import build_session

    session = build_session("compare", **LOCAL)
    session.sparkContext.setLogLevel("OFF")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = difference(session, con, name, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differences")
