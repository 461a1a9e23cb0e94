"""Compare registered queries with their SQL in DuckDB: python tests/check_oracle.py [sf] [names...]"""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    names = sorted(df.columns)
    ours = Counter(tuple(plain(v) for v in row) for row in df.select(*names).collect())
    result = con.execute(sql)
    found = [d[0] for d in result.description]
    if sorted(found) != names:
        return f"columns {names} / {sorted(found)}"
    order = [found.index(n) for n in names]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    if ours == theirs:
        return ""
    return f"{sum(ours.values())} / {sum(theirs.values())} rows, only ours {list((ours - theirs).items())[:3]}, only theirs {list((theirs - ours).items())[:3]}"


def main() -> None:
    import __spark_entry__ as entry
    from tests.session import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, sql = session(), connect(sf_dir), entry.oracle_sql()
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(run(spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
        spark.catalog.clearCache()


if __name__ == "__main__":
    main()
