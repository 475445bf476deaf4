"""Compare catalogue queries with their SQL: python tools/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobloom.plans import catalog  # noqa: E402
from jobloom.session import get_spark  # noqa: E402


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, float) and v == int(v):
            return str(int(v))
        return str(v)

    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False))


def compare(spark, sf_dir: str, name: str, con) -> tuple[bool, str]:
    mine = catalog.queries()[name](spark, sf_dir).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(mine)} rows, no SQL"
    theirs = con.sql(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return False, f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"
    a, b = rows(mine), rows(theirs)
    if a == b:
        return True, f"{len(a)} rows"
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return False, f"{len(a)} / {len(b)} rows; spark only {only_a}; sql only {only_b}"


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.queries())
    spark = get_spark(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, sf_dir, name, con)
        except Exception as err:  # noqa: BLE001
            ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28} {time.time() - start:6.1f}s  {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
