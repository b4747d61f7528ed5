"""Run queries() and oracle_sql() side by side (the driver's check, locally).

usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, ".")
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from layerflow.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(norm(r[i])) for i in order) for r in rows))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    if os.environ.get("PLAIN_SESSION"):
        # the driver's kind of session: none of build_session's settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = build_session("local[8]")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            scols, srows = df.columns, [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        el = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows ({el:.1f}s, no oracle)")
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(ocols):
            print(f"FAIL {name}: columns {sorted(scols)} vs {sorted(ocols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(ocols, orows)
        if a != b:
            sa, sb = set(a), set(b)
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}; spark-only {list(sa - sb)[:3]}; "
                  f"oracle-only {list(sb - sa)[:3]}")
            bad += 1
        else:
            print(f"OK   {name}: {len(a)} rows ({el:.1f}s)")
    spark.stop()
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
