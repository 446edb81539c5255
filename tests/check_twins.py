"""Compare registered queries with their SQL twins: `python tests/check_twins.py [sf] [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cores=8):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return (type(v).__name__, str(v))
    if isinstance(v, float):
        return ("float", "nan" if math.isnan(v) else f"{v:.6f}" if v != 0 else "0.000000" if math.copysign(1, v) > 0 else "-0.0")
    return (type(v).__name__, str(v))


def compare(spark_df, rel):
    a_cols, b_cols = sorted(spark_df.columns), sorted(rel.columns)
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}"
    a = sorted(tuple(norm(r[c]) for c in a_cols) for r in spark_df.collect())
    idx = [rel.columns.index(c) for c in a_cols]
    b = sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; spark {a[:2]} duck {b[:2]}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"{len(diff)}/{len(a)} rows differ, columns {a_cols}; first spark {diff[0][0]} duck {diff[0][1]}"
    return None if a else "EMPTY"


def main():
    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark, con = session(), duck(f"/root/testdata/sf{sf}")
    qs, sqls = e.queries(), e.oracle_sql()
    if names and names[0] == "--from":
        keys = list(qs)
        names = keys[keys.index(names[1]):]
    bad = 0
    for name in names or qs:
        start = time.time()
        try:
            df = qs[name](spark, f"/root/testdata/sf{sf}")
            if name in sqls:
                out = compare(df, con.sql(sqls[name]))
            else:
                rows = df.collect()
                out = None if rows else "EMPTY"
                print("    rows only:", len(rows), rows[:2])
        except Exception as ex:  # report and go on
            out = f"{type(ex).__name__}: {str(ex)[:700]}"
        bad += out is not None
        print(f"{'ok  ' if out is None else 'FAIL'} {name} {time.time() - start:.1f}s {out or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
