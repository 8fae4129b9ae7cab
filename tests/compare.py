"""Run queries next to their SQL and compare names, counts and values.

``python tests/compare.py sf0.01 [query ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ROOT = "/root/testdata"


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(v)
    return "null" if v is None else str(v)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Differences as text, empty when equal."""
    cur = con.execute(sql)
    theirs_names = [c[0] for c in cur.description]
    theirs = canonical(theirs_names, cur.fetchall())
    mine = canonical(df.columns, df.collect())
    if sorted(df.columns) != sorted(theirs_names):
        return f"columns {sorted(df.columns)} != {sorted(theirs_names)}", len(mine)
    if mine == theirs:
        return "", len(mine)
    a, b = set(mine), set(theirs)
    return f"rows {len(mine)} vs {len(theirs)}; only ours {sorted(a - b)[:3]}; only sql {sorted(b - a)[:3]}", len(mine)


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = f"{ROOT}/{sys.argv[1]}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    todo, sqls = queries(), oracle_sql()
    bad = 0
    for name in sys.argv[2:] or list(todo):
        start = time.time()
        if name not in sqls:
            print(f"{name:26s} no sql", flush=True)
            continue
        try:
            diff, n = compare(todo[name](spark, folder), con, sqls[name])
        except Exception as e:  # report and go on
            diff, n = f"{type(e).__name__} {str(e)[:300]}", -1
        bad += bool(diff)
        print(f"{name:26s} {n:7d} {time.time() - start:6.2f}s {'DIFF ' + diff if diff else 'ok'}", flush=True)
    print(f"{bad} differ", flush=True)


if __name__ == "__main__":
    main()
