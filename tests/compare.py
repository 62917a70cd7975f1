"""Runs registered queries beside their SQL and reports differences."""

from __future__ import annotations

import importlib
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def spark_session(cores: int = 8):
    from signalloom.session import build_session
    from pyspark.sql import SparkSession
    SparkSession.builder.master(f"local[{cores}]")
    spark = build_session("checks", **{
        "spark.master": f"local[{cores}]", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(_value(r[i]) for i in order) for r in rows))


def compare(spark, con, name, query, sql, sf):
    start = time.time()
    df = query(spark, sf)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return f"{len(got[1])} rows, no SQL", took, True
    rel = con.execute(sql)
    want = normal([d[0] for d in rel.description], rel.fetchall())
    if got == want:
        return f"{len(got[1])} rows match", took, True
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}", took, False
    only_got = [r for r in got[1] if r not in set(want[1])][:3]
    only_want = [r for r in want[1] if r not in set(got[1])][:3]
    return (f"{len(got[1])} / {len(want[1])} rows\n   spark: {only_got}\n   sql:   {only_want}",
            took, False)


def main(sf: str, picked: list[str]) -> int:
    entry = importlib.import_module("__spark_entry__")
    spark, con = spark_session(), duck(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if picked and not any(p in name for p in picked):
            continue
        try:
            text, took, ok = compare(spark, con, name, query, sqls.get(name), sf)
        except Exception as error:
            text, took, ok = f"{type(error).__name__}: {str(error)[:700]}", 0.0, False
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {took:6.2f}s  {text}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
