"""Run registered queries on Spark and their SQL twins on DuckDB and compare
(row count, column names and types, order-insensitive values).

Used by the tests and by ``python -m scholarmetrics.plans.compare <sf_dir>``.
Only query *results* come to the driver here — this is a checking tool, not an
operator.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

from pyspark.sql import SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Session settings under which every hot-key detection runs on the fixtures.
SPLIT_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.shuffle.partitions": "200",
}

_SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    return v


def compare_one(spark: SparkSession, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    spark_types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    s_rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_types = list(zip(rel.columns, [str(t) for t in rel.types]))
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    t2 = time.time()
    problems = []
    if [n for n, _ in spark_types] != [n for n, _ in d_types]:
        problems.append(f"columns {spark_types} vs {d_types}")
    else:
        for (n, st), (_, dt) in zip(spark_types, d_types):
            if _SPARK_TO_DUCK.get(st, st.upper()) != dt:
                problems.append(f"type {n}: spark {st} vs duckdb {dt}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} vs {len(d_rows)}")
    elif Counter(s_rows) != Counter(d_rows):
        diff = list((Counter(s_rows) - Counter(d_rows)).items())[:3]
        diff2 = list((Counter(d_rows) - Counter(s_rows)).items())[:3]
        problems.append(f"values differ: spark-only {diff} duck-only {diff2}")
    return {
        "name": name,
        "ok": not problems,
        "rows": len(s_rows),
        "spark_sec": round(t1 - t0, 2),
        "duck_sec": round(t2 - t1, 2),
        "problems": problems,
    }


def main(argv: list[str]) -> int:
    import os

    force_split = "--force-skew-split" in argv
    argv = [a for a in argv if a != "--force-skew-split"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    sys.path.insert(0, os.getcwd())
    from scholarmetrics.plans.catalog import QUERIES
    from scholarmetrics.plans.oracle import ORACLE_SQL

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if force_split:
        # keys above 5/200 of the rows are salted
        for k, v in SPLIT_CONF.items():
            spark.conf.set(k, v)
    con = duck_connection(sf_dir)
    qs, sqls = QUERIES, ORACLE_SQL
    bad = 0
    for name in sorted(qs):
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"-- {name}: rows-only {n} ({time.time() - t0:.1f}s)")
            continue
        r = compare_one(spark, con, name, qs[name], sqls[name], sf_dir)
        bad += not r["ok"]
        flag = "ok " if r["ok"] else "BAD"
        print(f"{flag} {name}: rows={r['rows']} spark={r['spark_sec']}s duck={r['duck_sec']}s {r['problems']}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
