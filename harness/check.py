"""Run registered queries next to their oracle SQL, the way the driver does.

    python -m harness.check [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("ledger-check")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # small local files: split them over the cores all the same
        .config("spark.sql.files.openCostInBytes", "262144")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, Decimal):
        return round(float(value), 6) + 0.0
    if isinstance(value, int):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def multiset(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, name: str, query, sql: str | None, sf_dir: str) -> str:
    started = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()
    took = time.time() - started
    if sql is None:
        return f"rows  {name}: {len(rows)} rows, {took:.2f}s (no oracle)"
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"FAIL  {name}: columns {sorted(df.columns)} vs {sorted(names)}"
    got, expected = multiset(df.columns, rows), multiset(names, expected_rows)
    if got != expected:
        extra, missing = list((got - expected).items())[:2], list((expected - got).items())[:2]
        return (
            f"FAIL  {name}: {len(rows)} vs {len(expected_rows)} rows; columns {sorted(names)}\n"
            f"      only spark  {extra}\n      only oracle {missing}"
        )
    types = {n: str(t) for n, t in zip(names, [c[1] for c in result.description])}
    kinds = " ".join(f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}" for f in df.schema
                     if not _same_type(f.dataType.simpleString(), types[f.name]))
    return f"{'ok   ' if not kinds else 'TYPES'} {name}: {len(rows)} rows, {took:.2f}s {kinds}"


def _same_type(spark_type: str, duck_type: str) -> bool:
    pairs = {
        "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
    }
    if spark_type.startswith("decimal"):
        return duck_type.upper() == spark_type.upper()
    return pairs.get(spark_type, spark_type) == duck_type


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    entry = importlib.import_module("__spark_entry__")
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark, con = local_session(), oracle_connection(args.sf)
    failed = 0
    for name, query in queries.items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        try:
            line = compare(spark, con, name, query, oracle.get(name), args.sf)
        except Exception as error:  # report and go on with the next query
            line = f"ERROR {name}: {type(error).__name__}: {str(error)[:900]}"
        failed += line.startswith(("FAIL", "ERROR"))
        print(line, flush=True)
    orphans = set(oracle) - set(queries)
    if orphans:
        print("oracle without query:", orphans)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
