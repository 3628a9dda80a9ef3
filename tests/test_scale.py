"""Queries whose work has to spread over tasks, whatever the layout of the tables."""

import datetime as dt
from decimal import Decimal

from helpers import grid
from pyspark.sql import functions as F

from harness import load_queries
from harness import statements as W
from harness.views import Views
from ledgermill import schemas as S
from ledgermill.operators import extract
from ledgermill.plans import reports
from ledgermill.sources import csv_lines, sinks, workbook_cells
from ledgermill.sources.tables import LedgerTables


def customers(spark, folder, n=200):
    rows = spark.range(1, n + 1).select(
        F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"),
        (F.col("id") % 25).cast("int").alias("c_nationkey"), F.lit(1.5).alias("c_acctbal"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return Views(spark, folder)


def test_workbooks_of_one_piece_are_decoded_by_many_tasks(spark, folder):
    grid = workbook_cells.workbook_grid(load_queries.workbook_files(customers(spark, folder)))
    tasks = grid.select("path", F.spark_partition_id().alias("task")).distinct().groupBy("task").count().collect()
    assert len(tasks) > spark.sparkContext.defaultParallelism
    assert sum(r["count"] for r in tasks) == 200 and max(r["count"] for r in tasks) < 50


def test_months_of_all_merchants_are_laid_out_behind_the_last_shuffle(spark):
    rows = [(dt.date(2024, 5, 1), "1", "2.50"), (dt.date(2024, 5, 1), "1", "1.00"), (dt.date(2024, 6, 1), "2", "7.00"),
            (dt.date(2024, 6, 1), None, "3.00"), (dt.date(2023, 1, 1), "3", "9.00"), (dt.date(2024, 6, 1), "3", None)]
    revenue = spark.createDataFrame([(d, m, x and Decimal(x), x and -Decimal(x)) for d, m, x in rows], "date date, mid string, total_residual decimal(18,2), house_residual decimal(18,2)")
    tables = LedgerTables(revenue=revenue, merchants=None, iso=None, adjustments=None, payments=None, sic_codes=None)
    report = reports.mid_insights(tables, "2024-05-01", "2024-06-15")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # printed from the result down
    found = {(r.mid, r.month.month): (r.total_residual, r.house_residual) for r in report.collect() if r.total_residual}
    assert report.count() == 4 * 3
    assert found == {("1", 5): (3.5, -3.5), ("2", 6): (7.0, -7.0), (None, 6): (3.0, -3.0)}


def test_lines_of_one_split_are_sorted_by_many_tasks(spark, folder, monkeypatch):
    with open(f"{folder}/one.csv", "w") as f:
        f.write("".join(f'{i},"a\n\n{i}"\n\n' for i in range(200)))
    monkeypatch.setattr(csv_lines, "CHUNK_BITS", 4)
    lines = csv_lines.read_lines(spark, folder)
    windows = [p for p in csv_lines.records(lines)._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window" in p and "seq#" in p]
    assert windows and all("chunk#" in p.split("], [")[1] for p in windows)
    got = sorted((r.row_idx, r.record, r.problem) for r in csv_lines.records(lines).collect())
    assert got == [(i, f'{i},"a\n\n{i}"', None) for i in range(200)]
    with open(f"{folder}/one.csv", "a") as f:
        f.write('"never\n' + "x\n" * 50)
    assert [tuple(r) for r in csv_lines.records(csv_lines.read_lines(spark, folder)).select("row_idx", "record", "problem").collect()] == [(-1, "", "unclosed quote")]


def sales(spark, folder):
    """Customers with two orders of two lines each, in two months."""
    v = customers(spark, folder, 50)
    spark.sql("SELECT CAST(id AS INT) AS n_nationkey, concat('NATION_', id) AS n_name, CAST(id % 5 AS INT) AS n_regionkey FROM range(25)").write.parquet(f"{folder}/nation.parquet")
    spark.sql("SELECT id AS o_orderkey, 1 + id % 50 AS o_custkey, make_date(1996, CAST(1 + 8 * (id DIV 50) AS INT), 5) AS o_orderdate FROM range(100)").write.parquet(f"{folder}/orders.parquet")
    spark.sql("SELECT id DIV 2 AS l_orderkey, 100.0D AS l_extendedprice, 0.02D AS l_discount, 0.05D AS l_tax, TIMESTAMP_NTZ '1996-02-01 00:00:00' AS l_shipdate FROM range(200)").write.parquet(f"{folder}/lineitem.parquet")
    return v


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_views_ledger_is_derived_once_and_read_by_layout(spark, folder):
    v = sales(spark, folder)
    before = sorted(map(tuple, v.revenue.collect()), key=str)
    assert len(before) == 100
    for query in (lambda: load_queries.mixed_grid(v), lambda: W.payout_period(W.lines(v))):
        assert "l_orderkey" not in optimized(query())
    assert sorted(map(tuple, v.revenue.collect()), key=str) == before
    plan = load_queries.mixed_grid(v)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(family") >= len(load_queries.FAMILIES)


def test_edits_of_the_stored_ledger_are_derived_once(spark, folder):
    ledger = [(dt.date(2024, 5, 1), "Alpha", m, "d", Decimal(1), Decimal(1), Decimal(1), None, None, None, None, None, None, "me", dt.datetime(2024, 6, 1)) for m in "12"]
    sinks.append_ledger(spark.createDataFrame(ledger, S.LEDGER_SCHEMA), f"{folder}/revenue")
    derived = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            derived.add(len(b))
            yield b

    keys = spark.createDataFrame([(dt.date(2024, 5, 1), "Alpha", "1"), (dt.date(2024, 5, 1), "Alpha", "9")], "date date, iso string, mid string").mapInPandas(seen, "date date, iso string, mid string")
    done = sinks.delete_lines(spark, keys, f"{folder}/revenue")
    assert [r.mid for r in done.table.collect()] == ["2"] and [r.mid for r in done.refused.collect()] == ["9"]
    assert derived.value == 2


def test_dates_and_ids_are_worked_out_once_a_line(spark):
    head = ["Partner ID", "Referred Merchant Company Name", "Gross Processing Volume", "Total Payout (less delivery)", "Commission Payout Date"]
    g = grid(spark, {"S": [head, [1, "A", "$2", 3, "2024-05-09"], [1, "A", "1", 4, "5/2/2024"], [2, "B", "1", 4, "2024-06-01"], [3, "C", "1", 4, "soon"]]}, path="X May 2024.csv")
    lines = extract.read_layout(g, "payout_period")
    assert sorted((r.mid, r.volume, r.house_residual, r.reject) for r in lines.collect()) == [("1", 3.0, 7.0, None), ("3", 1.0, 4.0, "unreadable_date")]
    assert optimized(lines).count(r"\p{L}{4,}") == 1  # the shape of a date
