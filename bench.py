"""Headline queries on one machine; prints one JSON line.

The ledger and the statement grids are stored tables in real use, so they are derived from the
test tables once, written, and reported as ``setup``; each query then reads the stored tables.
Every query is run once to warm up and timed as the median of up to three further runs (fewer
once ten seconds are spent on it).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness import statements as W  # noqa: E402
from harness.check import local_session  # noqa: E402
from harness.load_queries import ledger_changes, lump_sums, merchant_changes, month_keys, payment_changes, statement_lines  # noqa: E402
from harness.statement_queries import file_names, registry  # noqa: E402
from harness.views import Views  # noqa: E402
from ledgermill.operators import changes, column_blocks, extract, form_sheets, identity, load  # noqa: E402
from ledgermill.plans import dimensions, reports  # noqa: E402
from ledgermill.sources import sinks  # noqa: E402
from ledgermill.sources.tables import TABLE_SCHEMAS, scan_tables  # noqa: E402

START, END = "1995-01-01", "2001-08-01"
GRIDS = ("generic", "net_collections", "multi_sheet", "first_valid_sheet", "payout_period", "form_per_sheet", "column_blocks")


def store(v: Views, folder: str) -> None:
    sinks.append_ledger(v.revenue, f"{folder}/revenue")
    for name in TABLE_SCHEMAS:
        if name != "revenue":
            getattr(v, name).write.parquet(f"{folder}/{name}")


def queries(spark, v: Views, folder: str) -> dict:
    t = scan_tables(spark, folder)
    v.__dict__.update(t.__dict__)
    v.__dict__["tables"] = t
    out = {
        name: (lambda plan=plan: plan(t)) for name, plan in {
            "rpt_volume_month": reports.volume_month, "rpt_revenue_month": reports.revenue_month, "rpt_active_mids": reports.active_mids,
            "rpt_referral_type": reports.referral_type_residual, "rpt_revenue_per_mid": reports.revenue_per_mid,
            "rpt_revenue_per_corporation": reports.revenue_per_corporation, "rpt_negative_revenue": reports.negative_revenue,
            "rpt_revenue_per_industry": reports.revenue_per_industry, "rpt_agents_payout": reports.agents_payout,
            "rpt_unique_agents": reports.unique_agents, "rpt_iso_month": reports.iso_month, "rpt_payments_recon": reports.payments_recon,
            "rpt_iso_lines": reports.iso_lines, "rpt_agent_lines": reports.agent_lines, "dim_merchants": dimensions.merchants,
            "dim_unique_corporations": dimensions.unique_corporations,
        }.items()
    }
    out |= {
        "rpt_mid_insights": lambda: reports.mid_insights(t, START, END), "rpt_agent_trend": lambda: reports.agent_trend(t, START, END),
        "rpt_mid_trend": lambda: reports.mid_trend(t, START, END), "rpt_iso_month_one": lambda: reports.iso_month(t, "1996-01-01"),
        "stmt_identity": lambda: identity.identify(file_names(v), registry(v)),
        "load_quarantine": lambda: load.check_lines(spark.read.parquet(f"{folder}/lines"), t.merchants),
        "load_already_loaded_prefix": lambda: load.already_loaded(spark.read.parquet(f"{folder}/lines").select("path", "date", "iso").distinct(), t.revenue, "prefix"),
        "load_manual_revenue": lambda: load.manual_revenue(lump_sums(v), t.revenue, "bench", "2002-01-01")[0],
        "chg_merchants_upsert": lambda: changes.merchants_upsert(t.merchants, merchant_changes(v)).table,
        "chg_payments_upsert": lambda: changes.payments_upsert(t.payments, payment_changes(v)).table,
        "chg_ledger_update": lambda: changes.ledger_update(t.revenue, ledger_changes(v)).table,
        "chg_iso_month_delete": lambda: changes.iso_month_delete(t.revenue, month_keys(v), "bench").table,
    }

    def layout(name: str):
        grid = spark.read.parquet(f"{folder}/grid_{name}")
        if name == "form_per_sheet":
            return form_sheets.form_per_sheet(grid)
        if name == "column_blocks":
            return column_blocks.column_blocks(grid)
        if name == "generic":
            return extract.read_layout(grid.withColumnRenamed("iso", "layout"), name, registry(v))
        return extract.read_layout(grid, name)

    return out | {f"layout_{name}": (lambda name=name: layout(name)) for name in GRIDS}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # a cluster needs a folder that its executors share
    folder = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="ledger-bench-")
    spark = local_session(cpus, **{"spark.checkpoint.dir": folder, "spark.python.sql.dataFrameDebugging.enabled": "false"})
    v = Views(spark, sf_dir)
    started = time.time()
    store(v, folder)
    stored = Views(spark, sf_dir)
    stored.__dict__.update(scan_tables(spark, folder).__dict__)
    statement_lines(stored).write.parquet(f"{folder}/lines")
    lines = W.lines(stored)
    for name in GRIDS:
        W.WRITERS[name](lines).write.parquet(f"{folder}/grid_{name}")
    setup = time.time() - started
    only = sys.argv[1:]
    timings = {}
    for name, make in queries(spark, Views(spark, sf_dir), folder).items():
        if only and not any(name.startswith(p) for p in only):
            continue
        runs = []
        for _ in range(4):
            begin = time.time()
            make().write.format("noop").mode("overwrite").save()
            runs.append(time.time() - begin)
            if len(runs) > 1 and sum(runs) > 10:
                break
        timings[name] = round(statistics.median(runs[1:]), 3)
        print(name, timings[name], [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "setup": round(setup, 3), "cpus": cpus, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
