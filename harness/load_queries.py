"""Registered queries of the load pipeline, change sets, sources and sinks."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harness import statements as W
from harness.oracle_views import with_views
from harness.report_queries import AS_OF, ORACLE as REPORTS
from harness.statement_queries import DASHED, GARBLED, LAYOUTS, registry
from harness.views import Views
from ledgermill.operators import changes, grids, identity, load
from ledgermill.plans import reports
from ledgermill.schemas import LEDGER_COLUMNS
from ledgermill.sources import csv_cells, keyed_tables, merchant_bulk, sinks, workbook_cells
from ledgermill.sources.tables import TABLE_SCHEMAS, scan_tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
CLOCK = "2002-01-01 00:00:00"


def register(name: str, make, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: make(Views(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = with_views(sql)


def register_stored(name: str, make, in_memory: str) -> None:
    """A stored change: the same rows as the change in memory."""
    QUERIES[name] = lambda spark, sf_dir: make(Views(spark, sf_dir))
    ORACLE[name] = ORACLE[in_memory]


# --- guards and merchant checks -------------------------------------------------------------
def claims(v: Views) -> DataFrame:
    """One statement per partner and order month, under the partner's name; months are moved on, so that
    the ledger has only some of them."""
    orders = v.read("orders").join(v.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(
        F.add_months(F.trunc("o_orderdate", "month"), 40).alias("date"),
        F.concat(F.lit("NATION_"), (F.col("c_nationkey") % 13).cast("string")).alias("iso"),
    ).distinct().withColumn("path", F.concat_ws(" ", "iso", F.col("date").cast("string")))


CLAIMS = """(SELECT DISTINCT CAST(date_trunc('month', o_orderdate) + INTERVAL 40 MONTH AS DATE) AS date, concat('NATION_', CAST(c_nationkey % 13 AS VARCHAR)) AS iso
  FROM orders JOIN customer ON o_custkey = c_custkey) s"""
for _match, _on in (("exact", "r.iso = s.iso"), ("prefix", "starts_with(r.iso, s.iso)")):
    register(f"load_already_loaded_{_match}",
             lambda v, m=_match: load.already_loaded(claims(v), v.revenue, m).select("path", "date", "iso"),
             f"""SELECT concat(iso, ' ', CAST(date AS VARCHAR)) AS path, date, iso FROM {CLAIMS}
WHERE EXISTS (SELECT 1 FROM revenue r WHERE r.date = s.date AND {_on})""")
    register(f"load_not_loaded_{_match}",
             lambda v, m=_match: load.not_loaded(claims(v), v.revenue, m).select("path", "date", "iso"),
             f"""SELECT concat(iso, ' ', CAST(date AS VARCHAR)) AS path, date, iso FROM {CLAIMS}
WHERE NOT EXISTS (SELECT 1 FROM revenue r WHERE r.date = s.date AND {_on})""")


def mixed_case(v: Views) -> DataFrame:
    """Claims whose names are written in lower case for every other month, and as they are for the rest."""
    return claims(v).withColumn("iso", F.when(F.month("date") % 2 == 0, F.lower("iso")).otherwise(F.col("iso")))


_CASED = f"(SELECT date, CASE WHEN EXTRACT(MONTH FROM date) % 2 = 0 THEN lower(iso) ELSE iso END AS iso, concat(iso, ' ', CAST(date AS VARCHAR)) AS path FROM {CLAIMS}) s"
_SAME = "EXISTS (SELECT 1 FROM revenue r WHERE r.date = s.date AND lower(r.iso) = lower(s.iso))"
register("load_already_loaded_caseless", lambda v: load.already_loaded(mixed_case(v), v.revenue, "caseless").select("path", "date", "iso"),
         f"SELECT path, date, iso FROM {_CASED} WHERE {_SAME}")
register("load_not_loaded_caseless", lambda v: load.not_loaded(mixed_case(v), v.revenue, "caseless").select("path", "date", "iso"),
         f"SELECT path, date, iso FROM {_CASED} WHERE NOT {_SAME}")


def statement_lines(v: Views) -> DataFrame:
    """Ledger lines as freshly extracted ones: twice per merchant, some ids unknown, some names empty."""
    rows = W.lines(v)
    mid = F.when(F.col("pos") % 40 == 1, F.concat("mid", F.lit("9"))).otherwise(F.col("mid"))
    name = F.when(F.col("pos") % 4 != 0, F.concat(F.lit("Shop "), F.col("pos").cast("string")))
    return rows.select(
        "path", F.lit(0).alias("sheet_idx"), F.explode(F.array(2 * F.col("pos"), 2 * F.col("pos") + 1)).alias("row_idx"),
        "iso", "date", mid.alias("mid"), name.alias("dba"),
        *[F.col(c).cast("double").alias(c) for c in ("volume", "total_residual", "house_residual")],
        F.lit(None).cast("string").alias("reject"),
    )


LINES = """(SELECT path, 0 AS sheet_idx, 2 * pos + k AS row_idx, k, iso, date, CASE WHEN pos % 40 = 1 THEN concat(mid, '9') ELSE mid END AS mid,
  CASE WHEN pos % 4 <> 0 THEN concat('Shop ', CAST(pos AS VARCHAR)) END AS dba, volume, total_residual, house_residual
  FROM stmt_lines CROSS JOIN (VALUES (0), (1)) d(k)) l"""
register("load_missing_mids", lambda v: load.missing_mids(statement_lines(v), v.merchants).select("path", "row_idx", "mid"),
         f"SELECT path, row_idx, mid FROM {LINES} WHERE NOT EXISTS (SELECT 1 FROM merchants m WHERE m.mid = l.mid)")
register("load_dba_override", lambda v: load.override_dba(statement_lines(v), v.merchants).select("path", "row_idx", "mid", "dba"),
         f"SELECT path, row_idx, l.mid, CASE WHEN k = 0 AND m.mid IS NOT NULL THEN m.dba ELSE l.dba END AS dba FROM {LINES} LEFT JOIN merchants m ON m.mid = l.mid")
register("load_dba_fill_missing",
         lambda v: load.override_dba(statement_lines(v), v.merchants, "fill_missing").select("path", "row_idx", "mid", "dba"),
         f"SELECT path, row_idx, l.mid, COALESCE(l.dba, m.dba) AS dba FROM {LINES} LEFT JOIN merchants m ON m.mid = l.mid")
SHARE = "CAST(ROUND(house_residual * m.agent{i}_split * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))"
AGENT_SQL = f"""CASE WHEN m.is_referred = 1 THEN m.agent1_name END AS agent1_name, CASE WHEN m.is_referred = 1 THEN m.agent1_split END AS agent1_percentage,
  CASE WHEN m.is_referred = 1 THEN {SHARE.format(i=1)} END AS agent1_payout,
  CASE WHEN m.is_referred = 1 THEN m.agent2_name END AS agent2_name, CASE WHEN m.is_referred = 1 THEN m.agent2_split END AS agent2_percentage,
  CASE WHEN m.is_referred = 1 AND m.agent2_split <> 0 AND house_residual <> 0 THEN {SHARE.format(i=2)} END AS agent2_payout"""
AGENT_OUT = ("agent1_name", "agent1_percentage", "agent1_payout", "agent2_name", "agent2_percentage", "agent2_payout")
register("load_agent_payout", lambda v: load.agent_payouts(statement_lines(v), v.merchants).select("path", "row_idx", "mid", *AGENT_OUT),
         f"SELECT path, row_idx, l.mid, {AGENT_SQL} FROM {LINES} LEFT JOIN merchants m ON m.mid = l.mid")
register("load_quarantine", lambda v: load.check_lines(statement_lines(v), v.merchants).select("path", "row_idx", "mid", "dba", "agent1_payout", "reject"), f"""
SELECT path, row_idx, l.mid, CASE WHEN k = 0 THEN m.dba ELSE l.dba END AS dba, CASE WHEN m.is_referred = 1 THEN {SHARE.format(i=1)} END AS agent1_payout,
  CASE WHEN m.mid IS NULL THEN 'missing_merchant' WHEN bool_or(m.mid IS NULL) OVER (PARTITION BY path) THEN 'statement_rejected' END AS reject
FROM {LINES} LEFT JOIN merchants m ON m.mid = l.mid""")


def lump_sums(v: Views) -> DataFrame:
    """An entry per order, for a partner and month that may be there already."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return v.read("orders").select(
        F.col("o_orderkey").alias("seq"),
        F.add_months(F.trunc("o_orderdate", "month"), 24).alias("date"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 30).cast("string")).alias("iso"),
        F.when(F.col("o_orderkey") % 17 != 0, amount).alias("amount"),
    )


LUMPS = """lumps AS (SELECT o_orderkey AS seq, CAST(date_trunc('month', o_orderdate) + INTERVAL 24 MONTH AS DATE) AS date,
  concat('NATION_', CAST(o_custkey % 30 AS VARCHAR)) AS iso, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount FROM orders),
judged AS (SELECT l.*, CASE WHEN amount IS NULL THEN 'missing_fields'
    WHEN EXISTS (SELECT 1 FROM (SELECT DISTINCT date, iso FROM revenue) r WHERE r.date = l.date AND r.iso = l.iso) THEN 'already_loaded'
    WHEN seq > MIN(CASE WHEN amount IS NOT NULL THEN seq END) OVER (PARTITION BY date, iso) THEN 'duplicate_in_batch' END AS reason FROM lumps l)"""
register("load_manual_revenue",
         lambda v: load.manual_revenue(lump_sums(v), v.revenue, "loader", CLOCK)[0].select(*LEDGER_COLUMNS[:7], "updated_by"),
         f"""WITH {LUMPS} SELECT date, iso, '111123456' AS mid, iso AS dba, CAST(0 AS DECIMAL(18,2)) AS volume, amount AS total_residual, amount AS house_residual,
  'loader' AS updated_by FROM judged WHERE reason IS NULL""")
register("load_manual_revenue_refused", lambda v: load.manual_revenue(lump_sums(v), v.revenue, "loader", CLOCK)[1],
         f"WITH {LUMPS} SELECT seq, date, iso, amount, reason FROM judged WHERE reason IS NOT NULL")

# --- the whole chain ------------------------------------------------------------------------
FAMILIES = [f for f in W.WRITERS if f != "column_blocks"]
RULES = [identity.Rule("equals", f"NATION_{k}", FAMILIES[k % len(FAMILIES)]) for k in range(25)]
LOADED_BEFORE = "1996-07-01"


def mixed_grid(v: Views) -> DataFrame:
    """The whole ledger as statements, each partner in its own layout. Dashed ids, which no
    merchant has, occur in March only."""
    W.derive_once(v)
    names = F.array(*[F.lit(f) for f in FAMILIES])
    rows = W.lines(v).withColumn("dashes", F.month("date") == 3).withColumn("family", F.get(names, (F.col("id") - 1) % len(FAMILIES)))
    # split by family, so that each writer reads its own lines
    rows = staging(v)(rows, "grid")
    grid = None
    for family in FAMILIES:
        part = W.WRITERS[family](rows.filter(F.col("family") == family)).drop("iso", "date")
        grid = part if grid is None else grid.unionByName(part)
    return grid


def staging(v: Views):
    return sinks.stage_in(v.spark, sinks.shared_folder(v.spark))


def mixed_load(v: Views) -> load.LoadResult:
    return load_grid(v, staging(v)(mixed_grid(v), "fixture_grid"))


def load_grid(v: Views, grid: DataFrame) -> load.LoadResult:
    names = identity.identify(grid.select("path").distinct(), registry(v), RULES)
    before = v.revenue.filter(F.col("date") < F.lit(LOADED_BEFORE).cast("date"))
    tables = type(v.tables)(**{**v.tables.__dict__, "revenue": before})
    return load.load_statements(grid, names, registry(v), tables, "loader", CLOCK, stage=staging(v))


def _mixed_expected() -> str:
    parts = []
    for k, family in enumerate(FAMILIES):
        sql = LAYOUTS[family].replace("CASE WHEN id % 5 = 0 THEN 0.0", "CASE WHEN (CASE WHEN id > 20 THEN 3 WHEN id > 10 THEN 2 ELSE id END) % 5 = 0 THEN 0.0")
        sql = sql.replace(DASHED, DASHED.replace("pos % 5 = 0", "pos % 5 = 0 AND EXTRACT(MONTH FROM date) = 3"))
        parts.append(sql.replace("SELECT ", "SELECT date, id, ", 1) + f" AND (id - 1) % {len(FAMILIES)} = {k}")
    return " UNION ALL ".join(parts)


MIXED = f"""extracted AS (SELECT * FROM ({_mixed_expected()}) e WHERE date >= DATE '{LOADED_BEFORE}'),
typed AS (SELECT x.*, m.mid IS NULL AS unknown, m.dba AS mdba, m.is_referred, m.agent1_name, m.agent1_split, m.agent2_name, m.agent2_split,
    CAST(x.house_residual AS DECIMAL(18,2)) AS house, ROW_NUMBER() OVER (PARTITION BY x.path, x.mid ORDER BY sheet_idx, row_idx) AS nth
  FROM extracted x LEFT JOIN merchants m ON m.mid = x.mid),
judged AS (SELECT *, COALESCE(reject, CASE WHEN unknown THEN 'missing_merchant' END,
    CASE WHEN bool_or(reject IS NOT NULL OR unknown) OVER (PARTITION BY path) THEN 'statement_rejected' END) AS verdict FROM typed)"""
register("load_statements", lambda v: mixed_load(v).rows.select(*LEDGER_COLUMNS[:13], "updated_by"), f"""WITH {MIXED}
SELECT date, iso, mid, CASE WHEN nth = 1 THEN mdba ELSE dba END AS dba, CAST(volume AS DECIMAL(18,2)) AS volume,
  CAST(total_residual AS DECIMAL(18,2)) AS total_residual, house AS house_residual,
  {AGENT_SQL.replace('m.', '').replace('house_residual', 'house')}, 'loader' AS updated_by
FROM judged WHERE verdict IS NULL""")
register("load_statements_rejected_lines", lambda v: mixed_load(v).lines.select("path", "sheet_idx", "row_idx", "mid", "reject"),
         f"WITH {MIXED} SELECT path, sheet_idx, row_idx, mid, verdict AS reject FROM judged WHERE verdict IS NOT NULL")


def load_again(v: Views) -> DataFrame:
    """Every statement a second time, against the ledger that the first load has written."""
    grid = staging(v)(mixed_grid(v), "fixture_grid")
    first = load_grid(v, grid)
    folder = f"{sinks.shared_folder(v.spark)}/again-{uuid.uuid4().hex}"
    sinks.append_ledger(v.revenue.filter(F.col("date") < F.lit(LOADED_BEFORE).cast("date")), folder)
    sinks.append_ledger(first.rows, folder)
    names = identity.identify(grid.select("path").distinct(), registry(v), RULES)
    tables = type(v.tables)(**{**v.tables.__dict__, "revenue": sinks.read_ledger(v.spark, folder)})
    second = load.load_statements(grid, names, registry(v), tables, "loader", CLOCK, stage=staging(v))
    return second.rows.select(*LEDGER_COLUMNS[:13], "updated_by")


register("load_statements_again", load_again, f"SELECT {', '.join(LEDGER_COLUMNS[:13])}, 'loader' AS updated_by FROM revenue WHERE FALSE")
register("load_statements_rejected", lambda v: mixed_load(v).statements, f"""WITH {MIXED}
SELECT DISTINCT path, 'statement_rejected' AS reason FROM judged WHERE verdict IS NOT NULL
UNION SELECT DISTINCT path, 'already_loaded' FROM (SELECT CASE WHEN (id - 1) % {len(FAMILIES)} = {FAMILIES.index('payout_period')} THEN full_path ELSE path END AS path
  FROM stmt_lines WHERE date < DATE '{LOADED_BEFORE}') b
UNION SELECT path, 'no_lines' FROM (SELECT DISTINCT CASE WHEN (id - 1) % {len(FAMILIES)} = {FAMILIES.index('payout_period')} THEN full_path ELSE path END AS path
  FROM stmt_lines WHERE date >= DATE '{LOADED_BEFORE}') n WHERE path NOT IN (SELECT path FROM judged)""")

EFFECTIVE = f"""SELECT path, sheet_idx, row_idx, iso FROM ({LAYOUTS['multi_sheet']}) e"""


def effective_iso(v: Views) -> DataFrame:
    from ledgermill.operators import extract

    return extract.read_layout(W.multi_sheet(W.lines(v)), "multi_sheet").select("path", "sheet_idx", "row_idx", "iso")


register("load_effective_iso", effective_iso, EFFECTIVE)

# --- change sets ----------------------------------------------------------------------------
MERCHANT_COLUMNS = """mid, dba, corporation, iso, iso_referral_type, sic_code, sic_description, approval_date, closed_date, is_active, is_referred,
  agent1_name, agent1_split, agent2_name, agent2_split"""


def merchant_changes(v: Views) -> DataFrame:
    """Two edits per merchant of every seventh kind, and new merchants from suppliers."""
    m = v.merchants.withColumn("k", F.substring("mid", 5, 12).cast("bigint"))
    edits = m.filter("k % 7 = 0").select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("round")).select(
        (F.col("k") * 2 + F.col("round")).alias("seq"), "mid", F.concat("dba", F.lit(" v"), F.col("round").cast("string")).alias("dba"),
        *[c for c in v.merchants.columns if c not in ("mid", "dba", "is_referred")], (F.col("k") % 2).cast("int").alias("is_referred"),
    )
    added = v.read("supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("seq"), F.concat(F.lit("7000"), F.col("s_suppkey").cast("string")).alias("mid"),
        F.col("s_name").alias("dba"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in v.merchants.schema
                                        if f.name not in ("mid", "dba", "is_referred", "agent1_name")],
        F.lit(0).alias("is_referred"), F.lit("Agent X").alias("agent1_name"),
    )
    return edits.unionByName(added)


def merchant_deletes(v: Views) -> DataFrame:
    k = F.col("o_custkey") * 13
    return v.read("orders").select(F.concat(F.lit("6354"), F.lpad(k.cast("string"), 12, "0")).alias("mid"))


register("chg_merchants_upsert", lambda v: changes.merchants_upsert(v.merchants, merchant_changes(v)).table, f"""
SELECT {MERCHANT_COLUMNS} FROM merchants WHERE CAST(substr(mid, 5) AS BIGINT) % 7 <> 0
UNION ALL SELECT mid, concat(dba, ' v2'), corporation, iso, iso_referral_type, sic_code, sic_description, approval_date, closed_date, is_active, CAST(k % 2 AS INT),
  CASE WHEN k % 2 = 1 THEN agent1_name END, CASE WHEN k % 2 = 1 THEN agent1_split END, CASE WHEN k % 2 = 1 THEN agent2_name END, CASE WHEN k % 2 = 1 THEN agent2_split END
  FROM (SELECT *, CAST(substr(mid, 5) AS BIGINT) AS k FROM merchants) m WHERE k % 7 = 0
UNION ALL SELECT concat('7000', CAST(s_suppkey AS VARCHAR)), s_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0, NULL, NULL, NULL, NULL FROM supplier""")
GONE = "(SELECT DISTINCT concat('6354', lpad(CAST(o_custkey * 13 AS VARCHAR), 12, '0')) AS mid FROM orders) d"
register("chg_merchants_delete", lambda v: changes.merchants_delete(v.merchants, merchant_deletes(v)).table,
         f"SELECT {MERCHANT_COLUMNS} FROM merchants m WHERE NOT EXISTS (SELECT 1 FROM {GONE} WHERE d.mid = m.mid)")
register("chg_merchants_delete_refused", lambda v: changes.merchants_delete(v.merchants, merchant_deletes(v)).refused,
         f"SELECT mid, 'not_found' AS reason FROM {GONE} WHERE NOT EXISTS (SELECT 1 FROM merchants m WHERE m.mid = d.mid)")


def iso_changes(v: Views) -> DataFrame:
    k = F.col("s_suppkey")
    return v.read("supplier").select(
        k.alias("seq"), F.when(k % 3 != 0, (k % 40).cast("int")).alias("id"), F.when(k % 11 != 0, F.col("s_name")).alias("iso"),
        F.when(k % 5 == 0, "Other").when(k % 5 == 1, "MID").otherwise("Gateway").alias("referral_type"), (k % 2).cast("int").alias("is_active"),
    )


ISO_CHANGES = """changes AS (SELECT s_suppkey AS seq, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 40 AS INT) END AS id, CASE WHEN s_suppkey % 11 <> 0 THEN s_name END AS iso,
  CASE s_suppkey % 5 WHEN 0 THEN 'Other' WHEN 1 THEN 'MID' ELSE 'Gateway' END AS referral_type, CAST(s_suppkey % 2 AS INT) AS is_active FROM supplier),
good AS (SELECT * FROM changes WHERE iso IS NOT NULL AND referral_type <> 'Other'),
edits AS (SELECT g.* FROM good g JOIN iso i ON i.id = g.id WHERE g.id <> 0),
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS n FROM edits) e WHERE n = 1),
added AS (SELECT CAST((SELECT MAX(id) FROM iso) + ROW_NUMBER() OVER (ORDER BY seq) AS INT) AS id, iso, referral_type, is_active FROM good WHERE COALESCE(id, 0) = 0)"""
register("chg_iso_upsert", lambda v: changes.iso_upsert(v.iso, iso_changes(v)).table, f"""WITH {ISO_CHANGES}
SELECT id, iso, referral_type, is_active FROM iso WHERE id NOT IN (SELECT id FROM latest)
UNION ALL SELECT id, iso, referral_type, is_active FROM latest UNION ALL SELECT id, iso, referral_type, is_active FROM added""")
register("chg_iso_upsert_refused", lambda v: changes.iso_upsert(v.iso, iso_changes(v)).refused, f"""WITH {ISO_CHANGES}
SELECT seq, id, iso, referral_type, is_active, CASE WHEN iso IS NULL THEN 'missing_fields' WHEN referral_type = 'Other' THEN 'invalid_referral_type' ELSE 'not_found' END AS reason
FROM changes c WHERE iso IS NULL OR referral_type = 'Other' OR (COALESCE(id, 0) <> 0 AND id NOT IN (SELECT id FROM iso))""")


def adjustment_changes(v: Views) -> DataFrame:
    k = F.col("c_custkey")
    return v.read("customer").select(
        k.alias("seq"), F.when(k % 2 == 0, k % 150).alias("id"), (F.col("c_nationkey") + 1).alias("iso_id"),
        F.make_date((1995 + k % 7).cast("int"), (1 + k % 12).cast("int"), F.lit(1)).alias("date"),
        F.when(k % 9 == 0, 0).otherwise(F.col("c_acctbal")).cast("decimal(18,2)").alias("adjustment_price"),
    )


ADJ_CHANGES = """changes AS (SELECT c_custkey AS seq, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 150 END AS id, c_nationkey + 1 AS iso_id,
  make_date(CAST(1995 + c_custkey % 7 AS INT), CAST(1 + c_custkey % 12 AS INT), 1) AS date,
  CAST(CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE c_acctbal END AS DECIMAL(18,2)) AS adjustment_price FROM customer),
good AS (SELECT * FROM changes WHERE adjustment_price <> 0),
latest AS (SELECT * FROM (SELECT g.*, ROW_NUMBER() OVER (PARTITION BY g.id ORDER BY seq DESC) AS n FROM good g JOIN adjustments a ON a.id = g.id WHERE g.id <> 0) e WHERE n = 1),
inserts AS (SELECT g.*, EXISTS (SELECT 1 FROM adjustments a WHERE a.iso_id = g.iso_id AND a.date = g.date) AS taken FROM good g WHERE COALESCE(g.id, 0) = 0),
winners AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iso_id, date ORDER BY seq) AS n FROM inserts WHERE NOT taken) w WHERE n = 1),
added AS (SELECT (SELECT MAX(id) FROM adjustments) + ROW_NUMBER() OVER (ORDER BY seq) AS id, iso_id, date, adjustment_price FROM winners)"""
register("chg_adjustments_upsert", lambda v: changes.adjustments_upsert(v.adjustments, adjustment_changes(v)).table, f"""WITH {ADJ_CHANGES}
SELECT id, iso_id, date, adjustment_price FROM adjustments WHERE id NOT IN (SELECT id FROM latest)
UNION ALL SELECT id, iso_id, date, adjustment_price FROM latest UNION ALL SELECT id, iso_id, date, adjustment_price FROM added""")
register("chg_adjustments_upsert_refused", lambda v: changes.adjustments_upsert(v.adjustments, adjustment_changes(v)).refused, f"""WITH {ADJ_CHANGES}
SELECT seq, id, iso_id, date, adjustment_price, 'missing_fields' AS reason FROM changes WHERE adjustment_price = 0
UNION ALL SELECT seq, id, iso_id, date, adjustment_price, 'not_found' FROM good WHERE COALESCE(id, 0) <> 0 AND id NOT IN (SELECT id FROM adjustments)
UNION ALL SELECT seq, id, iso_id, date, adjustment_price, 'already_exists' FROM inserts WHERE taken OR seq NOT IN (SELECT seq FROM winners)""")


def payment_changes(v: Views) -> DataFrame:
    k = F.col("o_orderkey")
    return v.read("orders").select(
        k.alias("seq"), (1 + F.col("o_custkey") % 30).cast("int").alias("iso_id"), F.trunc("o_orderdate", "month").alias("date"),
        F.when(k % 10 == 0, 0).otherwise(F.col("o_totalprice")).cast("decimal(18,2)").alias("bank_amount"),
    )


PAY_CHANGES = """changes AS (SELECT o_orderkey AS seq, CAST(1 + o_custkey % 30 AS INT) AS iso_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_totalprice END AS DECIMAL(18,2)) AS bank_amount FROM orders),
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iso_id, date ORDER BY seq DESC) AS n FROM changes WHERE bank_amount <> 0) c WHERE n = 1)"""
register("chg_payments_upsert", lambda v: changes.payments_upsert(v.payments, payment_changes(v)).table, f"""WITH {PAY_CHANGES}
SELECT COALESCE(p.iso_id, l.iso_id) AS iso_id, COALESCE(p.date, l.date) AS date, COALESCE(l.bank_amount, p.bank_amount) AS bank_amount
FROM payments p FULL JOIN latest l ON l.iso_id = p.iso_id AND l.date = p.date""")

LEDGER = "date, iso, mid, dba, volume, total_residual, house_residual, agent1_name, agent1_percentage, agent1_payout, agent2_name, agent2_percentage, agent2_payout, updated_by, updated_at"


def ledger_changes(v: Views) -> DataFrame:
    """Corrections of every negative line, half of them with another merchant id, and some for
    lines that do not exist."""
    pos = F.substring("mid", 5, 12).cast("bigint")
    return v.revenue.filter("house_residual < 0").select(
        pos.alias("seq"), F.when(pos % 10 == 3, F.add_months("date", 600)).otherwise(F.col("date")).alias("date"), "iso",
        F.col("mid").alias("old_mid"), F.when(pos % 2 == 0, F.concat("mid", F.lit("0"))).otherwise(F.col("mid")).alias("mid"),
        F.concat("dba", F.lit(" fixed")).alias("dba"), "volume", "total_residual", (-F.col("house_residual")).alias("house_residual"),
        *AGENT_OUT,
    )


register("chg_ledger_update", lambda v: changes.ledger_update(v.revenue, ledger_changes(v)).table, f"""
SELECT {LEDGER.replace(' mid,', " CASE WHEN hit AND pos % 2 = 0 THEN concat(mid, '0') ELSE mid END AS mid,").replace(' dba,', " CASE WHEN hit THEN concat(dba, ' fixed') ELSE dba END AS dba,").replace('house_residual', 'CAST(CASE WHEN hit THEN -house_residual ELSE house_residual END AS DECIMAL(18,2)) AS house_residual')}
FROM (SELECT *, CAST(substr(mid, 5) AS BIGINT) AS pos, house_residual < 0 AND CAST(substr(mid, 5) AS BIGINT) % 10 <> 3 AS hit FROM revenue) r""")
register("chg_ledger_update_refused", lambda v: changes.ledger_update(v.revenue, ledger_changes(v)).refused, """
SELECT CAST(date + INTERVAL 600 MONTH AS DATE) AS date, iso, mid, 'not_found' AS reason FROM revenue WHERE house_residual < 0 AND CAST(substr(mid, 5) AS BIGINT) % 10 = 3""")


def ledger_keys(v: Views) -> DataFrame:
    return ledger_changes(v).select("date", "iso", F.col("old_mid").alias("mid"))


register("chg_ledger_delete", lambda v: changes.ledger_delete(v.revenue, ledger_keys(v)).table,
         f"SELECT {LEDGER} FROM revenue WHERE NOT (house_residual < 0 AND CAST(substr(mid, 5) AS BIGINT) % 10 <> 3)")


def month_keys(v: Views) -> DataFrame:
    """Partner-months of the suppliers' adjustments."""
    return v.adjustments.join(v.iso, F.col("iso_id") == v.iso["id"]).select("date", "iso")


MONTH_KEYS = "(SELECT DISTINCT a.date, i.iso FROM adjustments a JOIN iso i ON i.id = a.iso_id) k"
register("chg_iso_month_delete", lambda v: changes.iso_month_delete(v.revenue, month_keys(v), "auditor").table,
         f"SELECT {LEDGER} FROM revenue r WHERE NOT EXISTS (SELECT 1 FROM {MONTH_KEYS} WHERE k.date = r.date AND k.iso = r.iso)")
register("chg_iso_month_delete_audit", lambda v: changes.iso_month_delete(v.revenue, month_keys(v), "auditor").audit,
         f"SELECT date, iso, 'auditor' AS deleted_by FROM {MONTH_KEYS} WHERE EXISTS (SELECT 1 FROM revenue r WHERE k.date = r.date AND k.iso = r.iso)")
register("chg_iso_month_delete_refused", lambda v: changes.iso_month_delete(v.revenue, month_keys(v), "auditor").refused,
         f"SELECT date, iso, 'not_found' AS reason FROM {MONTH_KEYS} WHERE NOT EXISTS (SELECT 1 FROM revenue r WHERE k.date = r.date AND k.iso = r.iso)")

# --- sources and sinks ----------------------------------------------------------------------
def stored_tables(v: Views) -> DataFrame:
    """All tables written to the shared folder, the ledger read back by the table source."""
    folder = f"{sinks.shared_folder(v.spark)}/tables-{uuid.uuid4().hex}"
    sinks.append_ledger(v.revenue, f"{folder}/revenue")
    for name in TABLE_SCHEMAS:
        if name != "revenue":
            getattr(v, name).write.parquet(f"{folder}/{name}")
    return scan_tables(v.spark, folder).revenue


register("src_tables", stored_tables, f"SELECT {LEDGER} FROM revenue")


CSV_FILES = 8


def csv_folder(v: Views) -> str:
    """CSV files of many orders each: quotes, a line break in a field, blank lines, empty cells. Written as lines of one column whose
    separator and quote do not occur, so that they stay as they are."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    lines = F.array(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(',"say ""hi"", '), "o_orderpriority"), F.concat(F.lit('next",$'), price),
        F.lit("  "), F.lit(',NA,5" pipe'), F.lit('"",x,"tail"'))
    orders = v.read("orders").withColumn("file", F.col("o_orderkey") % CSV_FILES)
    rows = orders.select("file", "o_orderkey", F.posexplode(lines).alias("nth", "line")).repartition(CSV_FILES, "file").sortWithinPartitions("file", "o_orderkey", "nth")
    folder = f"{sinks.shared_folder(v.spark)}/csv-{uuid.uuid4().hex}"
    plain = {"sep": "\x01", "quote": "\x02", "escape": "\x02", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "lineSep": "\n"}
    rows.select("file", "line").write.partitionBy("file").options(**plain).csv(folder)
    return folder


def cells_of(grid: DataFrame) -> DataFrame:
    return grids.to_cells(grid).select("path", "sheet_idx", "sheet", "is_active", "row_idx", "col_idx", "value", "kind")


def csv_cells_of_files(v: Views) -> DataFrame:
    """Read in splits; the file's number stands for its path."""
    cells = cells_of(csv_cells.read_csv_grid(v.spark, csv_folder(v)))
    return cells.withColumn("path", F.regexp_extract("path", r"file=(\d+)/[^/]*$", 1))


register("src_csv_cells", csv_cells_of_files, f"""
SELECT CAST(o_orderkey % {CSV_FILES} AS VARCHAR) AS path, 0 AS sheet_idx, 'CSV' AS sheet, true AS is_active,
  CAST(3 * (row_number() OVER (PARTITION BY o_orderkey % {CSV_FILES}, c.r, c.c ORDER BY o_orderkey) - 1) + c.r AS BIGINT) AS row_idx, c.c AS col_idx,
  CASE c.v WHEN 'KEY' THEN CAST(o_orderkey AS VARCHAR) WHEN 'NOTE' THEN concat('say "hi", ', o_orderpriority, chr(10), 'next')
    WHEN 'PRICE' THEN concat('$', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)) ELSE c.v END AS value, 's' AS kind
FROM orders CROSS JOIN (VALUES (0, 0, 'KEY'), (0, 1, 'NOTE'), (0, 2, 'PRICE'), (1, 2, '5" pipe'), (2, 1, 'x'), (2, 2, 'tail')) c(r, c, v)""")


def document_rows(v: Views) -> DataFrame:
    """Every document's whole text as one file; the text holds no delimiter rules of its own, so
    rows are its non-blank lines as the CSV reader sees them."""
    files = v.read("documents").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return csv_cells.csv_grid(files).groupBy("path").agg(F.count("*").alias("n_rows"), F.sum(F.size("cells")).cast("bigint").alias("n_cells"))


register("src_csv_documents", document_rows, None)

_XML = "http://schemas.openxmlformats.org/"


def _workbook(name: str, amount: str, key: int) -> bytes:
    """A workbook with shared and inline text, numbers, dates, booleans, errors and formulas."""
    main = f'xmlns="{_XML}spreadsheetml/2006/main"'
    parts = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{_XML}officeDocument/2006/relationships"><bookViews><workbookView activeTab="1"/></bookViews>'
        '<sheets><sheet name="Cover" sheetId="1" r:id="rId1"/><sheet name="Data" sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_XML}package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}><si><t>Residual report</t></si><si><r><t>Rich </t></r><r><t>text</t></r></si></sst>",
        "xl/styles.xml": f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row></sheetData></worksheet>',
        "xl/worksheets/sheet2.xml": f'<worksheet {main}><sheetData><row r="3"><c r="B3" t="inlineStr"><is><t>{name}</t></is></c><c r="C3"><v>{amount}</v></c>'
        f'<c r="D3" s="1"><v>{34335 + key % 1000}</v></c><c r="AA3" t="b"><v>1</v></c></row><row r="4"><c r="A4"><f>B1+1</f><v>{key}</v></c><c r="B4"><f>C9</f></c>'
        '<c r="C4" t="e"><v>#REF!</v></c><c r="D4" s="2"><v>34335.5</v></c><c r="E4" t="s"/></row><row r="5"/></sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for part, text in parts.items():
            book.writestr(part, text)
    return out.getvalue()


# Tasks a core for writing and decoding workbooks.
WORKBOOK_TASKS = 8


def workbook_files(v: Views) -> DataFrame:
    def write(batches):
        for b in batches:
            yield pd.DataFrame({"path": b["c_name"] + ".xlsx", "content": [_workbook(n, a, k) for n, a, k in zip(b["c_name"], b["amount"], b["c_custkey"])]})

    rows = v.read("customer").select("c_name", F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("amount"), "c_custkey")
    # customers may lie in one piece that a single task reads; workbooks cost far more than their rows
    return rows.repartition(WORKBOOK_TASKS * v.spark.sparkContext.defaultParallelism, "c_custkey").mapInPandas(write, "path string, content binary")


register("src_workbook_cells", lambda v: cells_of(workbook_cells.workbook_grid(workbook_files(v))), """
SELECT concat(c_name, '.xlsx') AS path, c.s AS sheet_idx, CASE c.s WHEN 0 THEN 'Cover' ELSE 'Data' END AS sheet, c.s = 1 AS is_active, CAST(c.r AS BIGINT) AS row_idx, c.c AS col_idx,
  CASE c.v WHEN 'NAME' THEN c_name WHEN 'AMOUNT' THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) WHEN 'KEY' THEN CAST(c_custkey AS VARCHAR)
    WHEN 'DAY' THEN strftime(DATE '1994-01-01' + CAST(c_custkey % 1000 AS INT), '%Y-%m-%d 00:00:00') ELSE c.v END AS value, c.k AS kind
FROM customer CROSS JOIN (VALUES (0, 0, 0, 'Residual report', 's'), (0, 0, 2, 'Rich text', 's'), (1, 2, 1, 'NAME', 's'), (1, 2, 2, 'AMOUNT', 'n'), (1, 2, 3, 'DAY', 'd'),
  (1, 2, 26, 'true', 'b'), (1, 3, 0, 'KEY', 'n'), (1, 3, 1, '=C9', 'f'), (1, 3, 2, '#REF!', 'e'), (1, 3, 3, '1994-01-01 12:00:00', 'd')) c(s, r, c, v, k)""")


def written_ledger(v: Views) -> DataFrame:
    """The ledger written in two appends to the cluster's shared folder, read back."""
    folder = f"{sinks.shared_folder(v.spark)}/ledger-{uuid.uuid4().hex}"
    old = F.col("date") < F.lit("1998-01-01").cast("date")
    sinks.append_ledger(v.revenue.filter(old), folder)
    sinks.append_ledger(v.revenue.filter(~old), folder)
    return sinks.read_ledger(v.spark, folder)


register("snk_ledger_append", written_ledger, f"SELECT {LEDGER} FROM revenue")


def months_deleted(v: Views) -> tuple[str, str, DataFrame]:
    """The stored ledger after partner-months, and one whole month, were deleted from it."""
    W.derive_once(v)
    folder = f"{sinks.shared_folder(v.spark)}/deleted-{uuid.uuid4().hex}"
    sinks.append_ledger(v.revenue, f"{folder}/revenue")
    whole = v.iso.select(F.lit("1996-01-01").cast("date").alias("date"), "iso")
    keys = month_keys(v).filter("date <> DATE '1996-01-01'").unionByName(whole)
    refused = sinks.delete_partner_months(v.spark, keys, f"{folder}/revenue", f"{folder}/audit", "auditor")
    return f"{folder}/revenue", f"{folder}/audit", refused


STORED_KEYS = """(SELECT DISTINCT a.date, i.iso FROM adjustments a JOIN iso i ON i.id = a.iso_id WHERE a.date <> DATE '1996-01-01'
  UNION SELECT DATE '1996-01-01', iso FROM iso) k"""
register("snk_ledger_delete", lambda v: sinks.read_ledger(v.spark, months_deleted(v)[0]),
         f"SELECT {LEDGER} FROM revenue r WHERE NOT EXISTS (SELECT 1 FROM {STORED_KEYS} WHERE k.date = r.date AND k.iso = r.iso)")
register("snk_ledger_delete_audit", lambda v: v.spark.read.parquet(months_deleted(v)[1]),
         f"SELECT date, iso, 'auditor' AS deleted_by FROM {STORED_KEYS} WHERE EXISTS (SELECT 1 FROM revenue r WHERE k.date = r.date AND k.iso = r.iso)")


register("snk_ledger_delete_refused", lambda v: months_deleted(v)[2],
         f"SELECT date, iso, 'not_found' AS reason FROM {STORED_KEYS} WHERE NOT EXISTS (SELECT 1 FROM revenue r WHERE k.date = r.date AND k.iso = r.iso)")


def stored_ledger(v: Views) -> str:
    """The ledger stored; the view's own is kept too, since the edits are taken from it."""
    W.derive_once(v)
    folder = f"{sinks.shared_folder(v.spark)}/edited-{uuid.uuid4().hex}"
    sinks.append_ledger(v.revenue, folder)
    return folder


def ledger_updated(v: Views) -> changes.Changed:
    folder = stored_ledger(v)
    return sinks.update_ledger(v.spark, ledger_changes(v), folder)


def lines_deleted(v: Views) -> changes.Changed:
    folder = stored_ledger(v)
    return sinks.delete_lines(v.spark, ledger_keys(v), folder)


register_stored("snk_ledger_update", lambda v: ledger_updated(v).table, "chg_ledger_update")
register_stored("snk_ledger_update_refused", lambda v: ledger_updated(v).refused, "chg_ledger_update_refused")
register_stored("snk_lines_delete", lambda v: lines_deleted(v).table, "chg_ledger_delete")


def logged_changes(v: Views) -> DataFrame:
    """The report over a stored ledger with a change log."""
    folder = f"{sinks.shared_folder(v.spark)}/logged-{uuid.uuid4().hex}"
    sinks.append_ledger(v.revenue, f"{folder}/revenue", f"{folder}/log")
    tables = type(v.tables)(**{**v.tables.__dict__, "revenue": sinks.read_ledger(v.spark, f"{folder}/revenue")})
    return reports.recent_changes(tables, AS_OF, 60, sinks.read_change_log(v.spark, f"{folder}/log"))


QUERIES["rpt_recent_changes_logged"] = lambda spark, sf_dir: logged_changes(Views(spark, sf_dir))
ORACLE["rpt_recent_changes_logged"] = REPORTS["rpt_recent_changes"]


def stored_keyed(v: Views, name: str, keys: list[str]) -> tuple:
    """A table stored by key: its folder and schema."""
    table, folder = getattr(v, name), f"{sinks.shared_folder(v.spark)}/{name}-{uuid.uuid4().hex}"
    keyed_tables.write_keyed(table, folder, keys, 16)
    return v.spark, folder, table.schema


def edited(v: Views, name: str, keys: list[str], edits: DataFrame, operation) -> changes.Changed:
    return keyed_tables.change_keyed(*stored_keyed(v, name, keys), keys, edits, lambda table: operation(table, edits), 16)


def numbered(v: Views, name: str, edits: DataFrame, operation) -> changes.Changed:
    return keyed_tables.change_numbered(*stored_keyed(v, name, ["id"]), lambda table: operation(table, edits), 16)


register_stored("snk_merchants_upsert", lambda v: edited(v, "merchants", ["mid"], merchant_changes(v), changes.merchants_upsert).table, "chg_merchants_upsert")
register_stored("snk_merchants_delete", lambda v: edited(v, "merchants", ["mid"], merchant_deletes(v), changes.merchants_delete).table, "chg_merchants_delete")
register_stored("snk_merchants_delete_refused", lambda v: edited(v, "merchants", ["mid"], merchant_deletes(v), changes.merchants_delete).refused, "chg_merchants_delete_refused")
register_stored("snk_payments_upsert", lambda v: edited(v, "payments", ["iso_id", "date"], payment_changes(v), changes.payments_upsert).table, "chg_payments_upsert")
register_stored("snk_iso_upsert", lambda v: numbered(v, "iso", iso_changes(v), changes.iso_upsert).table, "chg_iso_upsert")
register_stored("snk_iso_upsert_refused", lambda v: numbered(v, "iso", iso_changes(v), changes.iso_upsert).refused, "chg_iso_upsert_refused")
register_stored("snk_adjustments_upsert", lambda v: numbered(v, "adjustments", adjustment_changes(v), changes.adjustments_upsert).table, "chg_adjustments_upsert")


def bulk_rows(v: Views) -> DataFrame:
    """Text rows of a merchant file: known and new ids, each new one twice, with empty fields."""
    k = F.col("c_custkey")
    half = F.col("half")
    def text(c):
        return c.cast("string")
    rows = v.read("customer").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    return rows.select(
        F.when(k % 2 == 0, F.concat(F.lit("8000"), text(k))).otherwise(F.concat(F.lit("6354"), F.lpad(text(k), 12, "0"))).alias("mid"),
        F.concat("c_name", F.lit(" "), text(half)).alias("dba"), F.when(k % 3 != 0, F.concat(F.lit("Corp "), text(k % 9))).alias("corporation"),
        F.concat(F.lit("NATION_"), text(F.col("c_nationkey"))).alias("iso"), F.lit(None).cast("string").alias("iso_referral_type"),
        F.when(k % 5 != 0, text(50000 + k % 1000)).alias("sic_code"), F.lit("d").alias("sic_description"), F.lit(None).cast("string").alias("agent1_name"),
        F.lit("Agent 1").alias("agent2_name"), F.lit("1").alias("total_split"), F.lit("1").alias("is_active"), text(k % 2).alias("is_referred"),
        F.when(k % 7 == 0, "31/31/2000").otherwise(F.concat(F.lpad(text(1 + k % 28), 2, "0"), F.lit("/0"), text(1 + k % 9), F.lit("/1999"))).alias("approval_date"),
        F.get(F.array(*[F.lit(d) for d in CLOSED]), k.cast("int") % len(CLOSED)).alias("closed_date"),
        F.when(k % 6 != 0, "12.5").alias("agent1_split"), F.lit("x").alias("agent2_split"), F.lit("beyond").alias("more"), "half",
    )


#: Notations of one day, one that is none, and nothing.
CLOSED = ("2001-02-03", "2/3/2001", "3-Feb-2001", "Feb 3, 2001", "2001/2/3", "3 February 2001", "20010203", "2001-02-03 00:00:00", "02/03/2001 12:00:00 AM", "never", None)


def bulk_files(v: Views) -> DataFrame:
    """The rows written as CSV files, first those that count, and read back."""
    folder = f"{sinks.shared_folder(v.spark)}/merchants-{uuid.uuid4().hex}"
    rows = bulk_rows(v)
    for half in (0, 1):
        rows.filter(F.col("half") == half).drop("half").repartition(4, "mid").write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/{half}")
    return merchant_bulk.read_merchant_csv(v.spark, folder)


register("src_merchant_bulk", lambda v: merchant_bulk.add_merchants(v.merchants, bulk_files(v)), f"""
SELECT {MERCHANT_COLUMNS} FROM merchants UNION ALL
SELECT concat('8000', CAST(k AS VARCHAR)), concat(c_name, ' 0'), CASE WHEN k % 3 <> 0 THEN concat('Corp ', CAST(k % 9 AS VARCHAR)) ELSE 'None' END,
  concat('NATION_', CAST(c_nationkey AS VARCHAR)), 'None', CASE WHEN k % 5 <> 0 THEN substr(CAST(50000 + k % 1000 AS VARCHAR), 1, 4) ELSE 'None' END, 'd',
  CASE WHEN k % 7 <> 0 THEN make_date(1999, CAST(1 + k % 9 AS INT), CAST(1 + k % 28 AS INT)) END, CASE WHEN k % {len(CLOSED)} < 9 THEN DATE '2001-02-03' END, 1, CAST(k % 2 AS INT),
  'None', CAST(CASE WHEN k % 6 <> 0 THEN 12.5 ELSE 0 END AS DECIMAL(5,2)), 'Agent 1', CAST(0 AS DECIMAL(5,2))
FROM (SELECT *, c_custkey AS k FROM customer) c WHERE k % 2 = 0""")
