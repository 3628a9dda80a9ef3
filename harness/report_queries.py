"""Registered report and dimension queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.oracle_views import with_views
from harness.views import Views
from ledgermill.plans import dimensions, reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MONTH, START, END = "1996-01-01", "1995-01-01", "1996-12-15"
MID, AGENT, ISO, CORP = "6354000000000003", "Agent 3", "NATION_1", "Corp 12"
AS_OF = "2001-08-01 00:00:00"


def register(name: str, make: Callable[[Views], DataFrame], sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: make(Views(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = with_views(sql)


def _report(name: str, plan: Callable, sql: str, keyed: bool = True) -> None:
    """Register ``plan`` for one month and, as ``<name>_all``, for every month at once.

    ``sql`` holds ``{key}`` where the period column goes, ``{group}`` for the grouping on it and
    ``{where}`` for the month filter of the one-month form.
    """
    register(
        name, lambda v: plan(v.tables, MONTH),
        sql.format(key="", group="", by="", where=f"date = DATE '{MONTH}'"),
    )
    if keyed:
        register(
            f"{name}_all", lambda v: plan(v.tables),
            sql.format(key="date, ", group="GROUP BY date", by="date, ", where="TRUE"),
        )


_report("rpt_volume_month", reports.volume_month,
        "SELECT {key}CAST(COALESCE(SUM(volume), 0) AS DOUBLE) AS total_volume FROM revenue WHERE {where} {group}")
_report("rpt_revenue_month", reports.revenue_month, """
SELECT {key}CAST(COALESCE(SUM(x), 0) AS DOUBLE) AS total_revenue FROM (
  SELECT date, SUM(house_residual) AS x FROM revenue GROUP BY date
  UNION ALL SELECT date, SUM(adjustment_price) AS x FROM adjustments GROUP BY date) u WHERE {where} {group}""")
_report("rpt_active_mids", reports.active_mids, """
SELECT {key}COUNT(*) AS total_mids FROM revenue r JOIN iso i ON r.iso = i.iso
WHERE {where} AND house_residual <> 0 AND i.referral_type = 'MID' {group}""")

register("rpt_referral_type", lambda v: reports.referral_type_residual(v.tables, MONTH), f"""
SELECT t.referral_type, CAST(COALESCE(s.x, 0) AS DOUBLE) AS total_residual
FROM (VALUES ('3rd Party'), ('MID'), ('Gateway')) t(referral_type)
LEFT JOIN (SELECT i.referral_type, SUM(r.house_residual) AS x FROM revenue r JOIN iso i ON r.iso = i.iso
  GROUP BY i.referral_type, r.date HAVING r.date = DATE '{MONTH}') s ON s.referral_type = t.referral_type""")
register("rpt_referral_type_all", lambda v: reports.referral_type_residual(v.tables), """
SELECT d.date, t.referral_type, CAST(COALESCE(s.x, 0) AS DOUBLE) AS total_residual
FROM (SELECT DISTINCT r.date FROM revenue r JOIN iso i ON r.iso = i.iso) d
CROSS JOIN (VALUES ('3rd Party'), ('MID'), ('Gateway')) t(referral_type)
LEFT JOIN (SELECT i.referral_type, r.date, SUM(r.house_residual) AS x FROM revenue r JOIN iso i ON r.iso = i.iso
  GROUP BY i.referral_type, r.date) s ON s.referral_type = t.referral_type AND s.date = d.date""")

AGENTS = """r.agent1_name, CAST(r.agent1_percentage AS DOUBLE) AS agent1_percentage, CAST(r.agent1_payout AS DOUBLE) AS agent1_payout,
  r.agent2_name, CAST(r.agent2_percentage AS DOUBLE) AS agent2_percentage, CAST(r.agent2_payout AS DOUBLE) AS agent2_payout"""
RESIDUALS = """CAST(r.total_residual AS DOUBLE) AS total_residual, CAST(r.house_residual AS DOUBLE) AS house_residual"""
_report("rpt_revenue_per_mid", reports.revenue_per_mid, f"""
SELECT {{key}}m.dba, r.mid, r.iso, {RESIDUALS}, m.corporation, {AGENTS}
FROM revenue r JOIN merchants m ON r.mid = m.mid JOIN iso i ON r.iso = i.iso
WHERE {{where}} AND r.house_residual <> 0 AND i.referral_type = 'MID'""")
_report("rpt_revenue_per_corporation", reports.revenue_per_corporation, """
SELECT {key}m.corporation, CAST(SUM(r.house_residual) AS DOUBLE) AS house_residual
FROM revenue r JOIN merchants m ON r.mid = m.mid WHERE {where} GROUP BY {by}m.corporation""")
_report("rpt_negative_revenue", reports.negative_revenue, f"""
SELECT {{key}}m.dba, r.mid, r.iso, {RESIDUALS}, m.corporation
FROM revenue r JOIN merchants m ON r.mid = m.mid WHERE {{where}} AND r.house_residual < 0""")
INDUSTRY = """
SELECT {key}s.sic_code, s.description, CAST(SUM(r.total_residual) AS DOUBLE) AS total_residual,
  CAST(SUM(r.house_residual) AS DOUBLE) AS house_residual
FROM revenue r JOIN merchants m ON m.mid = r.mid JOIN sic_codes s ON m.sic_code = s.sic_code
WHERE {where} GROUP BY {by}s.sic_code, s.description"""
_report("rpt_revenue_per_industry", reports.revenue_per_industry, INDUSTRY)
ONE_MONTH_INDUSTRY = INDUSTRY.format(key="", by="", where=f"date = DATE '{MONTH}'")
register("rpt_industry_page", lambda v: reports.industry_page(v.tables, MONTH, page=2, page_size=20),
         f"{ONE_MONTH_INDUSTRY} ORDER BY house_residual DESC, sic_code LIMIT 20 OFFSET 20")
register("rpt_industry_page_info", lambda v: reports.industry_page_info(v.tables, MONTH, page=2, page_size=20),
         f"""SELECT 2 AS page, 20 AS page_size, CASE WHEN n > 20 THEN n ELSE 0 END AS total_count,
CAST(CEIL((CASE WHEN n > 20 THEN n ELSE 0 END) / 20.0) AS BIGINT) AS total_pages FROM (SELECT COUNT(*) AS n FROM ({ONE_MONTH_INDUSTRY}) g) c""")
_report("rpt_revenue_per_agent", reports.revenue_per_agent, f"""
SELECT {{key}}r.mid, r.iso, r.agent1_name, r.agent2_name, {RESIDUALS}, CAST(r.agent1_payout AS DOUBLE) AS agent1_payout,
  CAST(r.agent2_payout AS DOUBLE) AS agent2_payout
FROM revenue r WHERE r.agent1_name IS NOT NULL AND {{where}}""")
_report("rpt_agents_payout", reports.agents_payout, """
SELECT {key}agent_name, CAST(SUM(payout) AS DOUBLE) AS total_payout FROM (
  SELECT date, agent1_name AS agent_name, agent1_payout AS payout FROM revenue WHERE agent1_name IS NOT NULL
  UNION ALL SELECT date, agent2_name, agent2_payout FROM revenue WHERE agent2_name IS NOT NULL) a
WHERE {where} GROUP BY {by}agent_name""")
register("rpt_unique_agents", lambda v: reports.unique_agents(v.tables), """
SELECT agent1_name AS agent_name FROM revenue WHERE agent1_name IS NOT NULL
UNION SELECT agent2_name FROM revenue WHERE agent2_name IS NOT NULL""")

MONTHS = f"""WITH RECURSIVE months(month) AS (SELECT DATE '{START}' UNION ALL
  SELECT CAST(month + INTERVAL 1 MONTH AS DATE) FROM months WHERE month < DATE '{END}')"""
SERIES = """CAST(COALESCE(SUM(r.total_residual), 0) AS DOUBLE) AS total_residual,
  CAST(COALESCE(SUM(r.house_residual), 0) AS DOUBLE) AS house_residual"""
register("rpt_mid_insights", lambda v: reports.mid_insights(v.tables, START, END, MID), f"""{MONTHS}
SELECT m.month, {SERIES} FROM months m LEFT JOIN revenue r ON m.month = r.date AND r.mid = '{MID}' GROUP BY m.month""")
register("rpt_mid_insights_all", lambda v: reports.mid_insights(v.tables, START, END), f"""{MONTHS}
SELECT k.mid, m.month, {SERIES} FROM months m CROSS JOIN (SELECT DISTINCT mid FROM revenue) k
LEFT JOIN revenue r ON m.month = r.date AND r.mid = k.mid GROUP BY k.mid, m.month""")

RANGE = f"date BETWEEN DATE '{START}' AND DATE '{END}'"
SUMS = """CAST(SUM(total_residual) AS DOUBLE) AS total_residual, CAST(SUM(house_residual) AS DOUBLE) AS house_residual"""
register("rpt_agent_insights", lambda v: reports.agent_insights(v.tables, START, END, AGENT), f"""
SELECT date AS month, {SUMS} FROM revenue WHERE (agent1_name = '{AGENT}' OR agent2_name = '{AGENT}') AND {RANGE} GROUP BY date""")
BOTH_ROLES = """(SELECT agent1_name AS agent_name FROM revenue WHERE agent1_name IS NOT NULL
  UNION SELECT agent2_name FROM revenue WHERE agent2_name IS NOT NULL)"""
register("rpt_agent_insights_all", lambda v: reports.agent_insights(v.tables, START, END), f"""
SELECT a.agent_name, date AS month, {SUMS} FROM revenue r JOIN {BOTH_ROLES} a
ON r.agent1_name = a.agent_name OR r.agent2_name = a.agent_name WHERE {RANGE} GROUP BY a.agent_name, date""")
register("rpt_iso_insights", lambda v: reports.iso_insights(v.tables, START, END, ISO),
         f"SELECT date AS month, {SUMS} FROM revenue WHERE iso = '{ISO}' AND {RANGE} GROUP BY date")
register("rpt_iso_insights_all", lambda v: reports.iso_insights(v.tables, START, END),
         f"SELECT iso, date AS month, {SUMS} FROM revenue WHERE {RANGE} GROUP BY iso, date")

ISO_MONTH = """
SELECT {key}i.id, i.iso, {cols} FROM (SELECT date, iso, SUM(total_residual) AS total, SUM(house_residual) AS house FROM revenue GROUP BY date, iso) r
JOIN iso i ON r.iso = i.iso
LEFT JOIN (SELECT iso_id, date AS adate, SUM(adjustment_price) AS adjusted, MAX(adjustment_price) AS largest FROM adjustments GROUP BY iso_id, date) a
  ON a.iso_id = i.id AND a.adate = r.date
LEFT JOIN (SELECT iso_id, date AS pdate, SUM(DISTINCT bank_amount) AS paid FROM payments GROUP BY iso_id, date) p
  ON p.iso_id = i.id AND p.pdate = r.date
WHERE {where}"""
TOTALS = """CAST(total AS DOUBLE) AS total_residual, CAST(house + COALESCE(adjusted, 0) AS DOUBLE) AS house_residual,
  CAST(COALESCE(largest, 0) AS DOUBLE) AS adjustment_price"""
PAID = """CAST(house + COALESCE(adjusted, 0) AS DOUBLE) AS house_residual, CAST(COALESCE(paid, 0) AS DOUBLE) AS bank_amount"""
_report("rpt_iso_month", reports.iso_month, ISO_MONTH.replace("{cols}", TOTALS))
_report("rpt_payments_recon", reports.payments_recon, ISO_MONTH.replace("{cols}", PAID))

ISO_LINES = f"""
SELECT {{key}}r.mid, m.corporation, m.dba, {RESIDUALS}, {AGENTS} FROM revenue r JOIN merchants m ON r.mid = m.mid WHERE {{where}}"""
register("rpt_iso_lines", lambda v: reports.iso_lines(v.tables, ISO, MONTH),
         ISO_LINES.format(key="", where=f"r.iso = '{ISO}' AND date = DATE '{MONTH}'"))
register("rpt_iso_lines_all", lambda v: reports.iso_lines(v.tables), ISO_LINES.format(key="date, r.iso, ", where="TRUE"))
CORP_LINES = f"""
SELECT {{key}}r.mid, r.iso, m.dba, {RESIDUALS} FROM revenue r JOIN merchants m ON r.mid = m.mid WHERE {{where}}"""
register("rpt_corp_lines", lambda v: reports.corp_lines(v.tables, CORP, MONTH),
         CORP_LINES.format(key="", where=f"corporation = '{CORP}' AND date = DATE '{MONTH}'"))
register("rpt_corp_lines_all", lambda v: reports.corp_lines(v.tables),
         CORP_LINES.format(key="date, corporation, ", where="corporation IS NOT NULL"))
AGENT_LINES = f"""
SELECT {{key}}r.mid, r.iso, r.dba, m.corporation, {RESIDUALS},
  CAST(CASE WHEN r.agent1_name = {{a}} THEN r.agent1_percentage WHEN r.agent2_name = {{a}} THEN r.agent2_percentage END AS DOUBLE) AS agent_percentage,
  CAST(CASE WHEN r.agent1_name = {{a}} THEN r.agent1_payout WHEN r.agent2_name = {{a}} THEN r.agent2_payout END AS DOUBLE) AS agent_payout
FROM revenue r JOIN merchants m ON r.mid = m.mid"""
register("rpt_agent_lines", lambda v: reports.agent_lines(v.tables, AGENT, MONTH),
         AGENT_LINES.format(key="", a=f"'{AGENT}'")
         + f" WHERE (r.agent1_name = '{AGENT}' OR r.agent2_name = '{AGENT}') AND date = DATE '{MONTH}'")
register("rpt_agent_lines_all", lambda v: reports.agent_lines(v.tables),
         AGENT_LINES.format(key="date, a.agent_name, ", a="a.agent_name")
         + f" JOIN {BOTH_ROLES} a ON r.agent1_name = a.agent_name OR r.agent2_name = a.agent_name")

TREND = "SELECT {key}date, CAST(SUM(house_residual) AS DOUBLE) AS total_revenue FROM revenue WHERE {where} GROUP BY {key}date"
register("rpt_iso_trend", lambda v: reports.iso_trend(v.tables, START, END, ISO),
         TREND.format(key="", where=f"iso = '{ISO}' AND {RANGE}"))
register("rpt_iso_trend_all", lambda v: reports.iso_trend(v.tables, START, END), TREND.format(key="", where=RANGE))
AGENT_TREND = """
SELECT {key}date, CAST(SUM(CASE WHEN agent1_name = {a} THEN agent1_payout WHEN agent2_name = {a} THEN agent2_payout ELSE 0 END) AS DOUBLE) AS total_revenue
FROM revenue {join} WHERE (agent1_name = {a} OR agent2_name = {a}) AND {where} GROUP BY {key}date"""
register("rpt_agent_trend", lambda v: reports.agent_trend(v.tables, START, END, AGENT),
         AGENT_TREND.format(key="", a=f"'{AGENT}'", join="", where=RANGE))
register("rpt_agent_trend_all", lambda v: reports.agent_trend(v.tables, START, END),
         AGENT_TREND.format(key="agent_name, ", a="a.agent_name", join=f"JOIN {BOTH_ROLES} a ON agent1_name = a.agent_name OR agent2_name = a.agent_name", where=RANGE))
register("rpt_mid_trend", lambda v: reports.mid_trend(v.tables, START, END, MID),
         TREND.format(key="", where=f"mid = '{MID}' AND {RANGE}"))
register("rpt_mid_trend_all", lambda v: reports.mid_trend(v.tables, START, END), TREND.format(key="mid, ", where=RANGE))
register("rpt_recent_changes", lambda v: reports.recent_changes(v.tables, AS_OF, 60), f"""
SELECT date, iso, mid, dba, CAST(volume AS DOUBLE) AS volume, {RESIDUALS}, {AGENTS}, updated_at
FROM revenue r WHERE updated_at >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY""")
_report("load_uploaded_isos", reports.uploaded_isos, "SELECT DISTINCT {key}iso FROM revenue WHERE {where}")

# --- dimensions -----------------------------------------------------------------------------
LISTING = """agent1_name, agent1_split, agent2_name, agent2_split, approval_date, closed_date, corporation, dba,
  is_active, is_referred, iso, iso_referral_type, mid"""
register("dim_merchants", lambda v: dimensions.merchants(v.tables), f"SELECT {LISTING} FROM merchants")
register("dim_unique_corporations", lambda v: dimensions.unique_corporations(v.tables),
         "SELECT DISTINCT corporation FROM merchants WHERE corporation IS NOT NULL AND corporation <> ''")
register("dim_unique_mid_dba", lambda v: dimensions.unique_mid_dba(v.tables), "SELECT DISTINCT mid, dba, iso FROM merchants")
register("dim_unique_iso", lambda v: dimensions.unique_iso(v.tables), "SELECT DISTINCT id, iso, is_active FROM iso")
register("dim_iso", lambda v: dimensions.isos(v.tables), "SELECT id, iso, referral_type, is_active FROM iso")
MIDS_PER_ISO = """SELECT mid, iso, dba, corporation, is_active, is_referred, iso_referral_type, approval_date, closed_date FROM merchants"""
register("dim_mids_per_iso", lambda v: dimensions.mids_per_iso(v.tables, ISO), f"{MIDS_PER_ISO} WHERE iso = '{ISO}'")
register("dim_mids_per_iso_all", lambda v: dimensions.mids_per_iso(v.tables), MIDS_PER_ISO)
register("dim_agent_mids", lambda v: dimensions.agent_mids(v.tables, AGENT),
         f"SELECT mid, dba, iso FROM merchants WHERE agent1_name = '{AGENT}' OR agent2_name = '{AGENT}'")
register("dim_agent_mids_all", lambda v: dimensions.agent_mids(v.tables), """
SELECT agent1_name AS agent_name, mid, dba, iso FROM merchants WHERE agent1_name IS NOT NULL
UNION SELECT agent2_name, mid, dba, iso FROM merchants WHERE agent2_name IS NOT NULL""")
register("dim_sic_codes", lambda v: dimensions.sic_codes(v.tables), "SELECT sic_code, description FROM sic_codes")
register("dim_adjustments", lambda v: dimensions.adjustments(v.tables), """
SELECT a.id, i.iso, CAST(a.adjustment_price AS DOUBLE) AS adjustment_price, a.date FROM adjustments a JOIN iso i ON i.id = a.iso_id""")


def _shifted_mids(v: Views) -> DataFrame:
    """Merchant ids asked for by orders, some of which no merchant has."""
    asked = F.concat(F.lit("6354"), F.lpad((F.col("o_custkey") * 2).cast("string"), 12, "0"))
    return v.read("orders").select(asked.alias("mid"))


register("dim_lookup", lambda v: dimensions.merchant_lookup(v.tables, _shifted_mids(v)), f"""
SELECT {LISTING.replace(', mid', ', k.mid')}, sic_code, sic_description, m.mid IS NOT NULL AS found
FROM (SELECT DISTINCT concat('6354', lpad(CAST(o_custkey * 2 AS VARCHAR), 12, '0')) AS mid FROM orders) k
LEFT JOIN merchants m ON m.mid = k.mid""")
register("dim_lookup_iso", lambda v: dimensions.iso_lookup(v.tables, v.read("part").select(F.col("p_size").alias("id"))), """
SELECT k.id, iso, referral_type, is_active, i.id IS NOT NULL AS found FROM (SELECT DISTINCT p_size AS id FROM part) k
LEFT JOIN iso i ON i.id = k.id""")
register("dim_lookup_adjustment",
         lambda v: dimensions.adjustment_lookup(v.tables, v.read("customer").select(F.col("c_custkey").alias("id"))), """
SELECT k.id, iso_id, adjustment_price, date, a.id IS NOT NULL AS found FROM (SELECT DISTINCT c_custkey AS id FROM customer) k
LEFT JOIN adjustments a ON a.id = k.id""")
