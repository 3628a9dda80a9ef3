"""Reports over the ledger.

Every report takes the tables and either one period or none; without a period it answers for
all periods in the same job, keyed by ``date``. Money is summed as DECIMAL and turned into
DOUBLE at the very end. Joins to dimensions come after a pre-aggregation on the join key
wherever the report is a sum, so a partner or merchant that owns a third of the ledger is
reduced map-side before anything is shuffled. No join is hinted: Spark broadcasts a side only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles, with AQE splitting skewed partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.plans.periods import (
    DateLike, as_date, between, money, month_spine, one_or_all, require,
)
from ledgermill.schemas import AGENT_COLUMNS, LEDGER_COLUMNS, REFERRAL_TYPES
from ledgermill.sources.tables import LedgerTables

LINE_MONEY = ("volume", "total_residual", "house_residual")


def _doubles(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def _agent_columns() -> list[Column]:
    return [
        F.col(n) if n.endswith("name") else F.col(n).cast("double").alias(n)
        for n in AGENT_COLUMNS
    ]


def _merchant_lines(t: LedgerTables, lines: DataFrame, *merchant_columns: str) -> DataFrame:
    """Ledger lines joined to the wanted merchant columns; a ``dba`` taken from the merchant
    replaces the one on the line."""
    wanted = t.merchants.select("mid", *merchant_columns)
    kept = [c for c in lines.columns if c not in merchant_columns]
    return lines.select(*kept).join(wanted, "mid")


# --- totals ---------------------------------------------------------------------------------

def volume_month(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    rows, keys = one_or_all(t.revenue, date)
    return rows.groupBy(*keys).agg(money(F.sum("volume")).alias("total_volume"))


def revenue_month(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    """House residual plus adjustments."""
    lines = t.revenue.select("date", F.col("house_residual").alias("amount"))
    corrections = t.adjustments.select("date", F.col("adjustment_price").alias("amount"))
    rows, keys = one_or_all(lines.unionByName(corrections), date)
    return rows.groupBy(*keys).agg(money(F.sum("amount")).alias("total_revenue"))


def active_mids(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    """Number of non-zero ledger lines (not distinct merchants) of partners of type MID."""
    rows, keys = one_or_all(t.revenue.filter("house_residual <> 0"), date)
    per_iso = rows.groupBy(*keys, "iso").agg(F.count("*").alias("n"))
    mid_isos = t.iso.filter("referral_type = 'MID'").select("iso")
    return (
        per_iso.join(mid_isos, "iso").groupBy(*keys)
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_mids"))
    )


def referral_type_residual(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    """One row per known referral type, zero where nothing was earned; unknown types vanish."""
    rows, keys = one_or_all(t.revenue, date)
    per_iso = rows.groupBy(*keys, "iso").agg(F.sum("house_residual").alias("house"))
    typed = per_iso.join(t.iso.select("iso", "referral_type"), "iso")
    sums = [F.sum(F.when(F.col("referral_type") == r, F.col("house"))) for r in REFERRAL_TYPES]
    entries = F.array(
        *[
            F.struct(F.lit(r).alias("referral_type"), money(s).alias("total_residual"))
            for r, s in zip(REFERRAL_TYPES, sums)
        ]
    )
    return typed.groupBy(*keys).agg(entries.alias("e")).select(*keys, F.inline("e"))


# --- listings -------------------------------------------------------------------------------

def revenue_per_mid(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    rows, keys = one_or_all(t.revenue.filter("house_residual <> 0"), date)
    mid_isos = t.iso.filter("referral_type = 'MID'").select("iso")
    listed = _merchant_lines(t, rows.join(mid_isos, "iso"), "dba", "corporation").select(
        *keys, "dba", "mid", "iso", *_doubles("total_residual", "house_residual"),
        "corporation", *_agent_columns(),
    )
    return listed if date is None else listed.orderBy(F.desc("house_residual"), "mid")


def revenue_per_corporation(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    rows, keys = one_or_all(t.revenue, date)
    per_mid = rows.groupBy(*keys, "mid").agg(F.sum("house_residual").alias("house"))
    sums = (
        per_mid.join(t.merchants.select("mid", "corporation"), "mid")
        .groupBy(*keys, "corporation").agg(money(F.sum("house")).alias("house_residual"))
    )
    return sums if date is None else sums.orderBy(F.desc("house_residual"), "corporation")


def negative_revenue(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    rows, keys = one_or_all(t.revenue.filter("house_residual < 0"), date)
    listed = _merchant_lines(t, rows, "dba", "corporation").select(
        *keys, "dba", "mid", "iso", *_doubles("total_residual", "house_residual"), "corporation",
    )
    return listed if date is None else listed.orderBy(F.desc("house_residual"), "mid")


def _industry_sums(t: LedgerTables, date: DateLike | None) -> tuple[DataFrame, list[str]]:
    rows, keys = one_or_all(t.revenue, date)
    sums = [F.sum(c).alias(c) for c in ("total_residual", "house_residual")]
    per_mid = rows.groupBy(*keys, "mid").agg(*sums)
    per_code = (
        per_mid.join(t.merchants.select("mid", "sic_code"), "mid")
        .groupBy(*keys, "sic_code").agg(*sums)
    )
    return (
        per_code.join(t.sic_codes, "sic_code")
        .groupBy(*keys, "sic_code", "description")
        .agg(*[money(F.sum(c)).alias(c) for c in ("total_residual", "house_residual")]),
        keys,
    )


def revenue_per_industry(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    sums, _ = _industry_sums(t, date)
    return sums if date is None else sums.orderBy(F.desc("house_residual"), "sic_code")


def industry_page(
    t: LedgerTables, date: DateLike, page: int = 1, page_size: int = 100
) -> DataFrame:
    """Page ``page`` of the industry report, best earning industries first."""
    require(date=date)
    sums, _ = _industry_sums(t, date)
    return (
        sums.orderBy(F.desc("house_residual"), "sic_code")
        .offset((page - 1) * page_size).limit(page_size)
    )


def industry_page_info(
    t: LedgerTables, date: DateLike, page: int = 1, page_size: int = 100
) -> DataFrame:
    """Counts that go with :func:`industry_page`; a page past the end reports 0 and 0."""
    require(date=date)
    sums, _ = _industry_sums(t, date)
    total = F.when(F.col("n") > (page - 1) * page_size, F.col("n")).otherwise(F.lit(0))
    return sums.agg(F.count("*").alias("n")).select(
        F.lit(page).alias("page"), F.lit(page_size).alias("page_size"),
        total.cast("bigint").alias("total_count"),
        F.ceil(total / F.lit(page_size)).cast("bigint").alias("total_pages"),
    )


def revenue_per_agent(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    rows, keys = one_or_all(t.revenue.filter("agent1_name IS NOT NULL"), date)
    return rows.select(
        *keys, "mid", "iso", "agent1_name", "agent2_name",
        *_doubles("total_residual", "house_residual", "agent1_payout", "agent2_payout"),
    )


def _agent_roles(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per (line, agent role) from a single pass over the ledger."""
    return rows.select(
        *keep,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.col(f"agent{i}_name").alias("agent_name"),
                        F.col(f"agent{i}_payout").alias("payout"),
                    )
                    for i in (1, 2)
                ]
            )
        ),
    ).filter("agent_name IS NOT NULL")


def agents_payout(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    rows, keys = one_or_all(t.revenue, date)
    sums = (
        _agent_roles(rows, *keys).groupBy(*keys, "agent_name")
        .agg(F.sum("payout").cast("double").alias("total_payout"))
    )
    return sums if date is None else sums.orderBy(F.desc("total_payout"), "agent_name")


def unique_agents(t: LedgerTables) -> DataFrame:
    return _agent_roles(t.revenue).select("agent_name").distinct()


# --- series ---------------------------------------------------------------------------------

def mid_insights(
    t: LedgerTables, start: DateLike, end: DateLike, mid: str | None = None
) -> DataFrame:
    """Monthly totals with empty months filled by zero, for one merchant or for every merchant
    that has a ledger line.

    For one merchant the spine rows are unioned with the ledger rows as zeros and both are summed
    in one aggregation. For every merchant a spine in front of an aggregation would give each task
    all its merchants times all months to hold; there the lines are summed by merchant and month,
    a merchant's sums are put into one row, and the months are laid out behind the last shuffle.
    Neither needs a join, and a hot merchant is combined map-side.
    """
    require(start=start, end=end)
    spine = month_spine(start, end)
    months = F.array(*[F.lit(m) for m in spine])
    on_spine = F.col("date").isin(spine)
    amounts = ("total_residual", "house_residual")
    if mid is None:
        # a merchant without a line on the spine keeps one row, whose month is NULL
        sums = (
            t.revenue.groupBy("mid", F.when(on_spine, F.col("date")).alias("month"))
            .agg(*[F.sum(a).alias(a) for a in amounts])
            .groupBy("mid").agg(F.collect_list(F.struct("month", *amounts)).alias("sums"))
        )
        laid = sums.select("mid", "sums", F.explode(months).alias("month"))
        own = F.get(F.filter("sums", lambda s: s["month"] == F.col("month")), F.lit(0))
        return laid.select("mid", "month", *[money(own[a]).alias(a) for a in amounts])
    zeros = t.revenue.sparkSession.range(1).select(F.explode(months).alias("month"), *[F.lit(0).cast("decimal(18,2)").alias(a) for a in amounts])
    earned = t.revenue.filter(on_spine & (F.col("mid") == mid)).select(F.col("date").alias("month"), *amounts)
    return zeros.unionByName(earned).groupBy("month").agg(*[money(F.sum(a)).alias(a) for a in amounts]).orderBy("month")


def _monthly(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, F.col("date").alias("month")).agg(
        *[F.sum(a).cast("double").alias(a) for a in ("total_residual", "house_residual")]
    )


def agent_insights(
    t: LedgerTables, start: DateLike, end: DateLike, agent: str | None = None
) -> DataFrame:
    """Whole residual of the lines an agent takes part in, in either role, counted once."""
    rows = between(t.revenue, start, end)
    if agent is not None:
        return _monthly(rows.filter((F.col("agent1_name") == agent) | (F.col("agent2_name") == agent)))
    agents = F.array_distinct(F.array_compact(F.array("agent1_name", "agent2_name")))
    return _monthly(
        rows.select("date", "total_residual", "house_residual",
                    F.explode(agents).alias("agent_name")),
        "agent_name",
    )


def iso_insights(
    t: LedgerTables, start: DateLike, end: DateLike, iso: str | None = None
) -> DataFrame:
    rows = between(t.revenue, start, end)
    return _monthly(rows, "iso") if iso is None else _monthly(rows.filter(F.col("iso") == iso))


def _trend(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, "date").agg(
        F.sum("house_residual").cast("double").alias("total_revenue")
    )


def iso_trend(t: LedgerTables, start: DateLike, end: DateLike, iso: str = "") -> DataFrame:
    """House residual per month; an empty partner name means all partners together."""
    rows = between(t.revenue, start, end)
    return _trend(rows if iso == "" else rows.filter(F.col("iso") == iso))


def agent_trend(
    t: LedgerTables, start: DateLike, end: DateLike, agent: str | None = None
) -> DataFrame:
    """Payout per month; a name in both roles of a line is paid by its first role only."""
    rows = between(t.revenue, start, end)
    if agent is not None:
        payout = (
            F.when(F.col("agent1_name") == agent, F.col("agent1_payout"))
            .when(F.col("agent2_name") == agent, F.col("agent2_payout"))
            .otherwise(F.lit(0))
        )
        rows = rows.filter((F.col("agent1_name") == agent) | (F.col("agent2_name") == agent))
        return rows.groupBy("date").agg(F.sum(payout).cast("double").alias("total_revenue"))
    # all agents: the second role of a line is kept only when it names someone else
    other = F.when(~F.col("agent2_name").eqNullSafe(F.col("agent1_name")), F.col("agent2_name"))
    return (
        _agent_roles(rows.withColumn("agent2_name", other), "date")
        .groupBy("agent_name", "date").agg(F.sum("payout").cast("double").alias("total_revenue"))
    )


def mid_trend(
    t: LedgerTables, start: DateLike, end: DateLike, mid: str | None = None
) -> DataFrame:
    rows = between(t.revenue, start, end)
    return _trend(rows, "mid") if mid is None else _trend(rows.filter(F.col("mid") == mid))


# --- partner months -------------------------------------------------------------------------

def _iso_sums(t: LedgerTables, date: DateLike | None) -> DataFrame:
    """(date, id, iso, total, house) of the partners known to the dimension."""
    rows = t.revenue if date is None else t.revenue.filter(F.col("date") == F.lit(as_date(date)))
    per_name = rows.groupBy("date", "iso").agg(
        F.sum("total_residual").alias("total"), F.sum("house_residual").alias("house")
    )
    return (
        per_name.join(t.iso.select("id", "iso"), "iso")
        .groupBy("date", "id", "iso").agg(F.sum("total").alias("total"), F.sum("house").alias("house"))
    )


def _adjustment_sums(t: LedgerTables) -> DataFrame:
    return t.adjustments.groupBy(F.col("iso_id").alias("id"), "date").agg(
        F.sum("adjustment_price").alias("adjusted"),
        F.max("adjustment_price").alias("largest"),
    )


def iso_month(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    """Partner totals with adjustments added.

    Adjustments are aggregated per partner and month first: joining them raw would repeat the
    ledger sums once per adjustment.
    """
    keys = ["date"] if date is None else []
    out = _iso_sums(t, date).join(_adjustment_sums(t), ["id", "date"], "left").select(
        *keys, "id", "iso", money(F.col("total")).alias("total_residual"),
        (F.col("house") + F.coalesce("adjusted", F.lit(0))).cast("double").alias("house_residual"),
        money(F.col("largest")).alias("adjustment_price"),
    )
    return out if date is None else out.orderBy("id")


def payments_recon(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    """Partner totals against what the bank received; equal payments of one month count once."""
    keys = ["date"] if date is None else []
    paid = t.payments.groupBy(F.col("iso_id").alias("id"), "date").agg(
        F.sum_distinct("bank_amount").alias("paid")
    )
    out = (
        _iso_sums(t, date).join(_adjustment_sums(t), ["id", "date"], "left")
        .join(paid, ["id", "date"], "left")
        .select(
            *keys, "id", "iso",
            (F.col("house") + F.coalesce("adjusted", F.lit(0))).cast("double").alias("house_residual"),
            money(F.col("paid")).alias("bank_amount"),
        )
    )
    return out if date is None else out.orderBy("id")


def _lines_of(
    t: LedgerTables, date: DateLike | None, column: str, value: str | None
) -> tuple[DataFrame, list[str]]:
    """Ledger lines of one (month, key) pair, or all lines keyed by both."""
    if (date is None) != (value is None):
        raise ValueError(f"give both date and {column}, or neither")
    rows, keys = one_or_all(t.revenue, date)
    if value is None:
        return rows, [*keys, column]
    return rows.filter(F.col(column) == value), keys


def iso_lines(t: LedgerTables, iso: str | None = None, date: DateLike | None = None) -> DataFrame:
    rows, keys = _lines_of(t, date, "iso", iso)
    return _merchant_lines(t, rows, "corporation", "dba").select(
        *keys, "mid", "corporation", "dba", *_doubles("total_residual", "house_residual"),
        *_agent_columns(),
    )


def corp_lines(
    t: LedgerTables, corporation: str | None = None, date: DateLike | None = None
) -> DataFrame:
    if (date is None) != (corporation is None):
        raise ValueError("give both date and corporation, or neither")
    rows, keys = one_or_all(t.revenue, date)
    lines = _merchant_lines(t, rows, "corporation", "dba")
    if corporation is None:
        keys = [*keys, "corporation"]
        lines = lines.filter("corporation IS NOT NULL")
    else:
        lines = lines.filter(F.col("corporation") == corporation)
    return lines.select(*keys, "mid", "iso", "dba", *_doubles("total_residual", "house_residual"))


def agent_lines(t: LedgerTables, agent: str | None = None, date: DateLike | None = None) -> DataFrame:
    """Lines of an agent with that agent's share; the first role wins when a name fills both."""
    if (date is None) != (agent is None):
        raise ValueError("give both date and agent, or neither")
    rows, keys = one_or_all(t.revenue, date)
    if agent is None:
        keys = [*keys, "agent_name"]
        roles = [
            F.struct(
                F.col(f"agent{i}_name").alias("agent_name"),
                F.col(f"agent{i}_percentage").alias("agent_percentage"),
                F.col(f"agent{i}_payout").alias("agent_payout"),
            )
            for i in (1, 2)
        ]
        second = F.when(~F.col("agent2_name").eqNullSafe(F.col("agent1_name")), roles[1])
        rows = rows.select("*", F.inline(F.array_compact(F.array(roles[0], second)))).filter(
            "agent_name IS NOT NULL"
        )
    else:
        rows = rows.filter((F.col("agent1_name") == agent) | (F.col("agent2_name") == agent))
        for out in ("percentage", "payout"):
            rows = rows.withColumn(
                f"agent_{out}",
                F.when(F.col("agent1_name") == agent, F.col(f"agent1_{out}"))
                .when(F.col("agent2_name") == agent, F.col(f"agent2_{out}")),
            )
    return _merchant_lines(t, rows, "corporation").select(
        *keys, "mid", "iso", "dba", "corporation",
        *_doubles("total_residual", "house_residual", "agent_percentage", "agent_payout"),
    )


# Windows, in days, offered by the change log.
CHANGE_WINDOWS = (1, 7, 14, 30, 45, 60, 90, 120)


def recent_changes(t: LedgerTables, as_of: str | dt.datetime, days: int = 1, log: DataFrame | None = None) -> DataFrame:
    """Ledger rows touched within ``days`` before ``as_of``, newest first.

    With the change log of the stored ledger only its days since then and the months they name are read.
    """
    require(as_of=as_of)
    if days not in CHANGE_WINDOWS:
        raise ValueError(f"days must be one of {CHANGE_WINDOWS}")
    clock = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    since = F.lit(str(clock - dt.timedelta(days=days))).cast("timestamp_ntz")
    kept = [c for c in LEDGER_COLUMNS if c not in ("updated_by",)]
    doubles = {*LINE_MONEY, *[c for c in AGENT_COLUMNS if not c.endswith("name")]}
    rows = t.revenue
    if log is not None:
        first = F.lit(str((clock - dt.timedelta(days=days)).date())).cast("date")
        months = [r["date"] for r in log.filter(F.col("changed_on") >= first).select("date").distinct().collect() if r["date"]]  # calendar months
        rows = rows.filter(F.col("date").isin(months) if months else F.lit(False))
    return (
        rows.filter(F.col("updated_at") >= since)
        .orderBy(F.desc("updated_at"), "date", "iso", "mid")
        .select(*[F.col(c).cast("double").alias(c) if c in doubles else F.col(c) for c in kept])
    )


def uploaded_isos(t: LedgerTables, date: DateLike | None = None) -> DataFrame:
    """Partners that already have ledger lines."""
    rows, keys = one_or_all(t.revenue, date)
    return rows.select(*keys, "iso").distinct()
