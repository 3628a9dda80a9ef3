"""Statement lines to ledger rows: guards, merchant checks, payouts, quarantine.

A statement loads as a whole or not at all. Instead of looping over lines, everything that has
to be known about a line is computed once per (statement, merchant id) pair, joined to the
merchants there, and brought back to the lines with a single join. A merchant that repeats in
very many lines is thereby combined map-side before the merchants are touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators import column_blocks, extract, form_sheets
from ledgermill.operators.layout_specs import SHEET_CANDIDATES, SHEET_LABELS, layouts
from ledgermill.schemas import AMOUNTS, LEDGER_COLUMNS, MONEY, PERCENT
from ledgermill.sources import sinks
from ledgermill.sources.tables import LedgerTables

Stage = Callable[[DataFrame, str], DataFrame]

# An amount with fractions of a cent.
EXACT = "decimal(26,8)"

# Fixed value: merchant id of a lump-sum line.
MANUAL_MID = "111123456"

MERCHANT_FIELDS = ("is_referred", "agent1_name", "agent1_split", "agent2_name", "agent2_split")
POSITION = ("sheet_idx", "row_idx")

ALREADY_LOADED = "already_loaded"
DUPLICATE = "duplicate_in_batch"
NO_LINES = "no_lines"
MISSING_MERCHANT = "missing_merchant"
MISSING_SPLIT = "missing_agent_split"
TOO_LARGE = "amount_out_of_range"
STATEMENT_REJECTED = "statement_rejected"
MISSING_FIELDS = "missing_fields"
UNREADABLE = "unreadable_file"


# --- L1: what is already there --------------------------------------------------------------

def _key(match: str) -> Column:
    """The form in which a partner's name is compared."""
    return F.lower("iso") if match == "caseless" else F.col("iso")


def _claims(rows: DataFrame, match: str, *aggregates: Column) -> DataFrame:
    """(date, iso) keys that block a statement. With ``match="prefix"`` a loaded name blocks
    every name it starts with, so each name stands for all of its prefixes; that turns the
    prefix comparison into an equality. With ``"caseless"`` names are the same that differ in case only."""
    if match not in ("exact", "caseless", "prefix"):
        raise ValueError("match must be 'exact', 'caseless' or 'prefix'")
    iso = _key(match)
    if match == "prefix":
        iso = F.explode(F.transform(F.sequence(F.lit(0), F.length("iso")), lambda n: F.substring("iso", F.lit(1), n)))
    kept = [c for c in rows.columns if c not in ("date", "iso")]
    claimed = rows.select("date", iso.alias("iso"), *kept)
    return claimed.groupBy("date", "iso").agg(*aggregates) if aggregates else claimed.distinct()


def _of_months(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The ledger's partners in the months of ``rows``; the range of months reaches the scan as a
    partition filter."""
    months = rows.select("date").distinct()
    ends = [rows.agg(f("date")).scalar() for f in (F.min, F.max)]
    own = ledger.select("date", "iso").filter(F.col("date").between(*ends))
    return own.join(months, "date", "left_semi").distinct()


def _names(statements: DataFrame, sheets: Iterable[str] | None = None) -> DataFrame:
    """The names under which a statement's lines may be in the ledger: its partner's, and for layouts
    that add the sheet's label to it, each of those. ``sheets`` are the sheets that such layouts read."""
    if "family" not in statements.columns:
        return statements.select("path", "date", "iso")
    labels = sorted({SHEET_LABELS.get(s, s) for s in (sheets or SHEET_CANDIDATES)})
    own = F.array("iso")
    labelled = F.concat(own, *[F.array(F.concat_ws(" ", "iso", F.lit(x))) for x in labels])
    return statements.select("path", "date", F.explode(F.when(F.col("family") == "multi_sheet", labelled).otherwise(own)).alias("iso"))


def flag_loaded(statements: DataFrame, ledger: DataFrame, match: str = "exact", sheets: Iterable[str] | None = None) -> DataFrame:
    """Statements with ``is_loaded``: whether their partner and month are in the ledger."""
    claims = _claims(_of_months(ledger, statements), match)
    found = _names(statements, sheets).withColumn("iso", _key(match)).join(claims, ["date", "iso"], "left_semi").select("path").distinct()
    return statements.join(found.withColumn("is_loaded", F.lit(True)), "path", "left").withColumn("is_loaded", F.coalesce("is_loaded", F.lit(False)))


def already_loaded(statements: DataFrame, ledger: DataFrame, match: str = "exact") -> DataFrame:
    """Statements whose partner and month are in the ledger."""
    return flag_loaded(statements, ledger, match).filter("is_loaded").select(*statements.columns)


def not_loaded(statements: DataFrame, ledger: DataFrame, match: str = "exact") -> DataFrame:
    return flag_loaded(statements, ledger, match).filter("NOT is_loaded").select(*statements.columns)


# --- L3 to L5: merchants --------------------------------------------------------------------

def missing_mids(lines: DataFrame, merchants: DataFrame) -> DataFrame:
    """Lines whose merchant is unknown, one row per line."""
    return lines.join(merchants.select("mid"), "mid", "left_anti")


def _per_merchant(lines: DataFrame) -> DataFrame:
    """(statement, merchant id) with the position of its first line."""
    return lines.groupBy("path", "mid").agg(
        F.min(F.struct(*POSITION)).alias("first_at"), F.max("reject").alias("_broken")
    )


def override_dba(lines: DataFrame, merchants: DataFrame, mode: str = "first_line") -> DataFrame:
    """Merchant names on lines.

    ``first_line``: the first line of each merchant in a statement takes the merchant's name,
    later ones keep the statement's. ``fill_missing``: only empty names are filled.
    """
    names = merchants.select("mid", F.col("dba").alias("_dba"))
    facts = lines.groupBy("path", "mid").agg(F.min(F.struct(*POSITION)).alias("first_at")).join(names, "mid")
    joined = lines.join(facts, ["path", "mid"], "left")
    return joined.withColumn("dba", _name(mode)).select(*lines.columns)


def _name(mode: str) -> Column:
    if mode == "fill_missing":
        return F.coalesce("dba", "_dba")
    if mode != "first_line":
        raise ValueError("mode must be 'first_line' or 'fill_missing'")
    first = F.struct(*POSITION) == F.col("first_at")
    return F.when(first, F.col("_dba")).otherwise(F.col("dba"))


def payout_columns(house: Column) -> dict[str, Column]:
    """Agent columns of a line from the merchant columns next to it. Shares are exact decimals;
    a second share of zero is no share."""
    referred = F.col("is_referred") == 1
    percent = F.lit(Decimal("0.01"))
    out: dict[str, Column] = {}
    for i in (1, 2):
        split = F.col(f"agent{i}_split")
        paid = referred if i == 1 else referred & (split != 0) & (house != 0)
        out[f"agent{i}_name"] = F.when(referred, F.col(f"agent{i}_name"))
        out[f"agent{i}_percentage"] = F.when(referred, split).cast(PERCENT)
        out[f"agent{i}_payout"] = F.when(paid, F.round(house * split * percent, 2)).cast(MONEY)
    return out


def agent_payouts(lines: DataFrame, merchants: DataFrame) -> DataFrame:
    """Lines with the six agent columns."""
    joined = lines.join(merchants.select("mid", *MERCHANT_FIELDS), "mid", "left")
    payouts = payout_columns(F.col("house_residual").try_cast(EXACT))
    return joined.select(*lines.columns, *[c.alias(n) for n, c in payouts.items()])


# --- L6: all or nothing ---------------------------------------------------------------------

def check_lines(lines: DataFrame, merchants: DataFrame, dba_mode: str = "first_line") -> DataFrame:
    """Every line with merchant name, payouts and a ``reject`` reason.

    A line of a statement in which any line fails is rejected too, as ``statement_rejected``.
    """
    # shares are taken from the amount as it was read and rounded once
    typed = lines.withColumn("_house", F.col("house_residual").try_cast(EXACT))
    typed = typed.withColumns({a: F.col(a).try_cast(MONEY) for a in AMOUNTS}).withColumn(
        "reject",
        F.coalesce("reject", F.when(
            F.col("volume").isNull() | F.col("total_residual").isNull() | F.col("house_residual").isNull(),
            TOO_LARGE,
        )),
    )
    facts = _per_merchant(typed).join(
        merchants.select("mid", F.col("dba").alias("_dba"), *MERCHANT_FIELDS, F.lit(True).alias("_known")),
        "mid", "left",
    ).withColumn(
        "_reason",
        F.when(F.col("_known").isNull(), MISSING_MERCHANT)
        .when((F.col("is_referred") == 1) & F.col("agent1_split").isNull(), MISSING_SPLIT),
    )
    verdict = facts.groupBy("path").agg(
        F.bool_or(F.col("_reason").isNotNull() | F.col("_broken").isNotNull()).alias("_fails")
    )
    facts = facts.drop("_broken", "_known").join(verdict, "path").withColumnRenamed("mid", "_mid").withColumnRenamed("path", "_path")
    joined = typed.join(
        facts, (F.col("path") == F.col("_path")) & F.col("mid").eqNullSafe(F.col("_mid")), "left"
    )
    reject = F.coalesce("reject", "_reason", F.when(F.col("_fails"), STATEMENT_REJECTED))
    return joined.select(
        *[c for c in lines.columns if c not in ("dba", "reject")], _name(dba_mode).alias("dba"),
        *[c.alias(n) for n, c in payout_columns(F.col("_house")).items()],
        reject.alias("reject"),
    )


def ledger_rows(checked: DataFrame, updated_by: str, updated_at: dt.datetime | str) -> DataFrame:
    return checked.filter("reject IS NULL").withColumns({
        "updated_by": F.lit(updated_by), "updated_at": F.lit(str(updated_at)).cast("timestamp_ntz"),
    }).select(*LEDGER_COLUMNS)


@dataclass(frozen=True)
class LoadResult:
    """``rows`` go to the ledger. ``lines`` are the refused lines, ``statements`` the refused
    statements, each with a reason."""

    rows: DataFrame
    lines: DataFrame
    statements: DataFrame


def extract_all(grid: DataFrame, registry: DataFrame, id_prefix: str = column_blocks.ID_PREFIX, **options) -> DataFrame:
    """Lines of a grid with mixed layouts, told apart by ``family``."""
    lines = extract.extract(grid, layouts(**options).values(), registry, options.get("sheet_candidates"))
    forms = form_sheets.form_per_sheet(grid.filter("family = 'form_per_sheet'"))
    blocks = column_blocks.column_blocks(grid.filter("family = 'column_blocks'"), id_prefix)
    return lines.unionByName(forms).unionByName(blocks)


def load_statements(
    grid: DataFrame, statements: DataFrame, registry: DataFrame, tables: LedgerTables,
    updated_by: str, updated_at: dt.datetime | str, match: str = "exact",
    dba_mode: str = "first_line", stage: Stage | None = None, **layout_options,
) -> LoadResult:
    """The whole chain for one batch.

    ``statements`` comes from ``identify``; ``grid`` may hold rows of any of its paths.
    Results that several later steps use are written once to shared storage and read back:
    the decoded rows (split by layout family, so each layout reads its own files), the lines and
    the checked lines. ``stage`` does that; by default it writes below ``spark.checkpoint.dir``.
    """
    if stage is None:
        spark = grid.sparkSession
        stage = sinks.stage_in(spark, sinks.shared_folder(spark))
    statements = stage(statements, "statements")
    usable = statements.filter("error IS NULL")
    broken = grid.filter("sheet_idx < 0").select("path").distinct()
    unread = usable.join(broken, "path", "left_semi").select("path", F.lit(UNREADABLE).alias("reason"))
    # one look at the ledger for those that are loaded and those that are not
    flagged = stage(flag_loaded(usable.join(broken, "path", "left_anti"), tables.revenue, match, layout_options.get("sheet_candidates")), "flagged")
    loaded = flagged.filter("is_loaded").select("path", F.lit(ALREADY_LOADED).alias("reason"))
    fresh = flagged.filter("NOT is_loaded").drop("is_loaded")
    rows = grid.join(fresh.select("path", "iso", "date", "layout", "family"), "path")
    lines = stage(extract_all(stage(rows, "grid"), registry, **layout_options), "lines")
    checked = stage(check_lines(lines, tables.merchants, dba_mode), "checked")

    # Of several good statements for one partner and month the first path is taken.
    # A statement stands for its partner's name as well as for the names on its lines.
    sound = checked.filter("reject IS NULL").select("path", "date", "iso").distinct()
    own = fresh.join(sound.select("path").distinct(), "path", "left_semi").select("path", "date", "iso")
    names = sound.union(own).distinct()
    claims = _claims(names, match, F.min("path").alias("_winner"))
    late = (
        names.withColumn("iso", _key(match)).join(claims, ["date", "iso"])
        .filter(F.col("_winner") < F.col("path")).select("path").distinct().withColumn("reason", F.lit(DUPLICATE))
    )
    per_path = checked.groupBy("path").agg(F.max("reject").alias("_reject"))
    judged = fresh.select("path").join(per_path.withColumn("_seen", F.lit(True)), "path", "left").select(
        "path",
        F.when(F.col("_seen").isNull(), NO_LINES).when(F.col("_reject").isNotNull(), STATEMENT_REJECTED).alias("reason"),
    )
    refused = (
        statements.filter("error IS NOT NULL").select("path", F.col("error").alias("reason"))
        .unionByName(unread).unionByName(loaded).unionByName(judged.filter("reason IS NOT NULL")).unionByName(late)
    )
    accepted = checked.join(late.select("path"), "path", "left_anti")
    return LoadResult(
        rows=ledger_rows(accepted, updated_by, updated_at),
        lines=checked.filter("reject IS NOT NULL"),
        statements=refused,
    )


# --- lump sums ------------------------------------------------------------------------------

def manual_revenue(
    entries: DataFrame, ledger: DataFrame, updated_by: str, updated_at: dt.datetime | str,
    match: str = "exact",
) -> tuple[DataFrame, DataFrame]:
    """Lump-sum lines ``(seq, date, iso, amount)``: (ledger rows, refused entries with reason).

    An entry is refused when its partner and month are in the ledger or in an earlier entry.
    """
    whole = F.col("date").isNotNull() & (F.coalesce("iso", F.lit("")) != "") & F.col("amount").isNotNull()
    good = entries.filter(whole)
    earlier = _claims(good.select("date", "iso", "seq"), match, F.min("seq").alias("_first"))
    loaded = _claims(_of_months(ledger, good), match).withColumn("_loaded", F.lit(True))
    keyed = good.withColumns({"_own": F.col("iso"), "iso": _key(match)})
    judged = keyed.join(earlier, ["date", "iso"], "left").join(loaded, ["date", "iso"], "left").withColumn("iso", F.col("_own")).withColumn(
        "reason",
        F.when(F.col("_loaded"), ALREADY_LOADED).when(F.col("_first") < F.col("seq"), DUPLICATE),
    )
    amount = F.col("amount").cast(MONEY)
    columns = {
        "mid": F.lit(MANUAL_MID), "dba": F.col("iso"), "volume": F.lit(0).cast(MONEY),
        "total_residual": amount, "house_residual": amount, "updated_by": F.lit(updated_by),
        "updated_at": F.lit(str(updated_at)).cast("timestamp_ntz"),
    }
    for i in (1, 2):
        columns[f"agent{i}_name"] = F.lit(None).cast("string")
        columns[f"agent{i}_percentage"] = F.lit(None).cast(PERCENT)
        columns[f"agent{i}_payout"] = F.lit(None).cast(MONEY)
    rows = judged.filter("reason IS NULL").withColumns(columns).select(*LEDGER_COLUMNS)
    refused = judged.filter("reason IS NOT NULL").select(*entries.columns, "reason").unionByName(
        entries.filter(~whole).withColumn("reason", F.lit(MISSING_FIELDS))
    )
    return rows, refused
