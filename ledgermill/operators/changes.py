"""Batches of edits as ``(table, changes) -> new table``.

Each change row carries ``seq``, its order in the batch. Keys are looked up in the table as it
was before the batch; of several changes to one key the last wins, of several inserts of one
key the first does. The last change per key is an aggregation, not a window, so a key edited
very often is reduced map-side.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.schemas import AGENT_COLUMNS, AMOUNTS, REFERRAL_TYPES

AGENT_FIELDS = ("agent1_name", "agent1_split", "agent2_name", "agent2_split")
NOT_FOUND, MISSING, INVALID, EXISTS = "not_found", "missing_fields", "invalid_referral_type", "already_exists"
RANGES = 256


@dataclass(frozen=True)
class Changed:
    """The new table, the refused changes with ``reason``, audit rows where there are any, and the rows
    that were added or took another's place where these follow from looking at the whole table."""

    table: DataFrame
    refused: DataFrame
    audit: DataFrame | None = None
    rows: DataFrame | None = None


def last_per_key(changes: DataFrame, *keys: str) -> DataFrame:
    rest = [c for c in changes.columns if c not in keys]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "seq").alias("_c")).select(*keys, "_c.*")


def first_per_key(changes: DataFrame, *keys: str) -> DataFrame:
    rest = [c for c in changes.columns if c not in keys]
    return changes.groupBy(*keys).agg(F.min_by(F.struct(*rest), "seq").alias("_c")).select(*keys, "_c.*")


def _refuse(rows: DataFrame, reason: str) -> DataFrame:
    return rows.withColumn("reason", F.lit(reason))


def _filled(value: str) -> Column:
    """Neither NULL nor an empty text."""
    return F.coalesce(F.col(value), F.lit("")) != ""


def number_rows(rows: DataFrame, start: DataFrame, column: str) -> DataFrame:
    """Consecutive ids in ``seq`` order after the one value of ``start``.

    Rows are numbered inside ranges of ``seq`` with about equal numbers of rows, whatever its
    values, and each range starts after the counts of the ranges before it; no task sees all rows.
    """
    # quantiles of seq: RANGES - 1 numbers
    cuts = sorted(set(rows.approxQuantile("seq", [k / RANGES for k in range(1, RANGES)], 1 / (4 * RANGES))))
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<double>")
    bucketed = rows.withColumn("_bucket", F.size(F.filter(edges, lambda c: c <= F.col("seq"))))
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    every = counts.agg(F.collect_list(F.struct("_bucket", "_n")).alias("_all")).select(F.explode("_all").alias("_one"), "_all")
    earlier = F.aggregate(
        F.filter("_all", lambda x: x["_bucket"] < F.col("_one._bucket")), F.lit(0).cast("bigint"), lambda n, x: n + x["_n"]
    )
    offsets = every.select("_one._bucket", earlier.alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("seq"))
    return (
        bucketed.withColumn("_nth", inside).join(offsets, "_bucket")
        .withColumn("_start", start.scalar())
        .withColumn(column, F.coalesce("_start", F.lit(0)) + F.col("_offset") + F.col("_nth"))
        .drop("_bucket", "_offset", "_nth", "_start")
    )


def replace_rows(table: DataFrame, rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``table`` whose key is in ``rows`` are replaced by them; other keys are added."""
    kept = table.join(rows.select(*keys), list(keys), "left_anti").select(*table.columns)
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema]
    return kept.unionByName(rows.select(*typed))


def _overwrite(table: DataFrame, changes: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Every row under a changed key takes the change's values; duplicates are all updated."""
    values = changes.select(*keys, F.struct(*columns.values()).alias("_new"))
    updated = table.join(values, keys, "left")
    return updated.select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{columns[f.name]}").cast(f.dataType))
        .otherwise(F.col(f.name)).alias(f.name) if f.name in columns else F.col(f.name)
        for f in table.schema
    ])


# --- merchants ------------------------------------------------------------------------------

def merchants_upsert(merchants: DataFrame, changes: DataFrame) -> Changed:
    """Insert or overwrite by ``mid``; agents are kept only for referred merchants."""
    good = changes.filter(F.col("mid").isNotNull())
    latest = last_per_key(good, "mid")
    referred = F.coalesce(F.col("is_referred").cast("int"), F.lit(0)) != 0
    latest = latest.withColumns({c: F.when(referred, F.col(c)) for c in AGENT_FIELDS})
    return Changed(replace_rows(merchants, latest, "mid"), _refuse(changes.filter("mid IS NULL"), MISSING))


def merchants_delete(merchants: DataFrame, keys: DataFrame) -> Changed:
    wanted = keys.select("mid").distinct()
    return Changed(
        merchants.join(wanted, "mid", "left_anti").select(*merchants.columns),
        _refuse(wanted.join(merchants.select("mid"), "mid", "left_anti"), NOT_FOUND),
    )


# --- partners -------------------------------------------------------------------------------

def iso_upsert(isos: DataFrame, changes: DataFrame) -> Changed:
    """Edits by ``id``; a change without id (or with 0) adds a partner under the next id."""
    filled = _filled("iso") & _filled("referral_type")
    valid = filled & F.col("referral_type").isin(*REFERRAL_TYPES)
    is_edit = F.coalesce(F.col("id"), F.lit(0)) != 0
    good = changes.filter(valid)
    edits = good.filter(is_edit)
    known = edits.join(isos.select("id"), "id", "left_semi")
    latest = last_per_key(known.select(*changes.columns), "id")
    inserts = number_rows(good.filter(~is_edit).drop("id"), isos.agg(F.max("id")), "id")
    refused = (
        _refuse(changes.filter(~filled), MISSING)
        .unionByName(_refuse(changes.filter(filled & ~F.col("referral_type").isin(*REFERRAL_TYPES)), INVALID))
        .unionByName(_refuse(edits.join(isos.select("id"), "id", "left_anti").select(*changes.columns), NOT_FOUND))
    )
    rows = latest.select(*isos.columns).unionByName(inserts.select(*isos.columns))
    return Changed(replace_rows(isos, rows, "id"), refused, rows=rows)


# --- adjustments and payments ---------------------------------------------------------------

def adjustments_upsert(adjustments: DataFrame, changes: DataFrame) -> Changed:
    """Edits by ``id``; without id an insert, refused when partner and month already have one.
    Amounts of zero count as missing."""
    filled = (
        (F.coalesce(F.col("iso_id"), F.lit(0)) != 0) & F.col("date").isNotNull()
        & (F.coalesce(F.col("adjustment_price"), F.lit(0)) != 0)
    )
    is_edit = F.coalesce(F.col("id"), F.lit(0)) != 0
    good = changes.filter(filled)
    edits, inserts = good.filter(is_edit), good.filter(~is_edit)
    known = edits.join(adjustments.select("id"), "id", "left_semi").select(*changes.columns)
    taken = adjustments.select("iso_id", "date").distinct()
    free = inserts.join(taken, ["iso_id", "date"], "left_anti").select(*changes.columns)
    winners = first_per_key(free.drop("id"), "iso_id", "date")
    added = number_rows(winners, adjustments.agg(F.max("id")), "id")
    second = free.join(winners.select("iso_id", "date", F.col("seq").alias("_winner")), ["iso_id", "date"]).filter(
        F.col("seq") != F.col("_winner")
    )
    refused = (
        _refuse(changes.filter(~filled), MISSING)
        .unionByName(_refuse(edits.join(adjustments.select("id"), "id", "left_anti").select(*changes.columns), NOT_FOUND))
        .unionByName(_refuse(inserts.join(taken, ["iso_id", "date"], "left_semi").select(*changes.columns), EXISTS))
        .unionByName(_refuse(second.select(*changes.columns), EXISTS))
    )
    rows = last_per_key(known, "id").select(*adjustments.columns).unionByName(added.select(*adjustments.columns))
    return Changed(replace_rows(adjustments, rows, "id"), refused, rows=rows)


def payments_upsert(payments: DataFrame, changes: DataFrame) -> Changed:
    """Overwrite or add the bank amount of a partner and month. Zero counts as missing."""
    filled = (
        (F.coalesce(F.col("iso_id"), F.lit(0)) != 0) & F.col("date").isNotNull()
        & (F.coalesce(F.col("bank_amount"), F.lit(0)) != 0)
    )
    keys = ["iso_id", "date"]
    latest = last_per_key(changes.filter(filled), *keys)
    updated = _overwrite(payments, latest, keys, {"bank_amount": "bank_amount"})
    added = latest.join(payments.select(*keys), keys, "left_anti").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in payments.schema]
    )
    return Changed(updated.unionByName(added), _refuse(changes.filter(~filled), MISSING))


# --- ledger ---------------------------------------------------------------------------------

LEDGER_KEYS = ["date", "iso", "mid"]
LEDGER_EDITS = ("mid", "dba", *AMOUNTS, *AGENT_COLUMNS)


def ledger_update(
    ledger: DataFrame, changes: DataFrame, updated_by: str | None = None, updated_at: dt.datetime | str | None = None,
) -> Changed:
    """Overwrite the lines under (date, iso, old_mid), which may give them another ``mid``.

    With ``updated_by`` or ``updated_at`` the edited lines carry that stamp; without them the stamp of the load stays.
    """
    latest = last_per_key(changes, "date", "iso", "old_mid")
    renamed = latest.select(
        "date", "iso", F.col("old_mid").alias("mid"), F.col("mid").alias("new_mid"),
        *[c for c in LEDGER_EDITS if c != "mid"],
    )
    stamps = {}
    if updated_by is not None:
        stamps["updated_by"] = F.lit(updated_by)
    if updated_at is not None:
        stamps["updated_at"] = F.lit(str(updated_at)).cast("timestamp_ntz")
    edits = {c: ("new_mid" if c == "mid" else c) for c in (*LEDGER_EDITS, *stamps)}
    table = _overwrite(ledger, renamed.withColumns(stamps) if stamps else renamed, LEDGER_KEYS, edits)
    refused = renamed.select(*LEDGER_KEYS).join(ledger.select(*LEDGER_KEYS), LEDGER_KEYS, "left_anti")
    return Changed(table, _refuse(refused, NOT_FOUND))


def ledger_delete(ledger: DataFrame, keys: DataFrame) -> Changed:
    wanted = keys.select(*LEDGER_KEYS).distinct()
    return Changed(
        ledger.join(wanted, LEDGER_KEYS, "left_anti").select(*ledger.columns),
        _refuse(wanted.join(ledger.select(*LEDGER_KEYS), LEDGER_KEYS, "left_anti"), NOT_FOUND),
    )


def iso_month_delete(ledger: DataFrame, keys: DataFrame, deleted_by: str) -> Changed:
    """Delete partner-months; the audit has one row per partner-month that had lines."""
    pair = ["date", "iso"]
    wanted = keys.select(*pair).distinct()
    present = ledger.select(*pair).distinct()
    return Changed(
        ledger.join(wanted, pair, "left_anti").select(*ledger.columns),
        _refuse(wanted.join(present, pair, "left_anti"), NOT_FOUND),
        wanted.join(present, pair, "left_semi").withColumn("deleted_by", F.lit(deleted_by)),
    )
