"""Listings and lookups over the dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.plans.periods import require
from ledgermill.sources.tables import LedgerTables

MERCHANT_LISTING = (
    "agent1_name", "agent1_split", "agent2_name", "agent2_split", "approval_date", "closed_date",
    "corporation", "dba", "is_active", "is_referred", "iso", "iso_referral_type", "mid",
)
MERCHANT_DETAIL = (*MERCHANT_LISTING, "sic_code", "sic_description")


def merchants(t: LedgerTables) -> DataFrame:
    return t.merchants.select(*MERCHANT_LISTING)


def unique_corporations(t: LedgerTables) -> DataFrame:
    return t.merchants.select("corporation").filter("corporation <> ''").distinct()


def unique_mid_dba(t: LedgerTables) -> DataFrame:
    return t.merchants.select("mid", "dba", "iso").distinct()


def unique_iso(t: LedgerTables) -> DataFrame:
    return t.iso.select("id", "iso", "is_active").distinct()


def isos(t: LedgerTables) -> DataFrame:
    return t.iso.select("id", "iso", "referral_type", "is_active")


def mids_per_iso(t: LedgerTables, iso: str | None = None) -> DataFrame:
    rows = t.merchants if iso is None else t.merchants.filter(F.col("iso") == iso)
    return rows.select(
        "mid", "iso", "dba", "corporation", F.col("is_active").cast("int").alias("is_active"),
        F.col("is_referred").cast("int").alias("is_referred"), "iso_referral_type",
        "approval_date", "closed_date",
    )


def agent_mids(t: LedgerTables, agent: str | None = None) -> DataFrame:
    """Merchants an agent serves in either role; without a name, one row per (agent, merchant)."""
    if agent is not None:
        return t.merchants.filter(
            (F.col("agent1_name") == agent) | (F.col("agent2_name") == agent)
        ).select("mid", "dba", "iso")
    names = F.array_distinct(F.array_compact(F.array("agent1_name", "agent2_name")))
    return t.merchants.select(F.explode(names).alias("agent_name"), "mid", "dba", "iso")


def sic_codes(t: LedgerTables) -> DataFrame:
    return t.sic_codes.select("sic_code", "description")


def adjustments(t: LedgerTables) -> DataFrame:
    named = t.iso.select(F.col("id").alias("iso_id"), "iso")
    return t.adjustments.join(named, "iso_id").select(
        "id", "iso", F.col("adjustment_price").cast("double").alias("adjustment_price"), "date"
    )


def lookup(table: DataFrame, keys: DataFrame, key: str, *columns: str) -> DataFrame:
    """The wanted columns for a batch of keys, with ``found`` telling whether the key exists."""
    require(key=key)
    wanted = table.select(key, *[c for c in columns if c != key], F.lit(True).alias("_hit"))
    return (
        keys.select(key).distinct().join(wanted, key, "left")
        .select(key, *[c for c in columns if c != key], F.col("_hit").isNotNull().alias("found"))
    )


def merchant_lookup(t: LedgerTables, keys: DataFrame) -> DataFrame:
    return lookup(t.merchants, keys, "mid", *MERCHANT_DETAIL)


def iso_lookup(t: LedgerTables, keys: DataFrame) -> DataFrame:
    return lookup(t.iso, keys, "id", "iso", "referral_type", "is_active")


def adjustment_lookup(t: LedgerTables, keys: DataFrame) -> DataFrame:
    return lookup(t.adjustments, keys, "id", "iso_id", "adjustment_price", "date")
