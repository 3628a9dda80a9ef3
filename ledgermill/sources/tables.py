"""Ledger and dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgermill import schemas as S

TABLE_SCHEMAS = {
    "revenue": S.LEDGER_SCHEMA,
    "merchants": S.MERCHANT_SCHEMA,
    "iso": S.ISO_SCHEMA,
    "adjustments": S.ADJUSTMENT_SCHEMA,
    "payments": S.PAYMENT_SCHEMA,
    "sic_codes": S.SIC_SCHEMA,
}


@dataclass(frozen=True)
class LedgerTables:
    """The six tables every report is written against."""

    revenue: DataFrame
    merchants: DataFrame
    iso: DataFrame
    adjustments: DataFrame
    payments: DataFrame
    sic_codes: DataFrame


def scan_tables(spark: SparkSession, root: str) -> LedgerTables:
    """Parquet tables under ``root``; ``revenue`` is partitioned by ``date``."""
    return LedgerTables(
        **{
            name: spark.read.schema(schema).parquet(f"{root}/{name}")
            for name, schema in TABLE_SCHEMAS.items()
        }
    )


def scan_tables_jdbc(spark: SparkSession, url: str, **options: str) -> LedgerTables:
    """The same tables from a live database; add ``partitionColumn`` and bounds in ``options``
    to read the ledger in parallel."""
    return LedgerTables(
        **{
            name: spark.read.format("jdbc").option("url", url).option("dbtable", name)
            .options(**options).load()
            for name in TABLE_SCHEMAS
        }
    )
