"""Bulk load of merchants from CSV rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import dates
from ledgermill.sources import csv_cells, csv_lines

# Columns of the file, in order.
BULK_COLUMNS = (
    "mid", "dba", "corporation", "iso", "iso_referral_type", "sic_code", "sic_description",
    "agent1_name", "agent2_name", "total_split", "is_active", "is_referred", "approval_date",
    "closed_date", "agent1_split", "agent2_split",
)
# Columns whose empty values become the text None, and their zero counterparts.
NONE_TEXT_COLUMNS = (
    "corporation", "dba", "iso", "iso_referral_type", "sic_code", "sic_description",
    "agent1_name", "agent2_name",
)
ZERO_COLUMNS = ("total_split", "agent1_split", "agent2_split")


def clean_merchants(rows: DataFrame) -> DataFrame:
    """Text rows in ``BULK_COLUMNS`` to typed merchants; ``line`` orders the file if present."""
    def convert(name: str) -> Column:
        text = F.col(name)
        if name in NONE_TEXT_COLUMNS:
            filled = F.coalesce(text, F.lit("None"))
            return F.substring(filled, 1, 4) if name == "sic_code" else filled
        if name in ZERO_COLUMNS:
            return F.coalesce(text.try_cast("decimal(5,2)"), F.lit(0).cast("decimal(5,2)"))
        if name == "approval_date":
            return F.try_to_date(text, "d/M/yyyy")
        if name == "closed_date":
            return dates.day(dates.without_time(text))
        return text.try_cast("int") if name in ("is_active", "is_referred") else text
    extra = [c for c in rows.columns if c not in BULK_COLUMNS]
    return rows.select(*[convert(c).alias(c) for c in BULK_COLUMNS], *extra)


def add_merchants(merchants: DataFrame, rows: DataFrame) -> DataFrame:
    """Merchants plus the new ones of the files: known ids are ignored, and of several rows with
    one id the first ``line`` is taken. Rows without id, such as those of unreadable files, add nothing."""
    cleaned = clean_merchants(rows).filter("mid IS NOT NULL")
    kept = [c for c in merchants.columns if c != "mid"]
    first = cleaned.groupBy("mid").agg(F.min_by(F.struct(*kept), "line").alias("_m")).select("mid", "_m.*")
    new = first.join(merchants.select("mid"), "mid", "left_anti")
    return merchants.unionByName(new.select(*merchants.columns))


def read_merchant_csv(spark: SparkSession, location: str | list[str]) -> DataFrame:
    """Records of every CSV file below a folder, behind a glob or in a list, as text columns by position.

    The first record of a file is its header; columns beyond the known ones are left out. ``line`` orders records by path and by their number in the
    file, which follows from the counts of its splits. A file that is no UTF-8 or ends inside a quote has one row, with the reason in ``problem``.
    """
    found = csv_lines.read_records(spark, location).filter("row_idx <> 0")
    cells = found.withColumn("cells", F.map_from_entries(F.transform(csv_cells.fields(F.col("record")), lambda c: F.struct(c["col_idx"], c["value"]))))
    columns = [F.try_element_at("cells", F.lit(k)).alias(c) for k, c in enumerate(BULK_COLUMNS)]
    return cells.select(*columns, F.struct("path", "row_idx").alias("line"), "problem")
