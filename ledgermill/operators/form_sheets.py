"""Layout ``form_per_sheet``: every sheet is a label/value form for one merchant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import numbers, text
from ledgermill.operators import grids
from ledgermill.operators.extract import LINE_COLUMNS, REJECT_AMOUNT, REJECT_MID, with_family
from ledgermill.schemas import SHEET_KEYS

# Labels of the form.
MID_LABEL = "Mid#"
NAME_LABELS = ("DBA:", "Merchant :")
VOLUME_HEADER = "Per Transaction"
HOUSE_LABEL = "Total Commissions due"
VOLUME_OFFSET = 2


def _first(value: Column, condition: Column) -> Column:
    """``value`` in the first row that meets ``condition``."""
    return F.min_by(value, F.when(condition, F.col("row_idx")))


def form_per_sheet(grid: DataFrame) -> DataFrame:
    """One line per sheet that has a merchant id label.

    The first aggregation sees only the few rows that hold a label; the second one finds the
    cells whose place depends on those labels.
    """
    grid = with_family(grid, "form_per_sheet")
    label_text = grids.cell_at(F.lit(0))["value"]
    cells = F.col("cells")
    filled = F.filter(cells, lambda c: c["value"].isNotNull())
    first_filled = F.get(filled, F.lit(0))["col_idx"]
    marked = F.transform(
        F.filter(cells, lambda c: F.contains(c["value"], F.lit(VOLUME_HEADER))), lambda c: c["col_idx"]
    )
    labelled = {label: grids.has_marker(label) for label in (MID_LABEL, *NAME_LABELS, HOUSE_LABEL)}
    marked_rows = grids.has_marker(VOLUME_HEADER)
    for found in labelled.values():
        marked_rows = marked_rows | found
    sheets = grid.filter(marked_rows).groupBy(*SHEET_KEYS).agg(
        *[
            F.struct(F.max(F.when(labelled[label], F.lit(True))).alias("seen"),
                     _first(label_text, labelled[label]).alias("text")).alias(name)
            for name, label in zip(("mid_row", "dba_row", "merchant_row"), (MID_LABEL, *NAME_LABELS))
        ],
        _first(grids.cell_at(first_filled + 1)["value"], labelled[HOUSE_LABEL]).alias("house"),
        F.min(F.array_min(marked)).alias("volume_column"),
    ).filter("mid_row.seen")

    # rows of a sheet lie together after the join, so start and volume need no further shuffle
    located = grid.select(*SHEET_KEYS, "row_idx", "iso", "date", "cells").join(sheets, list(SHEET_KEYS)).select(
        *SHEET_KEYS, "row_idx", "iso", "date", *[c for c in sheets.columns if c not in (*SHEET_KEYS, "volume_column")],
        grids.cell_at(F.col("volume_column"))["value"].alias("value"),
    )
    start = F.min(F.when(F.col("value").isNotNull(), F.col("row_idx"))).over(Window.partitionBy(*SHEET_KEYS))
    volumes = located.withColumn("start", start).groupBy(*SHEET_KEYS).agg(
        F.max(F.when(F.col("row_idx") == F.col("start") + VOLUME_OFFSET, F.col("value"))).alias("raw_volume"),
        *[F.first(c).alias(c) for c in ("iso", "date", "mid_row", "dba_row", "merchant_row", "house")],
    )

    name = F.when(F.col("dba_row.seen"), text.text_after_marker(F.col("dba_row.text"), NAME_LABELS[0])).when(
        F.col("merchant_row.seen"), text.text_after_marker(F.col("merchant_row.text"), NAME_LABELS[1])
    )
    volume = numbers.cents(numbers.to_number(F.col("raw_volume")))
    house = numbers.money_paren_plain(F.col("house"))
    mid = text.text_after_marker(F.col("mid_row.text"), MID_LABEL)
    return (
        volumes.select(
            *SHEET_KEYS, F.lit(0).cast("bigint").alias("row_idx"), "iso", "date",
            mid.alias("mid"), name.alias("dba"), volume.alias("volume"),
            F.lit(0.0).alias("total_residual"), house.alias("house_residual"),
        )
        .withColumn(
            "reject",
            F.when(F.coalesce(F.col("mid"), F.lit("")) == "", REJECT_MID)
            .when(F.col("volume").isNull() | F.col("house_residual").isNull(), REJECT_AMOUNT),
        )
        .select(*LINE_COLUMNS)
    )
