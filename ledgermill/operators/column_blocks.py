"""Layout ``column_blocks``: merchants side by side, each owning a run of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import merchant_ids, numbers
from ledgermill.operators import grids
from ledgermill.operators.extract import LINE_COLUMNS, with_family
from ledgermill.schemas import SHEET_KEYS

# Place of the block headings (0-based rows), the id prefix and the labels.
SHEET, DBA_ROW, MID_ROW, HEADING_ROW, SEARCH_WIDTH = 1, 3, 4, 5, 8
ID_PREFIX = "635400000000"
HEADINGS = {"count_col": "Merchant COUNT/Amount", "gross_col": "Gross Total", "payout_col": "ISO Payout"}
VOLUME_LABELS = ("Visa/MC/Discover Interchange Dues", "AMEX Sponsorship Fee")
TOTAL_END_LABEL = "Total Income"
HOUSE_LABEL = "NET residuals for payout"

_CELLS = "array<struct<col_idx:int,value:string,kind:string>>"


def _headings(cells: Column) -> Column:
    """Heading cells with the first role each one's text stands for."""
    def role(cell: Column) -> Column:
        out = F
        for name, label in HEADINGS.items():
            out = out.when(F.contains(cell["value"], F.lit(label)), name)
        return out

    return F.filter(
        F.transform(cells, lambda c: F.struct(c["col_idx"].alias("col_idx"), role(c).alias("role"))),
        lambda h: h["role"].isNotNull(),
    )


def _first_in_block(start: Column, role: str) -> Column:
    found = F.filter(
        F.col("headings"),
        lambda h: (h["role"] == role) & h["col_idx"].between(start, start + (SEARCH_WIDTH - 1)),
    )
    return F.array_min(F.transform(found, lambda h: h["col_idx"]))


def _blocks(grid: DataFrame, id_prefix: str) -> DataFrame:
    """Sheets with their blocks (start, id, name and three columns each) and the two row marks.

    A block is skipped while a previous block still covers its column, so the ids of a sheet
    are folded from left to right; the fold runs over the cells of one spreadsheet row.
    """
    label = F.col("label")

    def row(index: int) -> Column:
        return F.get(F.filter("tops", lambda t: t["row_idx"] == index), F.lit(0))["cells"]

    # one pass: the marks, and the cells of three rows per sheet (a list, so that nothing is sorted)
    tops = F.when(F.col("row_idx").isin(DBA_ROW, MID_ROW, HEADING_ROW), F.struct("row_idx", "cells"))
    sheets = grid.groupBy(*SHEET_KEYS).agg(
        F.max(F.array_max(F.col("cells")["col_idx"])).alias("last_column"),
        F.min(F.when((F.col("row_idx") >= HEADING_ROW) & F.contains(label, F.lit(TOTAL_END_LABEL)),
                     F.col("row_idx"))).alias("total_end"),
        F.min(F.when(F.contains(label, F.lit(HOUSE_LABEL)), F.col("row_idx"))).alias("house_row"),
        F.collect_list(tops).alias("tops"), F.first("iso").alias("iso"), F.first("date").alias("date"),
    ).withColumns({
        "names": row(DBA_ROW), "ids": row(MID_ROW), "heads": F.coalesce(row(HEADING_ROW), F.expr(f"cast(array() as {_CELLS})")),
    })
    sheets = sheets.filter("ids IS NOT NULL").withColumn("headings", _headings(F.col("heads")))
    starts = F.filter(
        F.transform(
            F.col("ids"),
            lambda c: F.struct(c["col_idx"].alias("col_idx"), merchant_ids.canonical(c).alias("mid")),
        ),
        lambda c: F.startswith(c["mid"], F.lit(id_prefix)) & (c["col_idx"] < F.col("last_column")),
    )
    candidates = F.transform(
        starts,
        lambda s: F.struct(
            s["col_idx"].alias("start"), s["mid"].alias("mid"),
            *[_first_in_block(s["col_idx"], role).alias(role) for role in HEADINGS],
        ),
    )
    block = "struct<start:int,mid:string,count_col:int,gross_col:int,payout_col:int>"
    empty = F.struct(F.lit(-1).alias("covered"), F.expr(f"cast(array() as array<{block}>)").alias("blocks"))
    folded = F.aggregate(
        candidates, empty,
        lambda acc, c: F.when(c["start"] <= acc["covered"], acc).otherwise(
            F.struct(F.coalesce(c["payout_col"], c["start"]).alias("covered"),
                     F.concat(acc["blocks"], F.array(c)).alias("blocks"))
        ),
        lambda acc: acc["blocks"],
    )
    complete = F.filter(
        folded,
        lambda b: b["count_col"].isNotNull() & b["gross_col"].isNotNull() & b["payout_col"].isNotNull(),
    )
    named = F.transform(complete, lambda b: F.struct(
        b["start"].alias("start"), b["mid"].alias("mid"), merchant_ids.canonical(grids.cell_at(b["start"], "names")).alias("dba"),
        *[b[role].alias(role) for role in HEADINGS],
    ))
    return sheets.select(*SHEET_KEYS, "iso", "date", "total_end", "house_row", named.alias("blocks")).filter(F.size("blocks") > 0)


def column_blocks(grid: DataFrame, id_prefix: str = ID_PREFIX) -> DataFrame:
    """One line per complete block.

    A row meets the few blocks of its sheet as one array and picks each block's three cells from its
    own; the sums need no further shuffle, as rows already lie together by sheet.
    """
    rows = with_family(grid, "column_blocks").filter(F.col("sheet_idx") == SHEET).withColumn(
        "label", grids.cell_at(F.lit(0))["value"]
    )
    blocks = _blocks(rows, id_prefix)
    is_volume = F.lit(False)
    for text_label in VOLUME_LABELS:
        is_volume = is_volume | F.contains(F.col("label"), F.lit(text_label))
    below = F.col("row_idx") >= HEADING_ROW
    counts = {
        "count_col": below & is_volume,
        "gross_col": below & (F.col("total_end").isNull() | (F.col("row_idx") < F.col("total_end"))),
        "payout_col": F.col("row_idx") == F.col("house_row"),
    }
    met = rows.select(*SHEET_KEYS, "row_idx", "label", "cells").join(blocks, list(SHEET_KEYS))
    # a row's cells that count, each with its block; the row of the ids names every block
    def cells_of(b: Column) -> Column:
        found = [
            F.struct(b["start"].alias("start"), b["mid"].alias("mid"), b["dba"].alias("dba"), F.lit(role).alias("role"),
                     F.when(F.col(f"is_{role}"), grids.cell_at(b[role])["value"]).alias("value"))
            for role in HEADINGS
        ]
        return F.filter(F.array(*found), lambda x: x["value"].isNotNull() | ((F.col("row_idx") == MID_ROW) & (x["role"] == "count_col")))

    needed = F.col("row_idx") == MID_ROW
    for condition in counts.values():
        needed = needed | condition
    met = met.filter(needed).withColumns({f"is_{role}": F.coalesce(condition, F.lit(False)) for role, condition in counts.items()})
    values = met.select(*SHEET_KEYS, "iso", "date", F.inline(F.flatten(F.transform("blocks", cells_of))))
    amount = numbers.exact(numbers.money_lenient(F.col("value")))

    def total(role: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("role") == role, F.col("amount"))), F.lit(0)).cast("double")

    sums = values.withColumn("amount", amount).groupBy(*SHEET_KEYS, "iso", "date", "start", "mid", "dba").agg(
        total("count_col").alias("volume"), total("gross_col").alias("total_residual"), total("payout_col").alias("house_residual"),
    )
    return sums.withColumn("row_idx", F.col("start").cast("bigint")).withColumn(
        "reject", F.lit(None).cast("string")
    ).select(*LINE_COLUMNS)
