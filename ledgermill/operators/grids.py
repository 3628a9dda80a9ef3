"""Grid rows: one row per spreadsheet row, cells as an array ordered by column.

Header search is a row-local test plus one small aggregation (first matching row per sheet);
reading the table below it is a join of the rows with those header rows on (path, sheet).
Header rows are few, so Spark broadcasts them while they are small and otherwise shuffles,
where AQE can split a sheet that holds very many rows. No sheet is ever collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.text import stripped, unchanged
from ledgermill.schemas import SHEET_KEYS

TextRule = Callable[[Column], Column]


def to_cells(grid: DataFrame) -> DataFrame:
    """Long form: one row per non-empty cell."""
    return grid.select(
        "path", "sheet_idx", "sheet", "is_active", "row_idx", F.inline("cells")
    )


def values(clean: TextRule = unchanged) -> Column:
    """Cell texts of a grid row."""
    return F.transform(F.col("cells"), lambda c: clean(c["value"]))


def cell_at(col_idx: Column | int, cells: Column | str = "cells") -> Column:
    """The cell in a column, NULL when it is empty."""
    column = F.col(cells) if isinstance(cells, str) else cells
    return F.get(F.filter(column, lambda c: c["col_idx"] == col_idx), F.lit(0))


# --- which rows can be a header -------------------------------------------------------------

def has_all(headers: Column) -> Column:
    """Every header is the exact text of some cell."""
    texts = F.col("cells")["value"]
    # the first header alone rules out nearly every row
    return F.array_contains(texts, F.get(headers, F.lit(0))) & (
        F.size(F.array_except(headers, texts)) == 0
    )


def has_any(headers: Column) -> Column:
    """Some header is the trimmed text of some cell."""
    return F.arrays_overlap(values(stripped), headers)


def has_marker(marker: str, ignore_case: bool = False) -> Column:
    """Some cell contains ``marker``."""
    needle = F.lit(marker.lower() if ignore_case else marker)
    return F.exists(
        F.col("cells"),
        lambda c: F.contains(F.lower(c["value"]) if ignore_case else c["value"], needle),
    )


def has_cell(text: str) -> Column:
    """Some cell is exactly ``text``."""
    return F.array_contains(F.col("cells")["value"], text)


def first_rows(grid: DataFrame, condition: Column, *keep: str) -> DataFrame:
    """Per sheet the first row that meets ``condition``: (path, sheet_idx, header_row, header, keep)."""
    first = F.min_by(F.struct("row_idx", "cells", *keep), "row_idx").alias("h")
    return grid.filter(condition).groupBy(*SHEET_KEYS).agg(first).select(
        *SHEET_KEYS, F.col("h.row_idx").alias("header_row"), F.col("h.cells").alias("header"),
        *[F.col(f"h.{k}").alias(k) for k in keep],
    )


# --- columns under a header -----------------------------------------------------------------

def header_texts(clean: TextRule = unchanged) -> Column:
    return F.transform(F.col("header"), lambda c: clean(c["value"]))


def column_of(texts: Column, wanted: Column, last: bool = False) -> Column:
    """Column index of the first (or last) cell whose header is ``wanted``, NULL without one."""
    columns = F.col("header")["col_idx"]
    if last:
        texts, columns = F.reverse(texts), F.reverse(columns)
    return F.get(columns, (F.array_position(texts, wanted) - 1).cast("int"))


def first_candidate(texts: Column, candidates: Column, last: bool = False) -> Column:
    """Column index of the first candidate header that is present, in the order given."""
    return F.get(
        F.array_compact(F.transform(candidates, lambda c: column_of(texts, c, last))), F.lit(0)
    )


def missing_columns(texts: Column, required: Column) -> Column:
    """Required headers the header row does not have."""
    return F.array_except(required, texts)


def is_repeated(texts: Column, wanted: Column) -> Column:
    return F.size(F.filter(texts, lambda t: t == wanted)) > 1


def rows_below(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows under the header of their sheet, with the header's columns attached."""
    extra = [c for c in headers.columns if c in grid.columns and c not in SHEET_KEYS]
    return grid.join(headers.drop(*extra), list(SHEET_KEYS)).filter(
        F.col("row_idx") > F.col("header_row")
    )


def sheet_table(grid: DataFrame, headers: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rows below the header as named text columns. ``columns`` maps a target to the column
    index computed from ``headers``; a NULL index gives a NULL column."""
    located = headers.select(*SHEET_KEYS, "header_row", *[c.alias(f"_{t}") for t, c in columns.items()])
    return rows_below(grid, located).select(
        *SHEET_KEYS, "row_idx",
        *[cell_at(F.col(f"_{t}"))["value"].alias(t) for t in columns],
    )
