"""Tiny hand-written grids."""

from __future__ import annotations

from ledgermill.schemas import GRID_SCHEMA


def kind_of(value):
    return "n" if isinstance(value, (int, float)) and not isinstance(value, bool) else "s"


def grid(spark, sheets, path="p.csv", active=0):
    """``sheets``: {sheet name: [[cell, ...], ...]}; None is an empty cell."""
    rows = []
    for sheet_idx, (name, lines) in enumerate(sheets.items()):
        for row_idx, line in enumerate(lines):
            cells = [(i, str(v), kind_of(v)) for i, v in enumerate(line) if v is not None]
            if cells:
                rows.append((path, sheet_idx, name, sheet_idx == active, row_idx, cells))
    return spark.createDataFrame(rows, GRID_SCHEMA)


def lines(df):
    rows = df.orderBy("path", "sheet_idx", "row_idx", "mid").collect()
    return [(r.mid, r.dba, r.volume, r.total_residual, r.house_residual, r.reject) for r in rows]
