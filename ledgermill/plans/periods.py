"""Parameter handling shared by the reports."""

from __future__ import annotations

import datetime as dt
from calendar import monthrange

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = str | dt.date


def require(**params: object) -> None:
    """Raise on a missing required argument instead of comparing with NULL."""
    missing = [name for name, value in params.items() if value is None or value == ""]
    if missing:
        raise ValueError(f"missing required argument: {', '.join(missing)}")


def as_date(value: DateLike) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def one_or_all(df: DataFrame, date: DateLike | None) -> tuple[DataFrame, list[str]]:
    """Rows of one month and no period key, or every row keyed by ``date``.

    The equality is on the partition column, so a single month prunes to its partition.
    """
    if date is None:
        return df, ["date"]
    return df.filter(F.col("date") == F.lit(as_date(date))), []


def between(df: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    require(start=start, end=end)
    return df.filter(F.col("date").between(F.lit(as_date(start)), F.lit(as_date(end))))


def month_spine(start: DateLike, end: DateLike) -> list[dt.date]:
    """Months stepped from ``start`` while the current month lies before ``end``.

    The first month is always present, and the last step may pass ``end``. Each step starts
    from the previous one, so the day of month can only fall (31 -> 29 -> 29).
    """
    month, stop = as_date(start), as_date(end)
    spine = [month]
    while month < stop:
        year, zero_based = divmod(month.year * 12 + month.month, 12)
        month = dt.date(
            year, zero_based + 1, min(month.day, monthrange(year, zero_based + 1)[1])
        )
        spine.append(month)
    return spine


def money(total: Column) -> Column:
    """Report edge: NULL becomes 0 and the exact decimal becomes a double."""
    return F.coalesce(total, F.lit(0)).cast("double")
