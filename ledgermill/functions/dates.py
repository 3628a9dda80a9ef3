"""Dates as people write them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

# A time of day behind a date.
_TIME = r"[T ]+\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?: ?[AaPp]\.?[Mm]\.?)?(?:Z|[+-]\d{2}:?\d{2})?$"

# Accepted notations by shape, and which of their three parts is year, month and day. A shape has
# Y for four digits, D for one or two, B for eight, M for a month's name of three letters and L for a longer one.
_SHAPES = {
    "Y-D-D": (0, 1, 2), "Y/D/D": (0, 1, 2),
    "D/D/Y": (2, 0, 1), "D/D/D": (2, 0, 1), "D-D-Y": (2, 0, 1),
    "D-M-Y": (2, 1, 0), "D-M-D": (2, 1, 0), "D M Y": (2, 1, 0), "D L Y": (2, 1, 0),
    "M D, Y": (2, 0, 1), "L D, Y": (2, 0, 1), "M D Y": (2, 0, 1), "L D Y": (2, 0, 1),
}


def without_time(value: Column) -> Column:
    return F.regexp_replace(F.trim(value), _TIME, "")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shape(value: Column) -> Column:
    for pattern, mark in ((r"\p{L}{4,}", "_"), (r"\p{L}{3}", "M"), ("_", "L"), (r"(?<!\d)\d{8}(?!\d)", "B"), (r"(?<!\d)\d{4}(?!\d)", "Y"), (r"(?<!\d)\d{1,2}(?!\d)", "D")):
        value = F.regexp_replace(value, pattern, mark)
    return value


def _parts(value: Column, shape: Column) -> Column:
    """Year, month and day as they are written, or NULL."""
    known = F.create_map(*[F.lit(x) for s, order in _SHAPES.items() for x in (s, "".join(map(str, order)))])
    cut = lambda order: F.transform(F.split(order, ""), lambda at: F.get(F.split(value, r", |[-/ ]"), at.try_cast("int")))
    dense = F.array(F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))
    return F.when(shape == "B", dense).otherwise(_with(F.try_element_at(known, shape), cut))


def _date(parts: Column) -> Column:
    year, month = F.get(parts, F.lit(0)), F.lower(F.get(parts, F.lit(1)))
    number = year.try_cast("int")
    full = F.when(F.length(year) == 4, number).when(F.length(year) == 2, number + F.when(number >= 69, 1900).otherwise(2000))
    names = [F.array(*[F.lit(m[:size]) for m in MONTHS]) for size in (3, None)]
    named = F.when(F.length(month) == 3, F.array_position(names[0], month)).otherwise(F.array_position(names[1], month))
    nth = F.when(month.rlike(r"^\d"), month).when(named > 0, named.cast("string"))
    return F.concat(full.cast("string"), F.lit("-"), nth, F.lit("-"), F.get(parts, F.lit(2))).try_cast("date")


def day(value: Column) -> Column:
    """The date of a text without time of day; NULL if no notation fits or there is no such day.

    The text is reduced to its shape, which says where year, month and day stand, so it is taken apart once whatever the number of
    notations. Numbers are month first; two-digit years from 69 on belong to the last century.
    """
    return _with(value, lambda v: _with(_shape(v), lambda shape: _with(_parts(v, shape), _date)))
