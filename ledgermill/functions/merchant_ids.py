"""Which cells are merchant ids. A cell is a struct of ``value`` and ``kind``.

Kinds: ``s`` text, ``n`` number, ``d`` date, ``b`` boolean, ``f`` formula without a cached
value, ``e`` error. Whether an id was stored as text or as a number decides if some layouts
accept it. Each function returns the canonical id, or NULL where the cell is no id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.numbers import integral_text, to_number

DIGITS = r"^[0-9]+$"


def _is(cell: Column, kind: str) -> Column:
    return cell["kind"] == kind


def _undashed_digits(value: Column) -> Column:
    return F.replace(value, F.lit("-"), F.lit("")).rlike(DIGITS)


def canonical(cell: Column) -> Column:
    """Text as it stands; whole numbers without point or exponent."""
    value = cell["value"]
    number = to_number(value)
    whole = _is(cell, "n") & (number == F.floor(number))
    return F.when(whole, F.coalesce(integral_text(value), value)).otherwise(value)


def dash(cell: Column) -> Column:
    """Any number, or text of digits and dashes."""
    return F.when(_is(cell, "n") | _undashed_digits(cell["value"]), canonical(cell))


def dash_text(cell: Column) -> Column:
    """Digits and dashes, whatever the kind; a literal ``.0`` is dropped from the id."""
    value = canonical(cell)
    return F.when(_undashed_digits(value), strip_point_zero(value))


def numeric(cell: Column) -> Column:
    """Anything that reads as a number, cut to its whole part."""
    return integral_text(cell["value"])


def integral_kind(cell: Column) -> Column:
    """Stored as a number without fraction; digit text is refused."""
    number = to_number(cell["value"])
    return F.when(_is(cell, "n") & (number == F.floor(number)), integral_text(cell["value"]))


def digit_string(cell: Column) -> Column:
    """Stored as text of digits only; numbers are refused."""
    return F.when(_is(cell, "s") & cell["value"].rlike(DIGITS), cell["value"])


def int_or_digits(cell: Column) -> Column:
    """A whole number, or text of digits only."""
    return F.coalesce(integral_kind(cell), digit_string(cell))


def present(cell: Column) -> Column:
    """Any non-empty cell."""
    return canonical(cell)


def strip_point_zero(text: Column) -> Column:
    return F.replace(text, F.lit(".0"), F.lit(""))
