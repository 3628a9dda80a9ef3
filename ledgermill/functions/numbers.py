"""Money and number conversions, Column -> Column.

Statements disagree on how money is written, so there is one rule per convention. Rules that a
single line needs return DOUBLE; what is summed per group goes through :func:`exact` first so
that the sum does not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cast alone would accept '1d' or 'Infinity'.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Splits a double into two halves of its digits, whose products with 100 are exact.
_SPLIT = float((1 << 27) + 1)


def to_number(text: Column) -> Column:
    """DOUBLE of a plain decimal number, NULL for anything else."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def exact(number: Column) -> Column:
    """DECIMAL form of a parsed amount, so that sums are order-independent."""
    return number.try_cast("decimal(30,6)")


def cents(number: Column) -> Column:
    """Nearest cent of the exact binary value, true ties to even.

    ``number * 100`` can round onto a half that the value does not have (2.675 is a little less
    than it looks). The error of that product is exact in doubles and decides such cases.
    """
    scaled = number * 100
    wide = number * _SPLIT
    high = wide - (wide - number)
    error = (high * 100 - scaled) + (number - high) * 100
    lower = F.floor(scaled).cast("double")
    nearest = F.when((scaled - lower == 0.5) & (error != 0), F.when(error > 0, lower + 1).otherwise(lower))
    return nearest.otherwise(F.rint(scaled)) / 100


def without(text: Column, *symbols: str) -> Column:
    for symbol in symbols:
        text = F.replace(text, F.lit(symbol), F.lit(""))
    return text


def plain(text: Column) -> Column:
    """The number as it stands."""
    return to_number(text)


def money_ceil(text: Column) -> Column:
    """Rounded up to the cent on binary doubles (0.07 gives 0.08); unreadable text gives 0.

    Accounting negatives such as ``(12.30)`` are unreadable here.
    """
    number = to_number(without(text, "$", ","))
    return F.coalesce(F.ceil(number * 100) / F.lit(100.0), F.lit(0.0))


def money_paren(text: Column) -> Column:
    """Text holding both parentheses is negative; NULL marks unreadable text."""
    negative = F.contains(text, F.lit("(")) & F.contains(text, F.lit(")"))
    bare = to_number(without(text, "$", ","))
    return F.when(negative, -to_number(without(text, "(", ")", "$", ","))).otherwise(bare)


def money_paren_plain(text: Column) -> Column:
    """Enclosed in parentheses means negative; no other symbol is removed; cents."""
    enclosed = text.startswith("(") & text.endswith(")")
    inner = F.regexp_replace(text, r"^[()]+|[()]+$", "")
    return cents(F.when(enclosed, -to_number(inner)).otherwise(to_number(text)))


def money_lenient(text: Column) -> Column:
    """Cents; empty, unreadable and formula text count as 0."""
    return F.coalesce(F.when(~F.startswith(text, F.lit("=")), cents(to_number(text))), F.lit(0.0))


def money_strict(text: Column) -> Column:
    """Without ``$`` and ``,``; NULL marks text that must reject the statement."""
    return to_number(without(text, "$", ","))


def money_coerce(text: Column) -> Column:
    """Without ``$`` and ``,``; unreadable text is left out of sums."""
    return to_number(without(text, "$", ","))


def integral_text(text: Column) -> Column:
    """Whole part of a number as digits: no point, no exponent, no leading zeros."""
    number = F.when(F.trim(text).rlike(NUMBER), F.trim(text).try_cast("decimal(38,9)"))
    return number.try_cast("bigint").cast("string")
