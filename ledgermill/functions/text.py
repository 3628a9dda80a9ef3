"""Text helpers: header clean-up, markers, dates in file names, name similarity."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names accepted in file names.
MONTH_NUMBERS = {
    "January": 1, "February": 2, "March": 3, "April": 4, "May": 5, "June": 6, "July": 7,
    "August": 8, "September": 9, "October": 10, "November": 11, "December": 12,
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "Jun": 6, "Jul": 7, "Aug": 8, "Sep": 9, "Sept": 9,
    "Oct": 10, "Nov": 11, "Dec": 12,
}
FULL_MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
)


def unchanged(text: Column) -> Column:
    return text


def stripped(text: Column) -> Column:
    """Without white space of any sort at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def one_line(text: Column) -> Column:
    """Header text on one line."""
    return stripped(F.replace(text, F.lit("\n"), F.lit(" ")))


def slug(text: Column) -> Column:
    """Lower case letters, digits and underscores only."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9_]", "")


def slug_name(name: str) -> str:
    """:func:`slug` of a constant."""
    return re.sub("[^a-z0-9_]", "", name.lower())


def letters_and_digits(text: Column) -> Column:
    """Lower case ASCII letters and digits only, for substring matching of names."""
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]", ""))


def text_after_marker(text: Column, marker: str) -> Column:
    """What follows the last occurrence of ``marker``, trimmed; the whole text without one."""
    return stripped(F.substring_index(text, marker, -1))


def base_name(path: Column) -> Column:
    """File name of a path."""
    return F.substring_index(path, "/", -1)


def without_extension(name: Column) -> Column:
    """Cut at the last dot, as long as there is one."""
    return F.regexp_replace(name, r"(?s)\.[^.]*$", "")


def _lookup(names: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def month_number(token: Column) -> Column:
    """Month of a full, three letter or ``Sept`` name in any case; NULL otherwise."""
    return F.try_element_at(_lookup({m.lower(): n for m, n in MONTH_NUMBERS.items()}), F.lower(token))


def month_from_tokens(name: Column) -> Column:
    """Month start from the last two words of a file name: full month name and year."""
    words = F.split(stripped(name), r"(?U)\s+")
    full = {m.lower(): MONTH_NUMBERS[m] for m in FULL_MONTHS}
    month = F.try_element_at(_lookup(full), F.lower(F.get(words, F.size(words) - 2)))
    year = F.split_part(F.get(words, F.size(words) - 1), F.lit("."), F.lit(1))
    return F.when(
        year.rlike(r"^\d{4}$"), F.make_date(year.try_cast("int"), month, F.lit(1))
    )


# --- similarity -----------------------------------------------------------------------------
# Longest common subsequence with one bit per key character. Words hold 62 bits, so that the
# addition below cannot overflow a BIGINT; longer keys use several words with a carry.
_BITS = 62
_FULL = (1 << _BITS) - 1


def key_masks(key: Column) -> Column:
    """For every character of ``key``, the bit positions it takes, in words of 62 bits."""
    chars = F.split(key, "")
    words = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(key) / _BITS).cast("int") - 1, F.lit(0)))

    def word_mask(char: Column, word: Column) -> Column:
        part = F.slice(chars, word * _BITS + 1, F.lit(_BITS))
        bits = F.transform(
            part, lambda c, i: F.when(c == char, F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
            .otherwise(F.lit(0).cast("bigint"))
        )
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))

    entries = F.transform(
        F.array_distinct(chars),
        lambda char: F.struct(char.alias("key"), F.transform(words, lambda w: word_mask(char, w)).alias("value")),
    )
    return F.map_from_entries(entries)


def common_subsequence(text: Column, key_length: Column, masks: Column) -> Column:
    """Length of the longest common subsequence of ``text`` and the key behind ``masks``."""
    n_words = F.greatest(F.ceil(key_length / _BITS).cast("int"), F.lit(1))
    full = F.lit(_FULL)
    start = F.array_repeat(full, n_words)

    def step(state: Column, char: Column) -> Column:
        hits = F.try_element_at(masks, char)

        def word(acc: Column, i: Column) -> Column:
            s = F.get(state, i)
            u = s.bitwiseAND(F.coalesce(F.get(hits, i), F.lit(0).cast("bigint")))
            total = s + u + acc["carry"]
            return F.struct(
                F.call_function("shiftright", total, F.lit(_BITS)).alias("carry"),
                F.concat(acc["words"], F.array(total.bitwiseAND(full).bitwiseOR(s - u))).alias("words"),
            )

        return F.aggregate(
            F.sequence(F.lit(0), n_words - 1),
            F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("words")),
            word,
            lambda acc: acc["words"],
        )

    return F.aggregate(
        F.split(text, ""), start, step,
        lambda state: F.aggregate(
            state, F.lit(0),
            lambda a, w: a + F.lit(_BITS) - F.bit_count(w),
        ),
    )


def similarity(text: Column, key: Column, masks: Column) -> Column:
    """Percentage 200 * LCS / (length + length), rounded half to even; 0 for empty text."""
    total = F.length(text) + F.length(key)
    ratio = F.bround(F.lit(200.0) * common_subsequence(text, F.length(key), masks) / total, 0)
    return F.when((F.length(text) > 0) & (F.length(key) > 0), ratio.cast("int")).otherwise(F.lit(0))
