"""Which partner, month and layout a file name stands for."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import text
from ledgermill.sources.registry import registry_entries

# File name pattern (name, month word, four digit year, optional tail) and the
# least similarity, in percent, at which a name stands for a layout.
NAME_PATTERN = r"(?U)^(.*?)(?:[_\s]+)?([A-Za-z]+)[_\s]?(\d{4})(?:\s.*)?$"
SIMILARITY_THRESHOLD = 80

_SEPARATOR = "\x1f"

ERROR_FORMAT, ERROR_NO_MATCH, ERROR_MONTH = "filename_format", "no_matching_layout", "invalid_month"
ERROR_NO_MAPPING = "no_mapping"


class Rule(NamedTuple):
    """Dispatch rule: a partner name that equals, or contains, ``pattern`` uses ``family``."""

    kind: str
    pattern: str
    family: str


def dispatch(iso: Column, rules: Iterable[Rule], default: str = "generic") -> Column:
    """Layout family of a partner: first matching rule, else ``default``."""
    out = F
    for rule in rules:
        if rule.kind not in ("equals", "contains"):
            raise ValueError(f"unknown rule kind {rule.kind!r}")
        hit = iso == rule.pattern if rule.kind == "equals" else F.contains(iso, F.lit(rule.pattern))
        out = out.when(hit, rule.family)
    return F.lit(default) if out is F else out.otherwise(default)


def split_names(files: DataFrame) -> DataFrame:
    """``path`` -> name part, month word and year; all empty when the format is wrong."""
    stem = text.stripped(text.without_extension(text.base_name(F.col("path"))))
    parts = files.withColumn("_stem", stem)
    # one match per name: the three groups, put between separators
    marked = F.regexp_replace("_stem", NAME_PATTERN, f"$1{_SEPARATOR}$2{_SEPARATOR}$3")
    found = parts.withColumn("_found", F.split(marked, _SEPARATOR))

    def part(i: int) -> Column:
        return F.when(F.size("_found") == 3, F.get("_found", F.lit(i))).otherwise("")

    name = text.stripped(F.regexp_replace(part(0), r"(?U)\s+", " "))
    return found.withColumns({"name": name, "month_word": part(1), "year": part(2)}).drop("_stem", "_found")


def match_names(names: DataFrame, registry: DataFrame, threshold: int = SIMILARITY_THRESHOLD) -> DataFrame:
    """Best layout per distinct ``name``: highest similarity, then registry order.

    The registry is configuration; it reaches every row as one constant array, so no pair of
    name and layout ever becomes a row.
    """
    entries = registry_entries(registry).select(
        F.transform(
            "entries",
            lambda e: F.struct(
                e["ordinal"].alias("ordinal"), e["layout"].alias("layout"), e["iso"].alias("iso"),
                F.lower(e["layout"]).alias("key"), text.key_masks(F.lower(e["layout"])).alias("masks"),
            ),
        ).alias("entries")
    )
    scored = names.select("name").distinct().withColumn("entries", entries.scalar()).withColumn(
        "best",
        F.array_max(F.transform(
            "entries",
            lambda e: F.struct(
                text.similarity(F.lower("name"), e["key"], e["masks"]).alias("similarity"),
                (-e["ordinal"]).alias("rank"), e["layout"].alias("layout"), e["iso"].alias("iso"),
            ),
        )),
    )
    hit = F.col("best.similarity") >= threshold
    return scored.select(
        "name", F.col("best.similarity").alias("similarity"),
        F.when(hit, F.col("best.layout")).alias("layout"), F.when(hit, F.col("best.iso")).alias("iso"),
    )


def match_substring(files: DataFrame, registry: DataFrame) -> DataFrame:
    """First layout, in registry order, whose bare name occurs in the bare file name."""
    entries = registry_entries(registry).select(
        F.transform(
            "entries",
            lambda e: F.struct(e["layout"].alias("layout"), e["iso"].alias("iso"),
                               text.letters_and_digits(e["layout"]).alias("key")),
        ).alias("entries")
    )
    bare = text.letters_and_digits(text.without_extension(text.base_name(F.col("path"))))
    # the array of one evaluates the bare name once per file instead of once per layout
    hits = F.transform(
        F.array(bare),
        lambda name: F.get(F.filter("entries", lambda e: F.contains(name, e["key"])), F.lit(0)),
    )
    return (
        files.withColumn("entries", entries.scalar()).withColumn("hit", F.get(hits, F.lit(0)))
        .withColumns({"layout": F.col("hit.layout"), "iso": F.col("hit.iso")})
        .drop("entries", "hit")
    )


def identify(
    files: DataFrame, registry: DataFrame, rules: Iterable[Rule] = (),
    threshold: int = SIMILARITY_THRESHOLD, generic_by: str = "substring",
) -> DataFrame:
    """``files`` plus ``iso, date, layout, family, error``; an unusable name sets ``error``.

    Similarity is computed once per distinct name part. Partners send one file per month, so
    there are few of those compared with files. The partner always comes from the best similar
    name. Statements of the generic family take their headers from the layout whose name occurs
    in the file name (``generic_by="substring"``) or from the similar one (``"similarity"``).
    """
    if generic_by not in ("substring", "similarity"):
        raise ValueError("generic_by must be 'substring' or 'similarity'")
    parts = split_names(files)
    matched = match_names(parts, registry, threshold)
    rows = parts.join(matched, "name", "left")
    month = text.month_number(F.col("month_word"))
    error = (
        F.when(F.col("month_word") == "", ERROR_FORMAT)
        .when(F.col("layout").isNull(), ERROR_NO_MATCH).when(month.isNull(), ERROR_MONTH)
    )
    year = F.col("year").try_cast("int")
    rows = rows.withColumns({
        "error": error,
        "date": F.when(error.isNull(), F.make_date(year, month, F.lit(1))),
        "family": F.when(error.isNull(), dispatch(F.col("iso"), rules)),
    })
    if generic_by == "substring":
        generic = F.col("family") == "generic"
        rows = match_substring(
            rows.withColumnsRenamed({"layout": "_layout", "iso": "_iso"}), registry
        ).withColumns({
            "error": F.when(generic & F.col("layout").isNull(), ERROR_NO_MAPPING).otherwise(F.col("error")),
            "layout": F.when(generic, F.col("layout")).otherwise(F.col("_layout")),
            "iso": F.col("_iso"),
        })
    return rows.select(*files.columns, "iso", "date", "layout", "family", "error")


def attach_identity(grid: DataFrame, statements: DataFrame) -> DataFrame:
    """Grid rows of the usable statements, with their identity."""
    known = statements.filter("error IS NULL").select("path", "iso", "date", "layout", "family")
    return grid.join(known, "path")
