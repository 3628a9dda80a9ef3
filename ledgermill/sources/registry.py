"""Layout registry: which headers a partner's statements use.

The file maps a layout name to ``{"iso": ..., "mapping": {target: header}}``. Entries may also
hold the targets next to ``iso`` (no ``mapping``) or no targets at all. All three forms become
rows ``(layout, ordinal, iso, target, source, priority)``; an entry without targets keeps one
row with a NULL target, so that its name can still be matched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.schemas import TARGETS


def parse_registry(text: DataFrame, house_key: str = "house_residual") -> DataFrame:
    """Registry rows from JSON documents in column ``value``.

    ``house_key`` names the own-share target in the file, where it is not ``house_residual``.
    Layout order is order of appearance: it decides ties between names.
    """
    layouts = text.select(F.json_object_keys("value").alias("names"),
                          F.from_json("value", "map<string,string>").alias("entries"))
    rows = layouts.select(F.posexplode("names").alias("ordinal", "layout"), "entries").withColumn(
        "entry", F.from_json(F.try_element_at("entries", F.col("layout")), "map<string,string>")
    )
    nested = F.from_json(F.try_element_at(F.col("entry"), F.lit("mapping")), "map<string,string>")
    rows = rows.withColumn("named", F.coalesce(nested, F.col("entry")))

    def source(target: str) -> Column:
        key = house_key if target == "house_residual" else target
        return F.struct(F.lit(target).alias("target"), F.try_element_at("named", F.lit(key)).alias("source"))

    present = F.filter(F.array(*[source(t) for t in TARGETS]), lambda s: s["source"].isNotNull())
    return rows.select(
        "layout", "ordinal", F.try_element_at("entry", F.lit("iso")).alias("iso"),
        F.inline_outer(present), F.lit(0).alias("priority"),
    )


def read_registry(spark: SparkSession, path: str, house_key: str = "house_residual") -> DataFrame:
    return parse_registry(spark.read.text(path, wholetext=True), house_key)


def registry_entries(registry: DataFrame) -> DataFrame:
    """One row holding all layout names in order, for row-wise matching: configuration, one name a kind of statement."""
    names = registry.select("layout", "ordinal", "iso").distinct()
    entries = F.sort_array(F.collect_list(F.struct("ordinal", "layout", "iso")))
    return names.agg(entries.alias("entries"))
