"""Learned decision lists over document statistics.

Statistics of whole texts are array and string expressions. Sequential covering then grows one
conjunction of thresholds after the other on two thirds of the labelled statistics, prunes it on the
last third and takes the covered rows away. What is learned becomes one ordered ``CASE``.

Only DataFrame functions run on the executors; the driver sees counts per statistic and bin.

Defined results: a null or blank text has no words (all statistics zero, base fails). Repeated rows
are judged like any other. Labels with null quality or for unknown documents teach nothing; without a
usable label (or an empty table) the list is empty and only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import BLANKS, id_crc, stage

SYMBOLS = "#*$%&|<>"
SHARES = (0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0)
#: Statistic -> thresholds that a condition may use.
GRID = {
    "symbol_share": SHARES,
    "upper_share": SHARES,
    "dup_line_share": SHARES,
    "repeat_share": SHARES,
    "mean_word": tuple(x / 2 for x in range(2, 31)),
    "n_words": (1, 5, 10, 20, 35, 50, 75, 100, 150, 200, 300, 500, 1000, 2000, 5000, 10000),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


@dataclass(frozen=True)
class Condition:
    stat: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value, edge = F.col(self.stat), F.lit(float(self.threshold))
        return value >= edge if self.at_least else value < edge

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _window_hashes(words: Column) -> Column:
    """A hash for each three-word window; null for fewer than two windows.

    Windows are compared by a 64-bit hash; two different windows of one text collide with a chance
    below 2^-24 even in a text of a million words.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) >= 4, windows)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with COUNTS of the whole text (see the module for nulls)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        *[c for c in docs.columns if c != text],
        F.split(_blank_trim(whole), f"[{BLANKS}]+").alias("_w"),
        whole.alias("_t"),
        F.split(whole, "\n").alias("_l"),
    )
    base = base.withColumn("_w", F.when(F.get("_w", F.lit(0)) != "", F.col("_w")).otherwise(F.array().cast("array<string>")))
    base = base.withColumn("_l", F.filter("_l", lambda line: _blank_trim(line) != ""))
    base = base.withColumn("_h", _window_hashes(F.col("_w")))
    base = base.withColumn("_some", F.size(F.array_distinct("_h")) < F.size("_h"))
    packed = F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    base = base.withColumn("_s", F.when(F.col("_some"), F.sort_array(packed)))
    twice = F.filter(
        "_s",
        lambda x, k: (x["h"] == F.get(F.col("_s"), k - 1)["h"]) | F.coalesce(x["h"] == F.get(F.col("_s"), k + 1)["h"], F.lit(False)),
    )
    base = base.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "_p", F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda s, p: F.struct(p.alias("at"), (s["n"] + F.least(F.lit(3), p - s["at"])).alias("n")),
        lambda s: s["n"],
    )
    t = F.col("_t")
    out = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.concat_ws("", "_w")),
        "n_symbols": F.length(t) - F.length(F.regexp_replace(t, f"[{SYMBOLS}]", "")),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("_l"),
        "n_upper": F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", "")),
    }
    kept = [c for c in docs.columns if c != text and c not in out]
    return base.select(*kept, *[v.cast("long").alias(k) for k, v in out.items()])


def _blank_trim(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def with_shares(stats: DataFrame) -> DataFrame:
    """Counts as comparable statistics; divisions by zero count as by one."""
    one = lambda name: F.greatest(F.col(name), F.lit(1))
    return stats.withColumns({
        "symbol_share": F.col("n_symbols") / one("word_chars"), "upper_share": F.col("n_upper") / one("word_chars"),
        "dup_line_share": F.col("n_dup_lines") / one("n_lines"),
        "repeat_share": F.col("n_repeat_words") / one("n_words"), "mean_word": F.col("word_chars") / one("n_words"),
    })


def _and(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns, F.lit(True))


def learn(
    labelled: DataFrame, bad: str = "bad", id_column: str = "doc_id", grid: dict[str, Sequence[float]] | None = None, max_rules: int = 8,
    max_conditions: int = 3, min_cover: int = 5, min_precision: float = 0.95,
) -> list[Rule]:
    """Ordered rules that reject, from rows with statistics and a 0/1 column ``bad``.

    Grown on ids whose crc32 mod 3 is 0 or 1, pruned on the rest. A rule stays if, on both parts, at
    least ``min_precision`` of what it covers is bad. Every step is one aggregation over all labelled rows.
    """
    grid = grid or GRID
    names = list(grid)
    bins = [
        reduce(lambda a, b: a + b, [F.when(F.col(name) >= float(t), 1).otherwise(0) for t in grid[name]], F.lit(0)).alias(name) for name in names
    ]
    rows = stage(
        labelled.where(F.col(bad).isNotNull()).select(
            F.array(*bins).alias("_bins"), F.col(bad).cast("long").alias("_bad"), (id_crc(id_column) % 3 == 2).alias("_prune"),
        ).groupBy("_bins", "_bad", "_prune").agg(F.count(F.lit(1)).alias("_n")),
        "labelled-bins",
    )

    def holds(rule: Rule) -> Column:
        parts = []
        for c in rule:
            level = F.get(F.col("_bins"), F.lit(names.index(c.stat)))
            edge = list(grid[c.stat]).index(c.threshold) + 1
            parts.append(level >= edge if c.at_least else level < edge)
        return _and(parts)

    def counts(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[int, int]]:
        sums = [F.coalesce(F.sum(F.when(holds(r) & (F.col("_bad") == v), F.col("_n"))), F.lit(0)) for r in rules for v in (1, 0)]
        got = df.agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first()
        return list(zip(got[0::2], got[1::2]))

    learned: list[Rule] = []
    left = rows
    while len(learned) < max_rules:
        grow = left.where(~F.col("_prune"))
        rule = _grow(grow, names, grid, holds, max_conditions, min_cover)
        if not rule:
            break
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        pruned = counts(left.where(F.col("_prune")), prefixes)
        worth = [((p - n) / (p + n) if p + n else -1.0, -k) for k, (p, n) in enumerate(pruned)]
        best = max(range(len(prefixes)), key=lambda k: worth[k])
        rule = prefixes[best]
        (p, n), (grown_p, grown_n) = pruned[best], counts(grow, [rule])[0]
        if p + n == 0 or min(p / (p + n), grown_p / max(1, grown_p + grown_n)) < min_precision:
            break
        learned.append(rule)
        left = left.where(~holds(rule))
    return learned


def _grow(grow: DataFrame, names: list[str], grid: dict, holds, max_conditions: int, min_cover: int) -> Rule:
    """Add the condition of the largest information gain until no good row is covered."""
    import math

    rule: Rule = ()
    while len(rule) < max_conditions:
        seen = grow.where(holds(rule)).select(F.posexplode("_bins").alias("stat", "level"), "_bad", "_n")
        got = seen.groupBy("stat", "level").agg(
            F.sum(F.col("_bad") * F.col("_n")).alias("p"), F.sum((1 - F.col("_bad")) * F.col("_n")).alias("n")
        ).collect()
        table = [[[0, 0] for _ in range(len(grid[name]) + 1)] for name in names]
        for r in got:
            table[r["stat"]][r["level"]] = [r["p"], r["n"]]
        all_p, all_n = (sum(level[k] for level in table[0]) for k in (0, 1))
        if not all_p or (rule and not all_n):
            break
        before, best = math.log2(all_p / (all_p + all_n)), (1e-9, None)
        for s, name in enumerate(names):
            for k, threshold in enumerate(grid[name]):
                for at_least in (True, False):
                    side = table[s][k + 1:] if at_least else table[s][: k + 1]
                    p, n = sum(x[0] for x in side), sum(x[1] for x in side)
                    if p < min_cover or p + n == all_p + all_n:
                        continue
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > best[0]:
                        best = (gain, Condition(name, at_least, threshold))
        if best[1] is None:
            break
        rule += (best[1],)
    return rule


def verdict(rules: Sequence[Rule]) -> Column:
    """The decision list: text of the first rule that rejects, else null."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(_and([c.column() for c in rule]), F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def _learn_from(stats: DataFrame, labels: DataFrame, id_column: str) -> list[Rule]:
    taught = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias(id_column)).agg(F.min("quality").alias("quality"))
    return learn(stats.join(taught, id_column).withColumn("bad", 1 - F.col("quality")), id_column=id_column)


def _base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Each document's id, statistics, ``base_failed``, ``rule`` (null: none) and ``kept``."""
    stats = stage(with_shares(statistics(docs.select("doc_id", "text"))), "statistics")
    rules = _learn_from(stats, labels, "doc_id")
    out = stats.withColumn("base_failed", _base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list let pass, same columns."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_body"))
    stats = stage(with_shares(statistics(packed, "_body")), "statistics")  # rows and statistics, worked out once
    rules = _learn_from(stats.drop("_row"), labels, "_id")
    return stats.where(~_base_failed() & verdict(rules).isNull()).select("_row.*")
