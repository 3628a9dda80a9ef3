"""Mixing sources to target weights by Pfair scheduling.

Rows of a source form blocks of ``block_rows``. With weight w = a / period, the source's i-th block
(from 1) is released at floor((i - 1) / w) and due at ceil(i / w). In each slot the released block
with the earliest deadline goes next, so after t slots each source has had between t*w - 1 and
t*w + 1 blocks, exclusive. Windows repeat with the period, so one period is scheduled (a table of ``period`` rows)
and every block's slot follows from its number: nothing sequential touches the rows.

All rows are kept. A source that has run out leaves its slots empty; the others keep their order and weights
among themselves, and the bound holds up to the first slot that is left empty.

Defined results: rows with a null source are a source of their own. Repeated rows are numbered one
after the other, those without an id first. An empty table gives no rows. Columns of the input that are named like a result are refused by name
(``in_order`` adds none and takes any).
"""

from __future__ import annotations

import heapq
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgermill.llm.common import number_rows

RESULTS = ("block", "block_row", "slot")
#: Slots numbered at once, and counts of such spans summed at once.
SPAN, COUNTS = 64, 65536


def shares(sizes: list[float], period: int) -> list[int]:
    """Whole numbers in proportion to ``sizes``, each at least 1, summing to ``period`` (largest remainders first)."""
    if len(sizes) > period:
        raise ValueError(f"{len(sizes)} sources need a period of at least as many slots")
    total = sum(sizes)
    free = period - len(sizes)
    exact = [x / total * free for x in sizes]
    out = [1 + int(x) for x in exact]
    order = sorted(range(len(sizes)), key=lambda k: (-(exact[k] - int(exact[k])), k))
    for k in order[: period - sum(out)]:
        out[k] += 1
    return out


def picks(parts: list[int]) -> list[int]:
    """Which source gets each slot of one period, earliest deadline first; of equal deadlines the first source."""
    period = sum(parts)
    waiting = [(0, -(-period // a), k, 0) for k, a in enumerate(parts)]  # release, deadline, source, block
    ready: list[tuple[int, int, int]] = []
    heapq.heapify(waiting)
    out = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, due, k, nth = heapq.heappop(waiting)
            heapq.heappush(ready, (due, k, nth))
        _, k, nth = heapq.heappop(ready)
        out.append(k)
        if nth + 1 < parts[k]:
            a = parts[k]
            heapq.heappush(waiting, ((nth + 1) * period // a, -(-(nth + 2) * period // a), k, nth + 1))
    return out


def schedule(spark: SparkSession, parts: list[int]) -> DataFrame:
    """One period: (sid, nth, slot), the slot of each source's nth block. ``sid`` numbers the sources as in ``parts``."""
    order = F.split(F.lit(",".join(map(str, picks(parts)))), ",").cast("array<int>")
    slots = spark.range(1).select(F.posexplode(order).alias("slot", "sid"))
    return slots.select("sid", (F.row_number().over(Window.partitionBy("sid").orderBy("slot")) - 1).alias("nth"), "slot")


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source", order: str = "doc_id",
    block_rows: int = 32, period: int = 1000, temperature: float = 0.5,
) -> DataFrame:
    """``docs`` with (block, block_row, slot): the row's block in its source and the block's slot. By (slot, block_row) the rows are in mixed order.

    ``weights`` gives targets by source; sources that it leaves out get the smallest target. Without it the
    target is the source's number of rows to the power ``temperature``. ``period`` bounds the schedule table,
    which is broadcast; it is at least four slots a source. Sources are the components of a mixture: their names and counts reach the driver.
    """
    spark = docs.sparkSession
    if clash := [c for c in docs.columns if c.lower() in RESULTS]:
        raise ValueError(f"the input has columns named like results: {', '.join(clash)}")
    found = sorted(((r[0], r[1]) for r in docs.groupBy(F.col(source).cast("string")).count().collect()), key=lambda x: (x[0] is not None, x[0]))
    if not found:
        return docs.withColumns({c: F.lit(None).cast("long") for c in RESULTS})
    least = min(weights.values()) if weights else 0
    targets = [weights.get(name, least) if weights else math.pow(n, temperature) for name, n in found]
    period = max(period, 4 * len(found))
    parts = shares(targets, period)
    listed = json.dumps([{"_sid": k, "_source": name, "_share": a} for k, ((name, _), a) in enumerate(zip(found, parts))])
    sources = spark.range(1).select(F.inline(F.from_json(F.lit(listed), "array<struct<_sid:int,_source:string,_share:int>>")))
    keyed = docs.join(F.broadcast(sources), F.col(source).cast("string").eqNullSafe(F.col("_source"))).drop("_source")
    numbered = number_rows(keyed, "_sid", [F.col(order)], "_nth_row", sum(n for _, n in found))
    numbered = numbered.withColumns({
        "block": F.expr(f"_nth_row div {block_rows}"), "block_row": F.col("_nth_row") % block_rows,
    }).withColumns({"_round": F.expr("block div _share"), "_nth": (F.col("block") % F.col("_share")).cast("int")})
    plan = F.broadcast(schedule(spark, parts).toDF("_k", "_n", "_slot"))
    mixed = numbered.join(plan, (F.col("_sid") == F.col("_k")) & (F.col("_nth") == F.col("_n")))
    return mixed.withColumn("slot", F.col("_round") * period + F.col("_slot")).select(*docs.columns, *RESULTS)


def lay_out(mixed: DataFrame, slot: str = "slot", block_row: str = "block_row") -> DataFrame:
    """Rows in mixed order over range partitions: written, they give files to read one after the other."""
    return mixed.repartitionByRange(slot, block_row).sortWithinPartitions(slot, block_row)


def in_order(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, same columns, laid out in mixed order."""
    mixed = mix(docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns}), source="_own_source", order="_own_doc_id", **how)
    return lay_out(mixed).select(*[F.col(f"_own_{c}").alias(c) for c in docs.columns])


def positions(mixed: DataFrame) -> DataFrame:
    """``mixed`` (a stored table, as it is read twice) with ``position``: the row's place, from 0, in the mix.

    Places are numbered within ``SPAN`` slots at a time; their first numbers come from running sums of counts at two
    levels, so neither a row nor a count meets a window over all slots.
    """
    if clash := [c for c in mixed.columns if c.lower() == "position"]:
        raise ValueError(f"the input has columns named like results: {', '.join(clash)}")

    def earlier(n: str, *by: str, order: str) -> Column:
        rows = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(rows), F.lit(0)).cast("long")

    near = mixed.groupBy(F.expr(f"slot div {SPAN}").alias("_near")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_far", F.expr(f"_near div {COUNTS}"))
    far = near.groupBy("_far").agg(F.sum("_n").alias("_sum")).select("_far", earlier("_sum", order="_far").alias("_before"))  # one row in four million slots
    starts = near.select("_near", "_far", earlier("_n", "_far", order="_near").alias("_start")).join(far, "_far")
    starts = starts.select("_near", (F.col("_start") + F.col("_before")).alias("_start"))
    inside = Window.partitionBy("_near").orderBy("slot", "block_row")
    placed = mixed.withColumn("_near", F.expr(f"slot div {SPAN}")).withColumn("_row", F.row_number().over(inside) - 1).join(starts, "_near")
    return placed.select(*mixed.columns, (F.col("_start") + F.col("_row")).alias("position"))


def deviations(mixed: DataFrame, source: str = "source") -> DataFrame:
    """For reports and tests: blocks of each source up to each of its slots."""
    blocks = mixed.groupBy(source, "slot").agg(F.count(F.lit(1)).alias("rows"))
    return blocks.withColumn("blocks", F.row_number().over(Window.partitionBy(source).orderBy("slot")))
