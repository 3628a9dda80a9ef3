"""Resharding by a minimum-cost flow.

Rows of an old shard stand in a fixed order: by size class (only rows that are large against a new
shard come first), then by a hash of the text, so that equal texts are neighbours. They form
blocks of bounded size; a block too large (a hot text) is split by id. Running sums over block sizes, then
within a block, give each row its byte range in the old shard.

The flow from old sizes to new capacities moves the fewest bytes (or the least cost, given a cost table); its amounts cut the old
shard's byte range into intervals, one for each target, the one that stays first. A row goes where the middle of its range lies, so
a shard misses its capacity by half a row for each interval at most. Old shards give rows to new ones or take some, so
all of them are affected: ``write_shards`` writes each new shard with whole rows, those that stay included.

The flow's graph has shards as nodes; rows and blocks never leave the executors.

Defined results: a null text has one byte of size (the closing one) and the checksum of no bytes, and
moves as an empty one. Repeated rows are placed one by one. An empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ledgermill.llm.common import HOT_SHARE, new_folder

CLASS_SHARE = 256  # rows above a new shard's size over this are ordered by size


def least_cost_flow(supply: Sequence[int], demand: Sequence[int], cost: Sequence[Sequence[int]] | None = None) -> dict[tuple[int, int], int]:
    """Amounts (from, to) that take ``supply`` to ``demand`` at least cost, by successive shortest paths.

    Without ``cost`` staying (from == to) is free and any move costs one a unit: then all moves pass
    one hub, and the graph has as many edges as shards.
    """
    if sum(supply) != sum(demand):
        raise ValueError("capacities must sum to the bytes there are")
    s_n, t_n = len(supply), len(demand)
    source, sink, hub = s_n + t_n, s_n + t_n + 1, s_n + t_n + 2
    edges: list[list] = []  # to, capacity, cost; the reverse edge follows
    at: list[list[int]] = [[] for _ in range(s_n + t_n + 3)]

    def add(u: int, v: int, room: int, price: int) -> int:
        at[u].append(len(edges))
        edges.append([v, room, price])
        at[v].append(len(edges))
        edges.append([u, 0, -price])
        return len(edges) - 2

    for i, x in enumerate(supply):
        add(source, i, x, 0)
    for j, x in enumerate(demand):
        add(s_n + j, sink, x, 0)
    whole = sum(supply)
    arcs: dict[tuple[int, int], int] = {}
    if cost is None:
        arcs |= {(i, i): add(i, s_n + i, whole, 0) for i in range(min(s_n, t_n))}
        out = [add(i, hub, whole, 1) for i in range(s_n)]
        into = [add(hub, s_n + j, whole, 0) for j in range(t_n)]
    else:
        arcs |= {(i, j): add(i, s_n + j, whole, cost[i][j]) for i in range(s_n) for j in range(t_n)}
    while True:
        price = [float("inf")] * len(at)
        price[source], via, queue, waiting = 0, [-1] * len(at), deque([source]), {source}
        while queue:
            u = queue.popleft()
            waiting.discard(u)
            for e in at[u]:
                v, room, c = edges[e]
                if room and price[u] + c < price[v]:
                    price[v], via[v] = price[u] + c, e
                    if v not in waiting:
                        waiting.add(v)
                        queue.append(v)
        if via[sink] < 0:
            break
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = edges[via[v] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    flow = {k: edges[e ^ 1][1] for k, e in arcs.items()}
    if cost is None:  # pair what enters the hub with what leaves it
        gives = [[i, edges[e ^ 1][1]] for i, e in enumerate(out)]
        takes = [[j, edges[e ^ 1][1]] for j, e in enumerate(into)]
        while gives and takes:
            (i, x), (j, y) = gives[0], takes[0]
            if x and y:
                flow[i, j] = flow.get((i, j), 0) + min(x, y)
            gives[0][1] -= min(x, y)
            takes[0][1] -= min(x, y)
            if not gives[0][1]:
                gives.pop(0)
            elif not takes[0][1]:
                takes.pop(0)
    return {k: v for k, v in flow.items() if v}


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def place(
    rows: DataFrame, old: Column, old_shards: int, new_shards: int, id_column: str = "doc_id", text: str = "text",
    block_bytes: int = 8 << 20, cost: Sequence[Sequence[int]] | None = None,
) -> DataFrame:
    """``rows`` with (size, old_shard, shard, slot, moved, and the block's columns _class, _bucket, _sub).

    ``old`` is the present shard, 0 to ``old_shards`` - 1.
    """
    size = (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long")
    base = rows.withColumns({"size": size, "old_shard": old.cast("int"), "_hash": F.xxhash64(text)})
    total = base.agg(F.sum("size")).first()[0] or 0
    capacities = equal_capacities(total, new_shards)
    unit = max(1, total // new_shards // CLASS_SHARE)
    # log2 from the length of the binary form: exact
    base = base.withColumn("_class", F.length(F.bin(F.expr(f"size div {unit}"))).cast("int"))
    per = {(r[0], r[1]): r[2] for r in base.groupBy("old_shard", "_class").agg(F.sum("size")).collect()}  # shards x size classes
    supply = [sum(v for (o, _), v in per.items() if o == s) for s in range(old_shards)]
    flow = least_cost_flow(supply, capacities, cost)
    top = max((c for _, c in per), default=0)
    buckets = F.array(*[F.array(*[F.lit(max(1, -(-per.get((s, c), 0) // block_bytes))) for c in range(top + 1)]) for s in range(old_shards)])
    base = base.withColumn("_bucket", F.pmod("_hash", F.get(F.get(buckets, F.col("old_shard")), F.col("_class"))))
    # few buckets hold this much: fewer than 1 / HOT_SHARE
    hot = base.groupBy("old_shard", "_class", "_bucket").agg(F.sum("size").alias("_b")).where(F.col("_b") > max(4 * block_bytes, total * HOT_SHARE))
    hot = hot.select("old_shard", "_class", "_bucket", F.ceil(F.col("_b") / block_bytes).alias("_subs"))
    base = base.join(F.broadcast(hot), ["old_shard", "_class", "_bucket"], "left")
    base = base.withColumn("_sub", F.pmod(F.xxhash64(id_column), F.coalesce("_subs", F.lit(1))).cast("int")).drop("_subs")
    block = ["old_shard", "_class", "_bucket", "_sub"]
    sums = base.groupBy(*block).agg(F.sum("size").alias("_bytes"))
    before = Window.partitionBy("old_shard").orderBy(F.desc("_class"), "_bucket", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*block, F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_from"))
    ordered = Window.partitionBy(*block).orderBy("_hash", id_column)
    inside = base.withColumn("_upto", F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_nth", F.row_number().over(ordered))
    placed = inside.join(starts, block).withColumn("_middle", 2 * (F.col("_from") + F.col("_upto")) - F.col("size"))
    edges, targets = [], []
    for s in range(old_shards):
        own = sorted(((t, v) for (o, t), v in flow.items() if o == s), key=lambda x: (x[0] != s, x[0]))
        ends, upto = [], 0
        for _, v in own:
            upto += v
            ends.append(2 * upto)
        edges.append(F.array(*[F.lit(e).cast("long") for e in ends[:-1]]).cast("array<long>"))
        targets.append(F.array(*[F.lit(t) for t, _ in own]) if own else F.array(F.lit(s)))
    cuts, goes = F.get(F.array(*edges), F.col("old_shard")), F.get(F.array(*targets), F.col("old_shard"))
    placed = placed.withColumn("shard", F.get(goes, F.size(F.filter(cuts, lambda e: e <= F.col("_middle")))))
    part = Window.partitionBy(*block, "shard")
    placed = placed.withColumn("_own", F.col("_nth") - F.min("_nth").over(part))
    counts = placed.groupBy(*block, "shard").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("old_shard", F.desc("_class"), "_bucket", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*block, "shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    # one row a block (a few shards each): the join keeps the rows where the windows have put them
    offsets = offsets.groupBy(*block).agg(F.map_from_entries(F.collect_list(F.struct("shard", "_offset"))).alias("_offset"))
    placed = placed.join(offsets, block).withColumn("slot", (F.col("_offset")[F.col("shard")] + F.col("_own")).cast("long"))
    return placed.withColumn("moved", F.col("shard") != F.col("old_shard")).drop("_from", "_upto", "_nth", "_middle", "_own", "_offset", "_hash")


def rewrite(placed: DataFrame, payload: Sequence[str], folder: str | None = None) -> str:
    """Write the moves only, no layout that stands alone: below ``moved=true/shard=N`` whole rows that changed shards,
    below ``moved=false/shard=N`` the place of the others without ``payload``, for a caller who keeps the old files.
    Returns the folder."""
    folder = folder or new_folder(placed.sparkSession, "shards")
    kept = {c: F.when(F.col("moved"), F.col(c)) for c in payload}
    placed.withColumns(kept).write.partitionBy("moved", "shard").parquet(folder)
    return folder


def write_shards(placed: DataFrame, folder: str | None = None) -> str:
    """Write the new layout: below ``shard=N`` all rows of shard N, whole. Returns the folder."""
    folder = folder or new_folder(placed.sparkSession, "shards")
    placed.write.partitionBy("shard").parquet(folder)
    return folder


def layout(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What ``write_shards`` (or ``rewrite``) left in ``folder``; ``schema`` is that of the rows it was given."""
    return spark.read.schema(schema).parquet(folder)
