"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine >= c lie within eps = sqrt(2 - 2c) of each other, and so do their projections
on any principal directions. Vectors are sorted by (label, grid cells of width eps on the leading
principal directions) and cut into sequence blocks with bounding boxes. Pairs of sequence intervals
are refined level by level, one join a level, and pairs of boxes farther than eps apart are dropped.
Surviving pairs of blocks are joined inside a task by the same recursion on halves, down to
leaves that are compared in double precision.

Equal vectors of one label are one class with a weight, so copies cost nothing. A block pair returns
link counts for its vectors and a spanning set of its links, never all pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null
label or id, link with nothing and stand alone. Vectors of different lengths never link. Repeated
rows count as separate vectors with the same id. An empty table gives no rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgermill.llm.common import HOT_SHARE, join_hot, stage
from ledgermill.llm.components import components, spanning

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 8  # intervals that one interval splits into, a level
LEAF = 128


def usable(vector: str, label: str, vec_id: str) -> Column:
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & F.col(vec_id).isNotNull() & v.isNotNull() & ~bad & some, F.lit(False))


def unit(rows: list) -> np.ndarray:
    """Rows as unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    out = np.array(rows, np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def principal(classes: DataFrame, directions: int) -> dict[int, np.ndarray]:
    """For each vector length, the leading principal directions of all unit vectors (columns)."""

    def run(frames):
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for d, own in frame.groupby("d"):
                x = np.concatenate([np.ones((len(own), 1)), unit(own["vector"].tolist())], axis=1)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            yield pd.DataFrame({"d": d, "at": np.arange(s.size), "s": s.ravel()})

    summed = classes.select("d", "vector").mapInPandas(run, "d int, at int, s double").groupBy("d", "at").agg(F.sum("s").alias("s"))
    got: dict[int, dict[int, float]] = {}
    for r in summed.collect():  # (d + 1)^2 numbers for each length d
        got.setdefault(r["d"], {})[r["at"]] = r["s"]
    out = {}
    for d, values in got.items():
        s = np.array([values[k] for k in range((d + 1) ** 2)]).reshape(d + 1, d + 1)
        mean = s[0, 1:] / s[0, 0]
        out[d] = np.linalg.eigh(s[1:, 1:] / s[0, 0] - np.outer(mean, mean))[1][:, ::-1][:, :directions]
    return out


def gap(low_a, high_a, low_b, high_b) -> float:
    """Least distance of two boxes."""
    away = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return math.sqrt(float((away * away).sum()))


def join_blocks(a: np.ndarray, b: np.ndarray, box_a: np.ndarray, box_b: np.ndarray, eps: float, cosine: float, same: bool):
    """Yield (rows of a, rows of b) with cosine >= ``cosine``, leaf by leaf; if ``same``, a is b and pairs are i < j."""
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if same and j1 <= i0:
            continue
        x, y = box_a[i0:i1], box_b[j0:j1]
        if gap(x.min(0), x.max(0), y.min(0), y.max(0)) > eps:
            continue
        if i1 - i0 > LEAF or j1 - j0 > LEAF:
            left = [(i0, (i0 + i1) // 2), ((i0 + i1) // 2, i1)] if i1 - i0 > LEAF else [(i0, i1)]
            right = [(j0, (j0 + j1) // 2), ((j0 + j1) // 2, j1)] if j1 - j0 > LEAF else [(j0, j1)]
            todo += [(*p, *q) for p in left for q in right]
            continue
        i, j = np.nonzero(a[i0:i1] @ b[j0:j1].T >= cosine)
        i, j = i + i0, j + j0
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def _blocks(classes: DataFrame, basis: dict[int, np.ndarray], eps: float, block: int) -> DataFrame:
    """Sequence blocks: label, d, box, ids, weights, vectors."""
    depth = max((v.shape[1] for v in basis.values()), default=1)

    def cells(frames):
        for frame in frames:
            grid = np.zeros((len(frame), depth), np.int64)
            for d, at in frame.groupby("d").indices.items():
                own = unit(frame["vector"].iloc[at].tolist()) @ basis[d]
                grid[at[:, None], np.arange(own.shape[1])[None, :]] = np.floor(own / eps).astype(np.int64)
            yield frame.assign(cell=grid.tolist())

    def cut(frames):
        part = TaskContext.get().partitionId()
        seen = 0

        def close(rows: pd.DataFrame):
            nonlocal seen
            for at in range(0, len(rows), block):
                own = rows.iloc[at:at + block]
                d = int(own["d"].iloc[0])
                box = unit(own["vector"].tolist()) @ basis[d]
                seen += 1
                yield {
                    "label": own["label"].iloc[0], "d": d, "part": part, "at": seen, "low": box.min(0).tolist(), "high": box.max(0).tolist(),
                    "ids": own["id"].tolist(), "weights": own["n"].tolist(), "vectors": np.concatenate(own["vector"].to_numpy()).tolist(),
                }

        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame])
            out = []
            groups = [g for _, g in held.groupby(["label", "d"], sort=False)]
            for g in groups[:-1]:
                out += close(g)
            tail = groups[-1]
            whole = len(tail) // block * block
            out += close(tail.iloc[:whole])
            held = tail.iloc[whole:]
            if len(held) == 0:
                held = None
            if out:
                yield pd.DataFrame(out)
        if held is not None:
            yield pd.DataFrame(list(close(held)))

    kind = dict(classes.dtypes)
    placed = classes.mapInPandas(cells, f"label {kind['label']}, d int, id long, n long, vector {kind['vector']}, cell array<long>")
    ordered = placed.repartitionByRange("label", "d", "cell", "id").sortWithinPartitions("label", "d", "cell", "id")
    return ordered.mapInPandas(cut, f"label {kind['label']}, d int, part int, at int, low array<double>, high array<double>, ids array<long>, weights array<long>, vectors {kind['vector']}")


def _near_boxes(eps: float) -> Column:
    away = F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("low2", "high2"), lambda a, b: F.greatest(F.lit(0.0), a["low"] - b["high2"], b["low2"] - a["high"]))
    return F.aggregate(away, F.lit(0.0), lambda s, x: s + x * x) <= F.lit(eps * eps)


def block_pairs(meta: DataFrame, eps: float) -> DataFrame:
    """Pairs (i <= j) of blocks whose boxes come within eps, by refining pairs of sequence intervals."""
    meta = meta.withColumn("seq", F.row_number().over(Window.partitionBy("label", "d").orderBy("part", "at")) - 1)
    meta = stage(meta.select("label", "d", "block", "seq", "low", "high"), "boxes")
    most = meta.agg(F.max("seq")).first()[0]
    depth = 0
    while most is not None and FAN**depth <= most:
        depth += 1

    def least(column: str, how) -> Column:
        return F.array(*[how(F.get(column, F.lit(k))) for k in range(meta.select(F.max(F.size("low"))).first()[0] or 1)])

    low, high = least("low", F.min), least("high", F.max)

    def nodes(level: int) -> DataFrame:
        node = F.floor(F.col("seq") / FAN**level).cast("long").alias("node")
        if not level:
            return meta.select("label", "d", node, F.filter("low", lambda x: x.isNotNull()).alias("low"), F.filter("high", lambda x: x.isNotNull()).alias("high"))
        return meta.groupBy("label", "d", node).agg(F.filter(low, lambda x: x.isNotNull()).alias("low"), F.filter(high, lambda x: x.isNotNull()).alias("high"))

    pairs = nodes(depth).select("label", "d", F.col("node").alias("i"), F.col("node").alias("j"))
    for level in reversed(range(depth)):
        own = nodes(level).withColumn("up", F.floor(F.col("node") / FAN).cast("long"))
        left = own.select("label", "d", F.col("up").alias("i"), F.col("node").alias("i2"), "low", "high")
        right = own.select("label", "d", F.col("up").alias("j"), F.col("node").alias("j2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
        pairs = pairs.join(left, ["label", "d", "i"]).join(right, ["label", "d", "j"])
        pairs = stage(pairs.where(F.col("i2") <= F.col("j2")).where(_near_boxes(eps)).select("label", "d", F.col("i2").alias("i"), F.col("j2").alias("j")), "interval-pairs")
    named = meta.select("label", "d", "seq", "block")
    left = named.withColumnsRenamed({"seq": "i", "block": "a"})
    right = named.withColumnsRenamed({"seq": "j", "block": "b"})
    return pairs.join(left, ["label", "d", "i"]).join(right, ["label", "d", "j"]).select("a", "b")


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", directions: int = 8, block: int = 1024,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-7
    key = F.concat_ws(":", F.xxhash64("label", "vector"), F.xxhash64(F.lit(7), "vector", "label"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"), usable(vector, label, vec_id).alias("ok"))
    good = rows.where("ok").withColumn("key", key)
    classes = good.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = stage(classes.withColumn("d", F.size("vector")), "classes")
    basis = principal(classes, directions)
    blocks = stage(_blocks(classes.select("label", "d", "id", "n", "vector"), basis, eps, block).withColumn("block", F.concat_ws("-", "part", "at")), "blocks")
    pairs = block_pairs(blocks.select("label", "d", "block", "part", "at", "low", "high"), eps)

    def join(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                d = int(r.d)
                ids = [np.asarray(r.ids), np.asarray(r.ids2)]
                units = [unit(np.asarray(v, np.float64).reshape(-1, d)) for v in (r.vectors, r.vectors2)]
                boxes = [u @ basis[d] for u in units]
                weights = [np.asarray(r.weights), np.asarray(r.weights2)]
                same = r.a == r.b
                n = len(ids[0])
                where = np.concatenate(ids[:1] if same else ids)
                links, labels, edges = np.zeros(len(where), np.int64), np.arange(len(where)), []
                for i, j in join_blocks(*units, *boxes, eps, cosine, same):
                    at_j = j if same else j + n
                    links += np.bincount(i, weights[1][j], len(where)).astype(np.int64) + np.bincount(at_j, weights[0][i], len(where)).astype(np.int64)
                    chosen, labels = spanning(i, at_j, labels)
                    edges.append((where[i[chosen]], where[at_j[chosen]]))
                some = np.flatnonzero(links)
                if len(some):
                    yield pd.DataFrame({"a": where[some], "b": None, "n": links[some]}).astype({"b": "Int64"})
                    for x, y in edges:
                        yield pd.DataFrame({"a": x, "b": y, "n": 0})

    one = blocks.select(F.col("block").alias("a"), "d", "ids", "weights", "vectors")
    two = blocks.select(F.col("block").alias("b"), F.col("ids").alias("ids2"), F.col("weights").alias("weights2"), F.col("vectors").alias("vectors2"))
    # one pair a task row; pairs are spread evenly, whatever their label
    met = pairs.join(one, "a").join(two, "b")
    found = stage(met.mapInPandas(join, "a long, b long, n long"), "found")
    roots = components(found.where("b is not null").select("a", "b"), "a", "b")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    known = classes.select("key", "id", "n").join(counts.withColumnRenamed("a", "id"), "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    known = stage(known.select("key", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")), "classes-joined")
    total = good.count()
    linked = join_hot(good.select("id", "key"), known, "key", F.col("n") > max(1000, total * HOT_SHARE)).select("id", "n_links", "component_id")
    alone = rows.where(~F.col("ok")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
