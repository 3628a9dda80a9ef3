"""Quality from compressed sizes.

One zstandard dictionary is built from good, one from bad labelled texts. A whole text is compressed in
pieces with either dictionary; the difference of the two sizes over their sum says which class its
strings belong to, and a rising curve fitted on labelled texts outside the dictionaries makes it a probability: steps by isotonic
regression, joined by straight lines. Its rows are weighed so that the classes have the shares that they have among all labels
that may teach, so among texts of score p about a share p is good.
Pieces keep the difference meaningful in long texts, where one stream would learn the text itself.

Defined results: a null text counts as empty; without any piece the difference is 0 and the score that of an even text. Labels
other than 0 and 1 teach nothing; if either class has none, every score is the share of good labels
(one half without labels). Repeated rows are scored alike.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 512


@dataclass(frozen=True)
class Model:
    """Dictionaries (bad, good), the curve's points (differences rising, scores rising) and the compression level."""

    dictionaries: tuple[bytes, bytes]
    curve: tuple[np.ndarray, np.ndarray]
    level: int


class Scorer:
    def __init__(self, dictionaries: tuple[bytes, bytes], level: int):
        self.sides = []
        for d in dictionaries:
            side = zstandard.ZstdCompressionDict(d)
            side.precompute_compress(level)
            self.sides.append(zstandard.ZstdCompressor(dict_data=side, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: bytes) -> float:
        """(size by the bad dictionary - size by the good one) / their sum, over all pieces."""
        bad = good = 0
        for at in range(0, len(text), PIECE):
            piece = text[at:at + PIECE]
            bad += len(self.sides[0].compress(piece))
            good += len(self.sides[1].compress(piece))
        return (bad - good) / (bad + good) if bad + good else 0.0


def dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or with too few texts for that, the texts themselves."""
    pieces = [t[at:at + PIECE] for t in texts for at in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, least: float = 20.0) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising curve that fits ``y`` best. Rows in order of ``x`` form pools of ``least`` rows (rows of equal ``x`` share one); neighbours whose
    shares do not rise are pooled. Half a row of either class is added to a pool, so no score is 0 or 1."""
    values, at = np.unique(x, return_inverse=True)
    sums = np.stack([np.bincount(at, v, len(values)) for v in (x * weight, y * weight, weight, np.ones(len(x)))], axis=1)
    rows = np.cumsum(sums[:, 3])
    bins = np.unique((rows - sums[:, 3]) // least, return_index=True)[1]
    pools: list[np.ndarray] = []

    def share(p: np.ndarray) -> float:
        return (p[1] + 0.5) / (p[2] + 1.0)

    for new in np.add.reduceat(sums, bins, axis=0):
        pools.append(new)
        while len(pools) > 1 and share(pools[-2]) >= share(pools[-1]):
            last = pools.pop()
            pools[-1] = pools[-1] + last
    return np.array([p[0] / p[2] for p in pools]), np.array([share(p) for p in pools])


def probability(x: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Scores on the curve; beyond its ends they go on, ever more slowly, so that a greater difference never scores less."""
    points, shares = curve
    inside = np.interp(x, points, shares)
    span = max(points[-1] - points[0], 1e-6)
    over, under = np.maximum(x - points[-1], 0) / span, np.maximum(points[0] - x, 0) / span
    return inside + (1 - shares[-1]) / 2 * over / (1 + over) - shares[0] / 2 * under / (1 + under)


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", quality: str = "quality",
    class_bytes: int = 8 << 20, class_rows: int = 20_000, size: int = 32 << 10, level: int = 3,
) -> Model:
    """Fit on whole labelled texts that a hash of the id picks: of each class about ``class_bytes``, and no more than about
    ``class_rows`` rows (the bound of what is broadcast and reaches the driver).

    Every fourth picked text (by hash) calibrates, the others build the dictionaries.
    """
    known = labels.where(F.col(quality).isin(0, 1)).select(id_column, F.col(quality).cast("int").alias("q"))
    there = docs.where(F.col(text).isNotNull())
    lengths = there.select(id_column, (F.octet_length(text) + 1).cast("long").alias("b")).join(known, id_column)
    sums = {r[0]: (r[1], r[2]) for r in lengths.groupBy("q").agg(F.sum("b"), F.count(F.lit(1))).collect()}
    turn = F.pmod(F.xxhash64(id_column), F.lit(1 << 20))
    share = {q: min(1.0, class_bytes / b, class_rows / n) for q, (b, n) in sums.items()}
    limit = F.coalesce(*[F.when(F.col("q") == q, F.lit(int(s * (1 << 20)))) for q, s in share.items()], F.lit(0))
    picked = there.join(F.broadcast(known.where(turn < limit)), id_column)  # about class_rows ids a class; texts stay where they are
    if len(sums) < 2:
        share = 0.5 if not sums else float(next(iter(sums)))
        return Model((b"", b""), (np.zeros(1), np.array([share])), level)
    calibrates = F.pmod(F.xxhash64(id_column, F.lit(1)), F.lit(4)) == 0
    got = picked.select("q", F.encode(text, "UTF-8").alias("t"), calibrates.alias("c"), turn.alias("u")).collect()
    got.sort(key=lambda r: (r["q"], r["u"], bytes(r["t"])))
    parts = tuple([bytes(r["t"]) for r in got if r["q"] == q and not r["c"]] or [bytes(r["t"]) for r in got if r["q"] == q] for q in (0, 1))
    dictionaries = tuple(dictionary(p, size) for p in parts)
    scorer = Scorer(dictionaries, level)
    apart = [r for r in got if r["c"]]
    if len({r["q"] for r in apart}) < 2:
        apart = got
    y = np.array([r["q"] for r in apart])
    # what a row of either class stands for, so that the classes keep their shares; on average 1
    stands = {q: sums[q][1] / sum(n for _, n in sums.values()) * len(y) / max(1, (y == q).sum()) for q in (0, 1)}
    x = np.array([scorer.difference(bytes(r["t"])) for r in apart])
    return Model(dictionaries, isotonic(x, y.astype(float), np.array([stands[q] for q in y.tolist()])), level)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``difference`` and ``score`` (0 to 1, higher: better)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.dictionaries, model.level, model.curve))  # two dictionaries
    kept = [c for c in docs.columns if c != text]
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != text) + ", difference double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionaries, level, curve = shared.value
        scorer = Scorer(dictionaries, level) if any(dictionaries) else None
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            x = np.array([scorer.difference(t or b"") if scorer else 0.0 for t in texts.to_pylist()], np.float64)
            p = probability(x, curve)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(x), pa.array(p)], names=[*kept, "difference", "score"])

    return docs.select(*kept, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted); only rows that are not ``held_out`` teach. Where that is null (no id), a row is not held out and teaches nothing."""
    taught = labels.select("doc_id", "quality").where(~held_out).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    model = fit(docs.select("doc_id", "text"), taught, **how)
    out = score(docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
