"""SimHash near-duplicates found by the general pigeonhole principle.

A fingerprint has one bit for each bit position that is set in over half of the text's shingle
hashes. Distinct fingerprints are linked at ``max_bits`` or fewer differing bits:

1. Bits are grouped into partitions, correlated bits together, from counts over all fingerprints.
2. For partition radii r1..rm with sum ``max_bits - m + 1`` (a radius of -1 skips a partition), any
   linked pair agrees up to r_i in some partition i. Each fingerprint gets its own radii: a small
   dynamic programme over the estimated numbers of candidates and of probes.
3. Fingerprints are stored under their partition values and probe all values within the radius;
   rows that meet in a bucket are verified bit by bit. Buckets beyond a size are cut into blocks
   that meet in pairs, so none has to fit into a task; of the links found together only
   a spanning set leaves the task.

Components follow from the links; texts with one fingerprint are linked by having it.

Defined results: a null or blank text has no shingles and fingerprint zero, and links like any other;
repeated rows with one ``doc_id`` are one row each in the output. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import HOT_SHARE, join_hot, stage
from ledgermill.llm.components import components, spanning

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, words: int) -> int:
    """Bits set in over half of the XXH64 hashes of the word shingles, repeats included."""
    tokens = (text or b"").lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    n = max(1, len(tokens) - words + 1)
    reach = min(words, len(tokens)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[starts[i]:ends[i + reach]], SEED) for i in range(n)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for long texts
        counts += np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def text_key(text: str = "text") -> Column:
    """What tells one text from another: a digest, empty for a null text."""
    return F.coalesce(F.sha2(F.col(text).cast("string").cast("binary"), 256), F.lit(""))


def fingerprints(docs: DataFrame, words: int, id_column: str = "doc_id", text: str = "text", keyed: bool = False) -> DataFrame:
    """(id, fp): the signed 64-bit fingerprint of each whole text; if ``keyed``, its ``text_key`` as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64()), *batch.columns[2:]], names=["id", "fp", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *([text_key(text).alias("key")] if keyed else []))
    return rows.mapInArrow(run, "id long, fp long" + (", key string" if keyed else ""))


def group_bits(together: np.ndarray, n: int, parts: int) -> list[tuple[int, ...]]:
    """Greedy groups: start from the bit of least entropy left, add the bits most correlated with the group."""
    share = np.diag(together) / max(1, n)
    deviation = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs(together / max(1, n) - np.outer(share, share)) / np.outer(deviation, deviation)
    left, out = set(range(BITS)), []
    for k in range(parts):
        width = BITS * (k + 1) // parts - BITS * k // parts
        group = [min(left, key=lambda i: (deviation[i], i))]
        left -= {group[0]}
        while len(group) < width:
            best = max(left, key=lambda i: (correlation[i, group].max(), -i))
            group.append(best)
            left.remove(best)
        out.append(tuple(group))
    return out


def gather(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """The partition value: the given bits, packed in order."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def flips(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` bits among ``width``."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]
    return np.array(masks, np.uint64)


def near_counts(counts: np.ndarray, radius: int) -> np.ndarray:
    """Rows at distance exactly 0..radius from each value, from the counts by value (2^w of them)."""
    width = int(counts.size).bit_length() - 1
    value = np.arange(counts.size)
    out = np.zeros((radius + 1, counts.size))
    for r in range(min(radius, width) + 1):
        for c in combinations(range(width), r):
            out[r] += counts[value ^ sum(1 << b for b in c)]
    return out


def allocate(costs: list[np.ndarray], max_bits: int) -> np.ndarray:
    """Radii (rows x partitions) of least total cost; ``costs[i][r + 1]`` is partition i's cost at radius r.

    Dynamic programme over partitions; its state is the sum of radii so far.
    """
    parts, rows = len(costs), costs[0].shape[1]
    want = max_bits - parts + 1
    low, high = -parts, max_bits * parts
    best = np.full((high - low + 1, rows), np.inf)
    best[0 - low] = 0
    choices = []
    for cost in costs:
        new, how = np.full_like(best, np.inf), np.full(best.shape, -1, np.int8)
        for r in range(-1, max_bits + 1):
            shifted = np.full_like(best, np.inf)
            if r < 0:
                shifted[:r] = best[-r:]
            elif r == 0:
                shifted = best
            else:
                shifted[r:] = best[:-r]
            total = shifted + cost[r + 1]
            better = total < new
            new[better], how[better] = total[better], r
        best = new
        choices.append(how)
    out, state = np.empty((parts, rows), np.int8), np.full(rows, want - low)
    for k in reversed(range(parts)):
        out[k] = choices[k][state, np.arange(rows)]
        state = state - out[k]
    return out


def _bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j both set."""

    def run(frames):
        total = np.zeros((BITS, BITS))
        n = 0
        for frame in frames:
            bits = np.unpackbits(frame["fp"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.float64)
            n += len(frame)
        import pandas as pd

        if n:
            yield pd.DataFrame({"at": np.arange(-1, BITS * BITS), "n": np.concatenate(([n], total.ravel()))})

    sums = {r["at"]: r["n"] for r in distinct.select("fp").mapInPandas(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    return int(sums.get(-1, 0)), np.array([sums.get(i, 0.0) for i in range(BITS * BITS)]).reshape(BITS, BITS)


def _value_counts(distinct: DataFrame, pieces: list[tuple[int, ...]]) -> list[np.ndarray]:
    """For each piece of at most 16 bits, how many fingerprints have each value (a bounded table)."""

    def run(frames):
        import pandas as pd

        total = [np.zeros(1 << len(p), np.int64) for p in pieces]
        for frame in frames:
            fps = frame["fp"].to_numpy().view(np.uint64)
            for p, t in zip(pieces, total):
                t += np.bincount(gather(fps, p).astype(np.int64), minlength=t.size)
        for k, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pd.DataFrame({"piece": np.full(len(at), k, np.int32), "value": at.astype(np.int32), "n": t[at]})

    out = [np.zeros(1 << len(p), np.int64) for p in pieces]
    summed = distinct.select("fp").mapInPandas(run, "piece int, value int, n long").groupBy("piece", "value").agg(F.sum("n").alias("n"))
    for frame in [summed.toPandas()]:  # at most 65,536 rows a piece
        for k, t in enumerate(out):
            own = frame[frame["piece"] == k]
            t[own["value"].to_numpy()] = own["n"].to_numpy()
    return out


def near_links(distinct: DataFrame, max_bits: int = 3, block: int = 4096, probe_cost: float = 4.0) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in column ``fp``: enough of them that two
    fingerprints within ``max_bits`` are always connected, and none farther apart."""
    spark = distinct.sparkSession
    n, together = _bit_statistics(distinct)
    # more fingerprints want wider partitions, so that buckets stay small
    parts = max(2, min(max_bits + 1, BITS // max(1, (max(n, 2) - 1).bit_length() - 2)))
    groups = group_bits(together, n, parts)
    pieces, of = [], []
    for g in groups:
        cut = -(-len(g) // 16)
        own = [g[len(g) * k // cut: len(g) * (k + 1) // cut] for k in range(cut)]
        of.append(list(range(len(pieces), len(pieces) + cut)))
        pieces += own
    counts = _value_counts(distinct, pieces)
    masks = {(len(g), r): flips(len(g), r) for g in groups for r in range(max_bits + 1)}
    near = spark.sparkContext.broadcast([near_counts(c, max_bits) for c in counts])  # 2^16 x (max_bits + 1) a piece

    def estimates(fps: np.ndarray) -> list[np.ndarray]:
        out = []
        for g, own in zip(groups, of):
            exact = np.zeros((max_bits + 1, len(fps)))
            exact[0] = n
            for k in own:  # pieces of a partition as if independent
                here = near.value[k][:, gather(fps, pieces[k]).astype(np.int64)] / max(1, n)
                exact = np.stack([sum(exact[r - q] * here[q] for q in range(r + 1)) for r in range(max_bits + 1)])
            within = np.cumsum(exact, axis=0)
            probes = np.array([len(masks[len(g), r]) for r in range(max_bits + 1)])[:, None]
            out.append(np.concatenate([np.zeros((1, len(fps))), within + probe_cost * probes]))
        return out

    def deal(frames):
        import pandas as pd

        for frame in frames:
            signed = frame["fp"].to_numpy()
            for at in range(0, len(signed), 2000):
                own = signed[at:at + 2000]
                fps = own.view(np.uint64)
                radii = allocate(estimates(fps), max_bits)
                for i, g in enumerate(groups):
                    value = gather(fps, g)
                    # role 1: stored; 2: asks; 3: both
                    yield pd.DataFrame({"part": np.int32(i), "value": value.view(np.int64), "fp": own, "role": np.where(radii[i] >= 0, 3, 1).astype(np.int32)})
                    for r in range(1, max_bits + 1):
                        who = np.flatnonzero(radii[i] == r)
                        if len(who):
                            there = value[who][:, None] ^ masks[len(g), r][None, 1:]
                            yield pd.DataFrame({"part": np.int32(i), "value": there.ravel().view(np.int64), "fp": np.repeat(own[who], there.shape[1]), "role": np.int32(2)})

    dealt = stage(distinct.select("fp").mapInPandas(deal, "part int, value long, fp long, role int"), "probes")
    sizes = dealt.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.max("role").alias("most"), F.sum(F.expr("role % 2")).alias("stored"))
    # a bucket matters if two rows meet in it, one of them stored and one asking
    sizes = stage(sizes.where("n > 1 and most > 1 and stored > 0").withColumn("blocks", F.ceil(F.col("n") / block)).select("part", "value", "n", "blocks"), "buckets")
    total = dealt.count()
    key = F.xxhash64("part", "value").alias("bucket")
    met = join_hot(dealt.withColumn("bucket", key), sizes.select(key, "n", "blocks"), "bucket", F.col("n") > max(1000, total * HOT_SHARE))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # block pairs (i <= j) of a bucket: a row of block b goes to all pairs that have b
    met = met.withColumn("_b", own).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    met = met.select("part", "value", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"), "fp", "role")
    keys = ["part", "value", "i", "j"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(rows)
            cols = [whole.column(k).to_numpy() for k in keys]
            a, b = spanning_links(cols, whole.column("fp").to_numpy(), whole.column("role").to_numpy(), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
            same = np.logical_and.reduce([batch.column(k).to_numpy() == v for k, v in zip(keys, last)])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:  # groups that end inside this batch
                yield close([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield close(held)

    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(verify, "a long, b long").where("a <> b").distinct()


def spanning_links(keys: list[np.ndarray], fps: np.ndarray, role: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of one group (groups stand together), without those between rows that
    emitted links already connect."""
    starts = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))))
    group = np.zeros(len(fps), np.int64)
    group[starts[1:]] = 1
    group = np.cumsum(group)
    value = fps.view(np.uint64)
    label = np.arange(len(fps))
    out = []
    at, step = np.arange(len(fps)), 0
    while True:
        step += 1
        at = at[at + step < len(fps)]
        at = at[group[at + step] == group[at]]
        if not len(at):
            break
        other = at + step
        fits = (np.bitwise_count(value[at] ^ value[other]) <= max_bits) & (label[at] != label[other])
        fits &= ((role[at] | role[other]) >= 2) & ((role[at] & 1) | (role[other] & 1)).astype(bool)
        a, b = at[fits], other[fits]
        if not len(a):
            continue
        links, label = spanning(a, b, label)
        out.append((a[links], b[links]))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty
    a, b = (np.concatenate(x) for x in zip(*out))
    return fps[a], fps[b]


def _judge(marked: DataFrame, max_bits: int) -> DataFrame:
    """``marked`` (id, fp, ...) with (root, component_id): the component's root fingerprint and its smallest id.

    Where ids repeat, components that differ may have the same smallest id; the root tells them apart.
    """
    distinct = stage(marked.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    total = marked.count()
    links = near_links(distinct, max_bits)
    roots = components(links, "a", "b")
    # the component's smallest id, by way of its root fingerprint
    own = distinct.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    own = stage(own, "members")
    least = own.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("m"))
    count = distinct.count()
    own = join_hot(own, least, "root", F.col("m") > max(1000, count * HOT_SHARE)).select("fp", "n", "root", "component_id")
    return join_hot(marked, stage(own, "components"), "fp", F.col("n") > max(1000, total * HOT_SHARE))


def survivors(docs: DataFrame, words: int = 3, max_bits: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key): which text stays for each component, by its id and ``text_key``.

    Of a component the rows with its smallest id may stay; if these have several texts, the one with the smallest key
    does. Rows without an id name no survivor.
    """
    marked = stage(fingerprints(docs, words, id_column, text, keyed=True), "fingerprints")
    return _judge(marked, max_bits).where("id = component_id").groupBy("id", "root").agg(F.min("key").alias("key")).select("id", "key")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id, kept): one row per row of ``docs``."""
    marked = stage(fingerprints(docs, words, id_column, text), "fingerprints")
    out = _judge(marked, max_bits)
    return out.select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
