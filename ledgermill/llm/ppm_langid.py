"""Language identification by prediction by partial matching.

For each language, byte contexts of up to ``order`` bytes are counted on labelled text and then
frozen. A byte costs -log2(c / (n + d)) bits in the longest context that has seen it (c times among n, d different
bytes), plus -log2(d / (n + d)) for every longer known context that it escapes from; the last resort is
8 bits. The language with the shortest code for the whole text wins; its score is its share of 2^-bits over all languages.

Frozen costs depend on the last order + 1 bytes only, so they are tabulated for every string seen in any language,
all languages side by side, and strings never seen fall back order by order.

Defined results: ``und`` with score 0 for a text that is null or has no letter, or if no language was learned.
Ties go to the language that sorts first. Repeated rows are scored alike.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4
WINDOW = 1 << 19  # positions handled at once


def strings(data: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes that end at each position from ``ORDER`` on, packed into one number."""
    out = np.zeros(len(data) - ORDER, np.uint64)
    for k in range(length):
        out = (out << np.uint64(8)) | data[ORDER - length + 1 + k: len(data) - length + 1 + k].astype(np.uint64)
    return out


def padded(text: bytes) -> bytes:
    """A text's first bytes have zeros for context."""
    return b"\0" * ORDER + text


class Tables:
    """For each order: known strings with their cost by language, known contexts with their escape cost."""

    def __init__(self, costs: list, escapes: list):
        self.costs, self.escapes = costs, escapes

    @classmethod
    def count(cls, samples: list[list[bytes]]) -> Tables:
        """Count sample texts, one list a language."""
        n_lang, costs, escapes = len(samples), [], []
        for k in range(ORDER + 1):
            counted = []
            for texts in samples:
                grams = [strings(np.frombuffer(padded(t), np.uint8), k + 1) for t in texts if t]
                counted.append(np.unique(np.concatenate(grams) if grams else np.zeros(0, np.uint64), return_counts=True))
            keys = np.unique(np.concatenate([g for g, _ in counted]))
            contexts = np.unique(keys >> np.uint64(8))
            cost, escape = np.full((len(keys), n_lang), np.nan), np.zeros((len(contexts), n_lang))
            for lang, (grams, count) in enumerate(counted):
                own, start, different = np.unique(grams >> np.uint64(8), return_index=True, return_counts=True)
                total = np.add.reduceat(count, start) if len(start) else np.zeros(0)
                escape[np.searchsorted(contexts, own), lang] = -np.log2(different / (total + different))
                at = np.searchsorted(own, grams >> np.uint64(8))
                cost[np.searchsorted(keys, grams), lang] = -np.log2(count / (total + different)[at])
            if k == 0:
                whole = np.arange(256, dtype=np.uint64)
                full = np.repeat(escape, 256, axis=0) + 8.0 if len(escape) else np.full((256, n_lang), 8.0)
                seen = ~np.isnan(cost)
                at = keys.astype(np.int64)
                full[at] = np.where(seen, cost, full[at])
                keys, cost = whole, full
            else:
                lower = costs[k - 1]
                mask = np.uint64((1 << (8 * k)) - 1)
                shorter = lower[1][np.searchsorted(lower[0], keys & mask)]  # a known string's end is known too
                fallback = escape[np.searchsorted(contexts, keys >> np.uint64(8))] + shorter
                cost = np.where(np.isnan(cost), fallback, cost)
            costs.append((keys, cost))
            escapes.append((contexts, escape))
        return cls(costs, escapes)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Cost (rows) of the last byte of each packed string, by language (columns)."""
        out = np.zeros((len(grams), self.costs[0][1].shape[1]))
        left = np.arange(len(grams))
        for k in range(ORDER, -1, -1):
            keys, cost = self.costs[k]
            own = grams[left] & np.uint64((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            known = keys[at] == own
            out[left[known]] += cost[at[known]]
            left, own = left[~known], own[~known]
            if not len(left):
                break
            contexts, escape = self.escapes[k]
            at = np.minimum(np.searchsorted(contexts, own >> np.uint64(8)), len(contexts) - 1)
            known = contexts[at] == own >> np.uint64(8)
            out[left[known]] += escape[at[known]]
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each whole text, by language."""
        out = np.zeros((len(texts), self.costs[0][1].shape[1]))
        sizes = np.array([len(t) + ORDER for t in texts])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(padded(t) for t in texts), np.uint8)
        for at in range(0, len(data), WINDOW):  # a position needs ORDER bytes before it
            low = max(at - ORDER, 0)
            piece = data[low: at + WINDOW]
            if len(piece) <= ORDER:
                continue
            position = np.arange(low + ORDER, low + len(piece))
            owner = np.searchsorted(ends, position, side="right")
            real = position - (ends[owner] - sizes[owner]) >= ORDER  # not the zeros before a text
            grams, inverse = np.unique(strings(piece, ORDER + 1)[real], return_inverse=True)
            owner = owner[real]
            if not len(owner):
                continue
            cost = self.bits(grams)
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            for lang in range(cost.shape[1]):
                out[owner[starts], lang] += np.add.reduceat(cost[:, lang][inverse], starts)
        return out


def fit(labelled: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", lang_bytes: int = 1 << 20) -> tuple[list[str], Tables | None]:
    """Languages and tables from whole texts that a hash of the id picks, about ``lang_bytes`` of each language
    (the bound of what reaches the driver)."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(text) != ""))
    sums = {r[0]: r[1] for r in rows.groupBy(lang).agg(F.sum(F.octet_length(text).cast("long"))).collect()}
    names = sorted(sums)
    if not names:
        return [], None
    limit = F.coalesce(*[F.when(F.col(lang) == n, F.lit(int(min(1.0, lang_bytes / max(1, sums[n])) * (1 << 20)))) for n in names])
    got = rows.where(F.pmod(F.xxhash64(id_column), F.lit(1 << 20)) < limit).select(lang, F.encode(text, "UTF-8").alias("t")).collect()
    samples = [sorted(bytes(r["t"]) for r in got if r[0] == n) for n in names]
    return names, Tables.count(samples)


def predict(docs: DataFrame, names: list[str], tables: Tables | None, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``."""
    # bounded by the sample that the tables were counted on
    shared = docs.sparkSession.sparkContext.broadcast((names, tables and (tables.costs, tables.escapes)))
    kept = [c for c in docs.columns if c != text]
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != text) + ", lang_pred string, score double"

    def groups(texts: list[bytes]) -> Iterator[list[bytes]]:
        own, size = [], 0
        for t in texts:
            own.append(t)
            size += len(t)
            if size >= WINDOW:
                yield own
                own, size = [], 0
        if own:
            yield own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts = shared.value
        tables = parts and Tables(*parts)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            usable = [k for k, t in enumerate(texts) if tables is not None and t is not None and any(map(str.isalpha, t))]
            best, share = np.full(len(texts), "und", object), np.zeros(len(texts))
            found = [tables.lengths(g) for g in groups([texts[k].encode("utf-8") for k in usable])]
            if found:
                bits = np.concatenate(found)
                near = np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000))
                win = bits.argmin(axis=1)
                best[usable] = [names[w] for w in win]
                share[usable] = near[np.arange(len(win)), win] / near.sum(axis=1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(best.tolist(), pa.string()), pa.array(share)], names=[*kept, "lang_pred", "score"])

    return docs.select(*kept, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


def identify(docs: DataFrame, held_out: Column, **how) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); only rows that are not ``held_out`` teach. Where that is null (no id), a row is not held out and teaches nothing."""
    names, tables = fit(docs.select("doc_id", "text", "lang").where(~held_out), **how)
    return predict(docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")), names, tables)
