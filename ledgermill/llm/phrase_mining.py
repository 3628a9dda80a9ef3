"""Phrase collocations counted in HAT-tries.

Words become 64-bit hashes of (language, word); the table of all words proves that no two share one (else another salt is taken), so counts
are exact. Each task puts its word windows into a HAT-trie: under a shallow trie of word ids lie hash containers, from the rest of a window to its
count; a container that grows beyond ``BURST`` entries bursts into one for each next word. Beyond ``ENTRIES`` the largest subtrees leave
the task whole, as sorted runs. Runs travel as one row a subtree, are shuffled by this prefix and merged there; subtrees of words that make up more than
a thousandth of all (fewer than a thousand words) are dealt over ``SPLITS`` prefix partitions by their next words.

Two readings keep runs small: pairs first, then windows of three and four words whose pairs all may be frequent. Words and pairs
that may be frequent are known from bitmaps of a fixed size (``BITS``), which alone are broadcast; a bit set by chance costs a count, never a result.
Counts of three words are sums over the windows that start with them.

A phrase's score compares its count with those of its two parts at the weakest cut. All joins are by whole phrases, shuffled; the best phrases of a language
are chosen in salted groups before they meet.

Defined results: a null text has no words, a null language is ``und``. Repeated rows count again. An empty table gives no rows; only the two named columns are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import stage
from ledgermill.llm.license_scan import LOWER, UPPER

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 4
BITS = 1 << 26  # of a bitmap: 8 MB
BITMAP_ROW = 1 << 15  # bits in one row of Spark's bitmap aggregate
CHUNK = 1 << 19  # word positions counted at once
ID_BITS = 20  # of a word within a task
BURST, ENTRIES = 4096, 800_000
SALTS = 64
HOT_WORD = 1 / 1000
SPLITS = 64


def words(lang: Column, text: Column) -> tuple[Column, Column]:
    """The language and the words of a text, with a line feed between pieces."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.coalesce(lang.cast("string"), F.lit("und")), F.split(F.regexp_replace(lower, r"[.,;:!?\x0A-\x0D]+", " \n "), "[ \t]+")


def _is_word(word: Column) -> Column:
    return (word != "") & (word != "\n")


def _bitmap(rows: DataFrame, place: Column) -> np.ndarray:
    """Bytes of a bitmap of BITS bits with those at ``place`` set: never more than BITS / 8 bytes reach the driver."""
    at = place.bitwiseAND(F.lit(BITS - 1))
    found = rows.select(at.alias("at")).groupBy(F.expr(f"at div {BITMAP_ROW}").alias("row")).agg(F.bitmap_construct_agg(F.col("at") % BITMAP_ROW).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in found.toLocalIterator():
        out[r.row * (BITMAP_ROW // 8):(r.row + 1) * (BITMAP_ROW // 8)] = np.frombuffer(r.bits, np.uint8)
    return out


def _marked(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    at = place & np.uint64(BITS - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pair_place(first: Column, second: Column) -> Column:
    return first.bitwiseXOR(F.shiftleft(second, 17).bitwiseOR(F.shiftrightunsigned(second, 47)))


def _pair_places(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first ^ ((second << np.uint64(17)) | (second >> np.uint64(47)))


class HatTrie:
    """Counts of windows of ``depth`` words (shorter ones end in 0) of one task."""

    def __init__(self, depth: int, entries: int = ENTRIES, burst: int = BURST):
        self.depth, self.entries, self.burst = depth, entries, burst
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[int, int] = {0: 0}  # word -> its number in this task
        self.root: dict[int, dict] = {}  # first word -> container (rest -> count), or node (second word -> container)
        self.nodes: set[int] = set()  # first words whose container has burst
        self.size = 0

    def add(self, columns: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        """Count windows, given as one array of word hashes a position; yields runs that left."""
        unique, inverse = np.unique(np.concatenate(columns), return_inverse=True)
        if len(self.numbers) + len(unique) >= 1 << ID_BITS:
            yield from self.spill(0)
            self.clear()
        numbers = self.numbers
        own = np.fromiter((numbers.setdefault(h, len(numbers)) for h in unique.tolist()), np.int64, len(unique))[inverse].reshape(self.depth, -1)
        first, rest = own[0], np.zeros_like(own[0])
        for column in own[1:]:
            rest = (rest << ID_BITS) | column
        order = np.lexsort((rest, first))
        first, rest = first[order], rest[order]
        new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (rest[1:] != rest[:-1]))))
        count = np.diff(np.append(new, len(first)))
        first, rest = first[new], rest[new]
        starts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        rests, counts = rest.tolist(), count.tolist()
        for word, a, b in zip(first[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(first)]):
            self._insert(word, rests[a:b], counts[a:b])
            if self.size > self.entries:
                yield from self.spill(self.entries // 2)

    def _insert(self, word: int, rests: list[int], counts: list[int]) -> None:
        if word in self.nodes:
            node, shift = self.root[word], ID_BITS * (self.depth - 2)
            low = (1 << shift) - 1
            for rest, count in zip(rests, counts):
                container = node.setdefault(rest >> shift, {})
                before = len(container)
                container[rest & low] = container.get(rest & low, 0) + count
                self.size += len(container) - before
            return
        container = self.root.setdefault(word, {})
        before = len(container)
        for rest, count in zip(rests, counts):
            container[rest] = container.get(rest, 0) + count
        self.size += len(container) - before
        if len(container) > self.burst and self.depth > 2:
            shift = ID_BITS * (self.depth - 2)
            node: dict[int, dict] = {}
            for rest, count in container.items():
                node.setdefault(rest >> shift, {})[rest & ((1 << shift) - 1)] = count
            self.root[word] = node
            self.nodes.add(word)

    def _windows(self, word: int) -> tuple[list[int], list[int]]:
        """The rests below a first word in order, and their counts."""
        if word not in self.nodes:
            found = sorted(self.root[word].items())
        else:
            shift = ID_BITS * (self.depth - 2)
            found = [(second << shift | rest, n) for second, container in sorted(self.root[word].items()) for rest, n in sorted(container.items())]
        return [r for r, _ in found], [n for _, n in found]

    def _size(self, word: int) -> int:
        return sum(map(len, self.root[word].values())) if word in self.nodes else len(self.root[word])

    def spill(self, entries: int) -> Iterator[list[np.ndarray]]:
        """Whole subtrees, the largest first, until ``entries`` are left: columns of words and counts."""
        names = np.fromiter(self.numbers, np.uint64, len(self.numbers))
        firsts, rests, counts = [], [], []
        for word in sorted(self.root, key=lambda w: (-self._size(w), w)):
            if self.size <= entries:
                break
            own, many = self._windows(word)
            self.size -= len(own)
            del self.root[word]
            self.nodes.discard(word)
            firsts += [word] * len(own)
            rests += own
            counts += many
            if len(rests) > 1 << 16:
                yield self._columns(names, firsts, rests, counts)
                firsts, rests, counts = [], [], []
        if rests:
            yield self._columns(names, firsts, rests, counts)

    def _columns(self, names: np.ndarray, firsts: list[int], rests: list[int], counts: list[int]) -> list[np.ndarray]:
        rest = np.array(rests, np.int64)
        words = [(rest >> (ID_BITS * (self.depth - 2 - k))) & ((1 << ID_BITS) - 1) for k in range(self.depth - 1)]
        return [*[names[w].view(np.int64) for w in (np.array(firsts, np.int64), *words)], np.array(counts, np.int64)]


def windows(sequence: np.ndarray, starts: int, depth: int, frequent: np.ndarray, pairs: np.ndarray | None) -> list[np.ndarray]:
    """The windows that begin in the first ``starts`` positions of a sequence (0 between pieces) and hold only what may be frequent."""
    own = np.concatenate((sequence, np.zeros(LONGEST, np.uint64)))
    own = np.where(_marked(frequent, own), own, np.uint64(0))
    joined = (own[:-1] != 0) & (own[1:] != 0)
    if depth == 2:
        at = np.flatnonzero(joined[:starts])
        return [own[at], own[at + 1]]
    joined &= _marked(pairs, _pair_places(own[:-1], own[1:]))
    at = np.flatnonzero(joined[:starts] & joined[1:starts + 1])
    return [own[at], own[at + 1], own[at + 2], np.where(joined[at + 2], own[at + 3], np.uint64(0))]


def _rows(columns: list[np.ndarray], hot: np.ndarray) -> pa.RecordBatch:
    """One row for each (first word, split) of a run: the other words and the counts as arrays."""
    first = columns[0]
    split = np.where(np.isin(first, hot), (columns[1] ^ (columns[2] if len(columns) > 3 else 0)) & (SPLITS - 1), 0)
    order = np.lexsort((split, first))  # stable: the run's order inside
    first, split = first[order], split[order]
    new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (split[1:] != split[:-1]))))
    offsets = pa.array(np.append(new, len(first)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c[order])) for c in columns[1:]]
    names = ["w1", "split", *[f"w{k + 2}" for k in range(len(columns) - 2)], "n"]
    return pa.RecordBatch.from_arrays([pa.array(first[new]), pa.array(split[new]), *lists], names=names)


def count_windows(sequences: DataFrame, depth: int, frequent: np.ndarray, pairs: np.ndarray | None, hot: np.ndarray) -> DataFrame:
    """Windows (w1, split, w2, ... and n) of the HAT-tries over ``sequences`` (one array of word hashes), in the partitions of (w1, split)."""
    shared = sequences.sparkSession.sparkContext.broadcast((frequent, pairs, hot))  # of a fixed size
    rest = [f"w{k + 2}" for k in range(depth - 1)] + ["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, (words, both, hot) = HatTrie(depth), shared.value
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), CHUNK):
                part = values[at:at + CHUNK + LONGEST - 1]
                found = windows(part, min(CHUNK, len(values) - at), depth, words, both)
                if len(found[0]):
                    yield from (_rows(r, hot) for r in trie.add(found))
        yield from (_rows(r, hot) for r in trie.spill(0))

    runs = sequences.mapInArrow(run, "w1 long, split long, " + ", ".join(f"{c} array<long>" for c in rest))
    return runs.repartition("w1", "split").select("w1", "split", F.inline(F.arrays_zip(*rest)))


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, n, id) of all words, and the salt of the ids: none is 0 and no two are equal."""
    rows = docs.select("lang", F.explode("words").alias("word")).where(_is_word(F.col("word")))
    table = stage(rows.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "phrase-words")
    salt = 0
    while True:
        out = table.withColumn("id", word_id(F.col("lang"), F.col("word"), salt))
        if not out.groupBy("id").agg(F.count(F.lit(1)).alias("many")).where("many > 1 or id = 0").take(1):
            return out, salt
        salt += 1


def word_id(lang: Column, word: Column, salt: int) -> Column:
    return F.xxhash64(lang, word, F.lit(salt))


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(ids, n) of all phrases of 1 to LONGEST words with ``least`` occurrences, and the table of all words."""
    table, salt = vocabulary(docs)
    ones = table.where(F.col("n") >= least)
    frequent = _bitmap(ones, F.col("id"))
    ids = F.transform("words", lambda w: F.when(_is_word(w), word_id(F.col("lang"), w, salt)).otherwise(F.lit(0).cast("long")))
    sequences = docs.select(F.concat(ids, F.array(F.lit(0).cast("long"))).alias("ids"))  # pieces end with their text
    sequences = stage(sequences, "phrase-sequences")  # read twice
    total, words_in_all = F.sum("n").alias("n"), table.agg(F.sum("n")).first()[0] or 0
    often = table.where(F.col("n") > words_in_all * HOT_WORD).select("id").toLocalIterator()
    hot = np.fromiter((r.id for r in often), np.int64)
    runs = count_windows(sequences, 2, frequent, None, hot)
    twos = stage(runs.groupBy("w1", "split", "w2").agg(total).where(F.col("n") >= least), "phrase-pairs")
    pairs = _bitmap(twos, _pair_place(F.col("w1"), F.col("w2")))
    runs = count_windows(sequences, LONGEST, frequent, pairs, hot)  # both sums merge in its partitions
    threes = runs.groupBy("w1", "split", "w2", "w3").agg(total).where(F.col("n") >= least)
    fours = runs.where("w4 <> 0").groupBy("w1", "split", "w2", "w3", "w4").agg(total).where(F.col("n") >= least)
    phrases = ones.select(F.array("id").alias("ids"), "n").unionByName(twos.select(F.array("w1", "w2").alias("ids"), "n"))
    phrases = phrases.unionByName(threes.select(F.array("w1", "w2", "w3").alias("ids"), "n")).unionByName(fours.select(F.array("w1", "w2", "w3", "w4").alias("ids"), "n"))
    return stage(phrases, "phrases"), table


def _scored(phrases: DataFrame) -> DataFrame:
    """(ids, a, l, r, score) of every phrase of two or more words, at its lowest-scoring cut."""
    counts = phrases.select(F.col("ids").alias("part"), F.col("n").alias("part_n"))
    cuts = phrases.where(F.size("ids") > 1).select("ids", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    side = lambda left, part: F.struct(F.lit(left).alias("left"), part.alias("part"))
    sides = cuts.select("ids", "a", "k", F.explode(F.array(
        side(True, F.slice("ids", F.lit(1), F.col("k"))), side(False, F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))))).alias("side"))
    found = sides.select("ids", "a", "k", "side.left", "side.part").join(counts, "part")  # a part is at least as frequent as the whole
    split = found.groupBy("ids", "a", "k").agg(F.sum(F.when(F.col("left"), F.col("part_n"))).alias("l"), F.sum(F.when(~F.col("left"), F.col("part_n"))).alias("r"))
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = split.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("ids", "a", "cut.l", "cut.r", "cut.score")


def _standing(phrases: DataFrame, percent: int) -> DataFrame:
    """The ``phrases`` (ids, n) of two or more words that no longer one holds ``percent`` of the times."""
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size("ids") - size + 1), lambda at: F.slice("ids", at, size))))
    inside = phrases.where(F.size("ids") > 2).select(F.explode(spans).alias("inner"), "n").groupBy("inner").agg(F.max("n").alias("outer_n"))
    two = phrases.where(F.size("ids") > 1).select("ids", "n").join(inside, F.col("ids") == F.col("inner"), "left")
    return two.where(F.col("outer_n").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("outer_n") < F.lit(percent).cast("decimal(20,0)") * F.col("n"))).select("ids")


def mine(docs: DataFrame, least: int = 30, top: int = 2000, percent: int = 80, lang: str = "lang", text: str = "text") -> DataFrame:
    """Each language's best collocations: lang, rank, phrase, a, l, r, n, score (see the module)."""
    own, split = words(F.col(lang), F.col(text))
    rows = docs.select(own.alias("lang"), split.alias("words"))
    phrases, table = frequent_phrases(rows, least)
    kept = _scored(phrases).join(_standing(phrases, percent), "ids")
    named = table.select(F.col("id").alias("first"), "lang").join(kept.withColumn("first", F.get("ids", F.lit(0))), "first").drop("first")
    order = [F.desc("score"), F.desc("a")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("ids"), F.lit(SALTS))).orderBy(*order)
    few = named.withColumn("place", F.rank().over(salted)).where(F.col("place") <= top).drop("place")
    few = stage(few.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place"), "phrase-best")
    texts = few.select("ids", F.posexplode("ids").alias("at", "id")).join(table.select("id", "word"), "id")
    texts = texts.groupBy("ids").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    totals = table.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = few.join(texts, "ids").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
