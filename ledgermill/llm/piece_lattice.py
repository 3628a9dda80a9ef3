"""SentencePiece encoding and decoding by suffix-array matching.

The distinct segments of a batch (white space and the word after it; no piece of the model crosses a segment's start) are
concatenated and indexed by a suffix array down to the longest piece. A binary search of every
piece gives its range of occurrences, symbol by symbol for all pieces at once; the ranges become edges of a lattice, sorted by end position and length
(a counting sort: longest pieces first, each end at most once a length).

Relaxing then goes along positions, in all segments side by side. For a unigram model the best score reaches each position. A BPE
model merges by rank, which is no shortest path: there the prefix of each position has exactly one
encoding, and its last piece is the one that may follow the last piece at the edge's start. Whether one piece may follow
another (merging both texts together gives these two again) is kept in a table with one place a hash value.

Memory is bounded whatever the texts: ``GROUP`` new characters are indexed at once; ids of up to about ``STORE`` characters of distinct segments are remembered, of which
the frequent ones outlast a clearing. A text may go through several groups, and a segment longer than a group is relaxed slice by slice. Beyond that
a task holds one text, its ids and, for a segment of that length, six bytes a character (14 for unigram models).

Characters outside the vocabulary fall back to byte pieces, or to the unknown piece without those.

Defined results: a null text gives null ids, an empty one none. U+2581 in a text decodes as a space, as the model cannot
tell them apart. Repeated rows are encoded alike; very long texts are segments like any other. Columns of the input named like a result
(``ids``, ``round_trip``; ``text`` for decoding) give way to it.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
TEXTS = 1 << 20  # characters of texts encoded at once
GROUP = 1 << 18  # characters indexed at once
STORE = 1 << 20  # characters of distinct segments whose ids are remembered
PLACE_BITS = 21  # of the table of pairs


@dataclass(frozen=True)
class Vocabulary:
    """What of a model file the operator needs."""

    kind: int
    pieces: list[str]
    scores: list[float]
    types: list[int]
    dummy_prefix: bool


def load(model: bytes) -> Vocabulary:
    """Read a serialised model. Its normaliser must be the identity; user-defined pieces are not supported."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    own = Vocabulary(
        proto.trainer_spec.model_type, [p.piece for p in proto.pieces], [p.score for p in proto.pieces], [p.type for p in proto.pieces],
        proto.normalizer_spec.add_dummy_prefix,
    )
    if own.kind not in (UNIGRAM, BPE) or proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces or USER in own.types:
        raise ValueError("only unigram and BPE models with the identity normaliser are supported")
    if proto.trainer_spec.treat_whitespace_as_suffix or not proto.normalizer_spec.escape_whitespaces:
        raise ValueError("only models that escape white space in front of words are supported")
    return own


class _Numbers(dict):
    """Numbers segments as they come; knows the new ones and the characters of all."""

    def __init__(self, known: Iterable[str] = ()):
        super().__init__((s, k) for k, s in enumerate(known))
        self.size, self.new, self.new_size = sum(map(len, self)), [], 0

    def __missing__(self, segment: str) -> int:
        number = self[segment] = len(self)
        self.new.append(segment)
        self.size += len(segment)
        self.new_size += len(segment)
        return number

    def take(self) -> list[str]:
        new, self.new, self.new_size = self.new, [], 0
        return new


@dataclass(frozen=True)
class Lattice:
    """Edges sorted by end position, longest first: those that end at p are ``first[p]`` to ``first[p + 1]``."""

    first: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) + 1


class Coder:
    """Encodes and decodes with one vocabulary; remembers segments and which pieces may follow each other."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.ids = {p: k for k, (p, t) in enumerate(zip(vocabulary.pieces, vocabulary.types)) if t == NORMAL}
        self.unknown = next((k for k, t in enumerate(vocabulary.types) if t == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): k for k, (p, t) in enumerate(zip(vocabulary.pieces, vocabulary.types)) if t == BYTE}
        self.longest = max((len(p) for p in self.ids), default=1)
        # no piece may cross a segment's start; unknown characters that become bytes stand alone
        whole = len(self.bytes) < 256 or any(SPACE in p.lstrip(SPACE) for p in self.ids)
        alone = "".join(c for c in "\t\n\r" if not any(c in p for p in self.ids))
        self.segment = re.compile("(?s).+" if whole else f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + f"|[{alone}]" * bool(alone))
        self._name_prefixes()
        self.penalty = min((s for s, t in zip(vocabulary.scores, vocabulary.types) if t == NORMAL), default=0.0) - 10
        self.pair_keys, self.pair_fits = np.full(1 << PLACE_BITS, -1, np.int64), np.zeros(1 << PLACE_BITS, bool)
        self.numbers = _Numbers()
        self.store, self.starts, self.stops = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        parts = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.replace(SPACE, " ").encode() for p, t in zip(vocabulary.pieces, vocabulary.types)]
        self.part_ends = np.cumsum([len(p) for p in parts])
        self.part_starts = self.part_ends - [len(p) for p in parts]
        self.part_bytes = np.frombuffer(b"".join(parts), np.uint8)

    def merged(self, text: str) -> list[int]:
        """BPE by its definition, for short strings of known characters."""
        symbols = list(text)
        while len(symbols) > 1:
            best = None
            for k in range(len(symbols) - 1):
                piece = self.ids.get(symbols[k] + symbols[k + 1])
                if piece is not None and (best is None or self.v.scores[piece] > best[0]):
                    best = (self.v.scores[piece], k)
            if best is None:
                break
            k = best[1]
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
        return [self.ids.get(s, -1) for s in symbols]

    def _name_prefixes(self) -> None:
        """Distinct prefixes of all pieces, a level for each length: parent (place in the level above), last symbol and piece (-1: none)."""
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        above, names = {"": 0}, sorted(self.ids)
        for size in range(1, self.longest + 1):
            names = [n for n in names if len(n) >= size]
            here = {p: k for k, p in enumerate(dict.fromkeys(n[:size] for n in names))}
            parents = np.fromiter((above[p[:-1]] for p in here), np.int64, len(here))
            symbols = np.fromiter((ord(p[-1]) + 1 for p in here), np.int64, len(here))
            pieces = np.fromiter((self.ids.get(p, -1) for p in here), np.int32, len(here))
            self.levels.append((parents, symbols, pieces))
            above = here

    def _follows(self, first: int, second: int) -> bool:
        text = self.v.pieces[second]
        return self.merged(text) == [second] if first < 0 else self.merged(self.v.pieces[first] + text) == [first, second]

    def may_follow(self, first: int, second: int) -> bool:
        """Whether ``second`` may stand after ``first`` (-1: at a start or after an unknown character)."""
        key = (first + 1) * len(self.v.pieces) + second
        place = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - PLACE_BITS)
        if self.pair_keys[place] != key:
            self.pair_keys[place], self.pair_fits[place] = key, self._follows(first, second)
        return bool(self.pair_fits[place])

    def all_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``may_follow`` for arrays."""
        n = len(self.v.pieces)
        key = (first.astype(np.int64) + 1) * n + second
        place = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
        out = self.pair_fits[place]
        missing = np.flatnonzero(self.pair_keys[place] != key)
        if len(missing):
            new, inverse = np.unique(key[missing], return_inverse=True)
            fits = np.fromiter((self._follows(k // n - 1, k % n) for k in new.tolist()), bool, len(new))
            out[missing] = fits[inverse]
            self.pair_keys[place[missing]], self.pair_fits[place[missing]] = key[missing], out[missing]
            # two keys of one place: the entry must be one of them, whole
            torn = self.pair_keys[place[missing]] != key[missing]
            clash = place[missing[torn]]
            self.pair_keys[clash] = -1
        return out

    def suffixes(self, codes: np.ndarray) -> np.ndarray:
        """Positions in order of the ``longest`` symbols that follow, by doubling."""
        present = np.bincount(codes) > 0
        rank = (np.cumsum(present, dtype=np.int32) - 1)[codes]
        reach = 1
        while True:
            both = rank.astype(np.int64)
            both *= len(rank) + 2
            both[:-reach] += rank[reach:]
            both[:-reach] += 1
            order = np.argsort(both).astype(np.int32)
            if reach * 2 >= self.longest or reach * 2 >= len(rank):
                return order
            both = both[order]
            rank[order] = np.concatenate(([0], np.cumsum(both[1:] != both[:-1], dtype=np.int32)))
            reach *= 2

    def ranges(self, codes: np.ndarray, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length, its pieces that occur, and their first and last + 1 places in the suffix array.

        The suffixes below a prefix are neighbours in order of their next symbol, so (prefix, next symbol) rises along the array
        and a binary search finds all longer prefixes at once.
        """
        low, high = np.zeros(1, np.int64), np.full(1, len(order), np.int64)
        for size, (parents, symbols, pieces) in enumerate(self.levels):
            kept = np.flatnonzero(high[parents] > low[parents])
            out_low, out_high = np.zeros(len(parents), np.int64), np.zeros(len(parents), np.int64)
            if len(kept):
                # suffixes outside all prefixes that have longer ones are left out
                owners = np.unique(parents[kept])
                counts = high[owners] - low[owners]
                before = np.cumsum(counts) - counts
                places = np.arange(int(counts.sum())) + np.repeat(low[owners] - before, counts)
                at = order[places].astype(np.int64) + size
                following = np.where(at < len(codes), codes[np.minimum(at, len(codes) - 1)], 0).astype(np.int64)
                keys = np.repeat(np.arange(len(owners)), counts) * (1 << 21) + following
                owner = np.searchsorted(owners, parents[kept])
                wanted = owner * (1 << 21) + symbols[kept]
                shift = (low[owners] - before)[owner]
                out_low[kept] = np.searchsorted(keys, wanted, side="left") + shift
                out_high[kept] = np.searchsorted(keys, wanted, side="right") + shift
            low, high = out_low, out_high
            found = np.flatnonzero((pieces >= 0) & (high > low))
            yield pieces[found], low[found], high[found]

    def lattice(self, codes: np.ndarray) -> Lattice:
        """All occurrences of pieces, by end and, longest first, by length."""
        order = self.suffixes(codes)
        found, counts = [], np.zeros(len(codes) + 2, np.int32)
        for size, (pieces, low, high) in enumerate(self.ranges(codes, order), 1):
            many = high - low
            ends = order[np.arange(int(many.sum())) + np.repeat(low - (np.cumsum(many) - many), many)] + np.int32(size)
            counts[ends + 1] += 1  # a position ends one piece of a length at most
            found.append((size, ends, np.repeat(pieces, many)))
        first = np.cumsum(counts, dtype=np.int32)
        place = first[:-1].copy()
        sizes, ids = np.empty(first[-1], np.uint16), np.empty(first[-1], np.int32)
        for size, ends, pieces in reversed(found):
            sizes[place[ends]], ids[place[ends]] = size, pieces
            place[ends] += 1
        return Lattice(first, sizes, ids)

    def segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, one after the other, and where each segment's ids end."""
        parts, ends, total, start = [], [], 0, 0
        while start < len(segments):
            stop, size = start, 0
            while stop < len(segments) and (stop == start or size + len(segments[stop]) <= GROUP):
                size += len(segments[stop])
                stop += 1
            ids, own = self._segments(segments[start:stop]) if size <= GROUP else self._long_segment(segments[start])
            parts.append(ids)
            ends.append(own + total)
            total, start = total + len(ids), stop
        return np.concatenate(parts), np.concatenate(ends)

    def _segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\0".join(segments) + "\0"
        codes = _codes(text)
        sizes = np.array([len(s) for s in segments], np.int64)
        stops = np.cumsum(sizes + 1) - 1
        codes[stops] = 0
        last, back = np.full(len(codes) + 1, -1, np.int32), np.ones(len(codes) + 1, np.uint16)
        (self._relax_bpe if self.v.kind == BPE else self._relax_unigram)(self.lattice(codes), stops - sizes, sizes, last, back)
        ids, ends, upto = self._walk(text, stops - sizes, stops, last, back)
        return ids, upto[np.searchsorted(ends, stops, side="right")]

    def _long_segment(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        last, back = np.full(len(text) + 1, -1, np.int32), np.ones(len(text) + 1, np.uint16)
        best = np.zeros(len(text) + 1) if self.v.kind == UNIGRAM else None
        for start in range(0, len(text), GROUP):
            shift, stop = max(0, start - self.longest), min(len(text), start + GROUP)
            self._relax_slice(self.lattice(_codes(text[shift:stop])), shift, start + 1, stop, last, back, best)
        ids, _, _ = self._walk(text, np.zeros(1, np.int64), np.array([len(text)]), last, back)
        return ids, np.array([len(ids)])

    def _walk(self, text: str, begins: np.ndarray, stops: np.ndarray, last: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Walk back from all ends at once: ids, where their pieces end in the text, and how many ids are before each piece."""
        marked = np.zeros(len(last), bool)
        at, begin = stops[stops > begins], begins[stops > begins]
        if len(at) == 1:
            at, begin = int(at[0]), int(begin[0])
            while at > begin:
                marked[at] = True
                at -= int(back[at])
        else:
            while len(at):
                marked[at] = True
                at = at - back[at]
                more = at > begin
                at, begin = at[more], begin[more]
        ends = np.flatnonzero(marked)
        ids = last[ends]
        known = ids >= 0
        fallback = {int(k): self._fallback(text[ends[k] - 1]) for k in np.flatnonzero(~known)}
        many = np.ones(len(ids), np.int64)
        for k, own in fallback.items():
            many[k] = len(own)
        upto = np.concatenate(([0], np.cumsum(many)))
        out = np.empty(upto[-1], np.int32)
        out[upto[:-1][known]] = ids[known]
        for k, own in fallback.items():
            out[upto[k]:upto[k + 1]] = own
        return out, ends, upto

    def _fallback(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode("utf-8", "surrogatepass")] if len(self.bytes) == 256 else [self.unknown]

    def _relax_bpe(self, lattice: Lattice, begins: np.ndarray, sizes: np.ndarray, last: np.ndarray, back: np.ndarray) -> None:
        """Last piece (-1: a character that no piece has) of each position's prefix, and its length."""
        by_size = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[by_size], sizes[by_size]
        step = 0
        while True:
            step += 1
            active = int(np.searchsorted(-sizes, -step, side="right"))
            if active < 24:  # few long segments are left: one by one
                break
            position = begins[:active] + step
            edge, stop = lattice.first[position], lattice.first[position + 1]
            while len(position):
                some = edge < stop
                if not some.all():
                    position, edge, stop = position[some], edge[some], stop[some]
                ids, size = lattice.ids[edge], lattice.sizes[edge]
                fits = self.all_follow(last[position - size], ids)
                last[position[fits]], back[position[fits]] = ids[fits], size[fits]
                left = ~fits
                position, edge, stop = position[left], edge[left] + 1, stop[left]
        for begin, size in zip(begins[:active].tolist(), sizes[:active].tolist()):
            self._relax_slice(lattice, 0, begin + step, begin + size, last, back, None)

    def _relax_unigram(self, lattice: Lattice, begins: np.ndarray, sizes: np.ndarray, last: np.ndarray, back: np.ndarray) -> None:
        """Likewise by the best sum of scores; an unknown character costs ``penalty``."""
        best = np.zeros(len(last))
        for begin, size in zip(begins.tolist(), sizes.tolist()):
            self._relax_slice(lattice, 0, begin + 1, begin + size, last, back, best)

    def _relax_slice(self, lattice: Lattice, shift: int, start: int, stop: int, last: np.ndarray, back: np.ndarray, best: np.ndarray | None) -> None:
        """Positions ``start`` to ``stop`` of one segment, one by one; the lattice begins at ``shift``. ``best``: scores of a unigram model."""
        if start > stop:
            return
        first = lattice.first[start - shift:stop - shift + 2]
        edges = first[0]
        sizes, ids, first = lattice.sizes[edges:first[-1]].tolist(), lattice.ids[edges:first[-1]].tolist(), (first - edges).tolist()
        low = max(0, start - self.longest)
        if best is None:
            own = last[low:start].tolist()
            for k, end in enumerate(range(start, stop + 1)):
                for e in range(first[k], first[k + 1]):
                    if self.may_follow(own[end - sizes[e] - low], ids[e]):
                        own.append(ids[e])
                        back[end] = sizes[e]
                        break
                else:
                    own.append(-1)
            last[start:stop + 1] = own[start - low:]
            return
        own = best[low:start].tolist()
        for k, end in enumerate(range(start, stop + 1)):
            found = (float("-inf"), -1, 1)  # of equal sums the earliest start wins
            for e in range(first[k], first[k + 1]):
                score = own[end - sizes[e] - low] + self.v.scores[ids[e]]
                if score > found[0]:
                    found = (score, ids[e], sizes[e])
            if (first[k] == first[k + 1] or sizes[first[k + 1] - 1] > 1) and own[-1] + self.penalty > found[0]:
                found = (own[-1] + self.penalty, -1, 1)
            own.append(found[0])
            last[end], back[end] = found[1:]
        best[start:stop + 1] = own[start - low:]

    def _index(self) -> None:
        """Ids of the segments that are new."""
        new = self.numbers.take()
        if not new:
            return
        ids, stops = self.segments(new)
        if len(self.bytes) < 256:  # neighbouring unknown characters are one piece; segments are whole texts here
            twice = np.concatenate(([False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)))
            twice[stops[:-1][stops[:-1] < len(ids)]] = False
            ids, stops = ids[~twice], stops - np.concatenate(([0], np.cumsum(twice)))[stops]
        size = len(self.store)
        self.store = np.concatenate((self.store, ids))
        self.starts = np.concatenate((self.starts, size + np.concatenate(([0], stops[:-1]))))
        self.stops = np.concatenate((self.stops, size + stops))
        self.uses = np.concatenate((self.uses, np.zeros(len(stops), np.int64)))

    def _gather(self, order: array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments in ``order``, and how many are before each."""
        self._index()
        order = np.frombuffer(order, np.int32)
        if not len(order):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.uses += np.bincount(order, minlength=len(self.uses))
        sizes = (self.stops - self.starts)[order]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.empty(upto[-1], np.int32)
        for a in range(0, len(order), GROUP):
            b = min(len(order), a + GROUP)
            take = np.arange(upto[a], upto[b]) + np.repeat(self.starts[order[a:b]] - upto[a:b], sizes[a:b])
            ids[upto[a]:upto[b]] = self.store[take]
        if self.numbers.size > STORE:
            self._forget()
        return ids, upto

    def _forget(self) -> None:
        """Keep the segments that came up most often, half a store of them at most."""
        names = list(self.numbers)
        by_use = np.argsort(-self.uses, kind="stable")
        lengths = np.fromiter(map(len, names), np.int64, len(names))[by_use]
        kept = np.sort(by_use[(np.cumsum(lengths) <= STORE // 2) & (self.uses[by_use] > 1)])
        sizes = (self.stops - self.starts)[kept]
        stops = np.cumsum(sizes)
        self.store = self.store[np.arange(int(sizes.sum())) + np.repeat(self.starts[kept] - (stops - sizes), sizes)]
        self.starts, self.stops, self.uses = stops - sizes, stops, self.uses[kept] // 2
        self.numbers = _Numbers(names[k] for k in kept.tolist())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids end."""
        parts, ends, total = [], [], 0
        order, marks = array("i"), []
        numbers = self.numbers

        def flush() -> None:
            nonlocal order, marks, total, numbers
            ids, upto = self._gather(order)
            ends.extend((total + upto[marks]).tolist())
            parts.append(ids)
            total += len(ids)
            order, marks, numbers = array("i"), [], self.numbers

        for t in texts:
            own = ((SPACE if self.v.dummy_prefix else "") + t).replace(" ", SPACE) if t else ""
            if len(own) < GROUP // 2:
                order.extend([numbers[s] for s in self.segment.findall(own)])
            else:
                for found in self.segment.finditer(own):
                    order.append(numbers[found.group()])
                    if numbers.new_size >= GROUP or len(order) >= GROUP:
                        flush()
            marks.append(len(order))
            if numbers.new_size >= GROUP or len(order) >= GROUP:
                flush()
        flush()
        return np.concatenate(parts), np.array(ends, np.int64)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ids."""
        sizes = (self.part_ends - self.part_starts)[ids]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        data = bytearray()
        for a in range(0, len(ids), GROUP):
            b = min(len(ids), a + GROUP)
            take = np.arange(upto[a], upto[b]) + np.repeat(self.part_starts[ids[a:b]] - upto[a:b], sizes[a:b])
            data += self.part_bytes[take].tobytes()
        stops = upto[ends].tolist()
        out = [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *stops[:-1]], stops)]
        return [t[1:] if self.v.dummy_prefix and t.startswith(" ") else t for t in out]


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows that are encoded together, by their bytes."""
    start, size = 0, 0
    for k, bytes_of_text in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        size += bytes_of_text
        if size >= TEXTS:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``ids`` and ``round_trip`` (whether decoding gives the text again, up to U+2581)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the model file
    kept = [c for c in docs.columns if c not in (text, "ids", "round_trip")]
    schema = "".join(f"`{c}` {t}, " for c, t in docs.dtypes if c in kept) + "ids array<int>, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(load(shared.value))
        for batch in batches:
            column = batch.column(len(kept))
            for start, stop in _groups(column):
                own = column.slice(start, stop - start).to_pylist()
                ids, ends = coder.encode(own)
                back = coder.decode(ids, ends)
                same = [None if t is None else b == t.replace(SPACE, " ") for t, b in zip(own, back)]
                offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32), mask=np.array([*[t is None for t in own], False]))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(start, stop - start) for k in range(len(kept))], lists, pa.array(same, pa.bool_())], names=[*kept, "ids", "round_trip"])

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with ``ids`` replaced by their ``text``; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c not in (ids, text)]
    schema = "".join(f"`{c}` {t}, " for c, t in rows.dtypes if c in kept) + f"`{text}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(load(shared.value))
        for batch in batches:
            lists = batch.column(len(kept))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            texts = pa.array(coder.decode(flat, np.cumsum(sizes)), pa.string(), mask=np.asarray(lists.is_null()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], texts], names=[*kept, text])

    return rows.select(*[F.col(f"`{c}`") for c in [*kept, ids]]).mapInArrow(run, schema)


def read_model(path: str) -> bytes:
    """A model file on the driver."""
    with open(path, "rb") as file:
        return file.read()
