"""Conversation structure repair by Wagner-Fischer alignment with target strings.

The turns of a conversation are aligned with every feasible length of the alternating grammar string ``(s?(ua)+)?``
(initials of system, user, assistant). Targets that end alike are suffixes of one another, so one table of suffix costs serves
all lengths. A greedy repair is the first incumbent; its cost gives an Ukkonen band around the number of turns left, and
cells outside cannot belong to a repair as cheap. Of all lengths of least cost the backtraced audits are compared.

Edits: keep (K, 0), relabel to user or assistant (R, 3), delete (D, 4), insert an empty turn (I, 3). Blank and repeated turns must be
deleted; a truncated turn that stays costs 3 more. The audit is the string of edits; ties go to the ASCII-least one.

Scale: turns are dealt by ranges of (conversation, turn), so a conversation of any size is spread over tasks and one task holds
many small ones. Conversations inside one range of at most ``BLOCK`` turns are aligned at once. Longer or torn ones are
aligned block by block, for every state of the grammar before and after a block; a fold over the blocks then joins cost and audit per state.
Insertions belong to the turn after them, so no audit of a block is a prefix of another one of it, and the least audit of the whole is made of least
audits of blocks. Repeated turns are found by digests (aggregated, then joined without texts) and travel as marker rows next to their turns.

Defined results: a null role or text counts as one space (an illegal role, a blank turn). Null conversation ids form one conversation; null turns come first.
Rows of one turn are ordered by role and text. An empty table gives empty results; columns other than the four are left out.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import BLANKS, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 256  # turns aligned at once
NEVER = 1 << 60
NAMES = {"u": "user", "a": "assistant"}
#: Insertions that end a conversation after each state of the grammar (0: nothing yet, else the last initial).
CLOSING = {"0": "", "a": "", "u": "I", "s": "II"}
COUNTS = ("n_turns", "blank", "duplicate", "truncated", "illegal", "n_distinct")
COUNT_FIELDS = "".join(f", {c} long" for c in COUNTS) + ", low long, high long"


def _symbol(end: str, left: int) -> str:
    """The symbol with ``left`` symbols to come, itself included, of the alternating string that ends in ``end``."""
    return end if left % 2 else "ua"[end == "u"]


class Alignment:
    """Suffix costs of ``rows`` against the alternating string that ends in ``end``, within the band.

    ``rows`` has one character a turn: its initial (``o``: any other), upper-case if truncated, or ``x`` if it must go. Without
    ``closing``, nothing may be inserted after the last turn.
    """

    def __init__(self, rows: str, end: str, closing: bool):
        self.rows, self.end, self.closing = rows, end, closing
        slack = _slack(rows)
        cut = sum(r.isupper() for r in rows)
        most_deleted = min(slack, cut) + max(0, slack - cut) // DELETE  # a truncated turn costs 1 more to delete than to keep
        left = 0
        self.low, self.costs = [0] * (len(rows) + 1), [[]] * (len(rows) + 1)
        for i in range(len(rows), -1, -1):
            if i < len(rows):
                left += rows[i] != "x"
            self.low[i] = max(0, left - most_deleted)
            high = left + slack // INSERT if closing or i < len(rows) else 0
            self.costs[i] = self._row(i, self.low[i], high)

    def _row(self, i: int, low: int, high: int) -> list[int]:
        if i == len(self.rows):
            return [INSERT * k for k in range(low, high + 1)]
        row, out, before = self.rows[i], [], NEVER
        stays = TRUNCATED if row.isupper() else 0
        initial = row.lower()
        for k in range(low, high + 1):
            best = min(self.at(i + 1, k) + DELETE, before + INSERT)
            if k and row != "x":
                best = min(best, self.at(i + 1, k - 1) + stays + (0 if initial == _symbol(self.end, k) else RELABEL))
            out.append(best)
            before = best
        return out

    def at(self, i: int, k: int) -> int:
        """Cost of making the last ``k`` symbols of rows i and after."""
        k -= self.low[i]
        return self.costs[i][k] if 0 <= k < len(self.costs[i]) else NEVER

    def audit(self, i: int, k: int) -> str:
        """The ASCII-least cheapest edits from there on (D < I < K < R)."""
        out = []
        while i < len(self.rows) or k:
            cost = self.at(i, k)
            if i < len(self.rows) and self.at(i + 1, k) + DELETE == cost:
                out.append("D")
                i += 1
            elif k and self.at(i, k - 1) + INSERT == cost:
                out.append("I")
                k -= 1
            else:
                out.append("K" if self.rows[i].lower() == _symbol(self.end, k) else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _slack(rows: str) -> int:
    """How much the incumbent, a greedy repair, costs beyond what no repair can save; enough for any states before and after."""
    expected, extra = "u", 0
    for row in rows.lower():
        if row in NAMES:
            extra += row != expected  # insert the missing turn
            expected = "ua"[row == "u"]
        elif row != "x":
            extra += 1  # relabel
            expected = "ua"[expected == "u"]
    return RELABEL * extra + 3 * INSERT


def _least(found: dict[tuple[str, str], tuple[int, str]], key: tuple[str, str], cost: int, audit) -> None:
    if cost < NEVER:
        old = found.get(key)
        if old is None or cost < old[0]:
            found[key] = (cost, audit())
        elif cost == old[0]:
            found[key] = min(old, (cost, audit()))


@lru_cache(maxsize=20_000)
def align(rows: str, whole: bool) -> dict[tuple[str, str], tuple[int, str]]:
    """(cost, audit) from each state to each state; of a ``whole`` conversation only ("0", "a"), its end."""
    found: dict[tuple[str, str], tuple[int, str]] = {}
    systems = [i for i, r in enumerate(rows) if r in "sS"]
    for end in "a" if whole else "au":
        table = Alignment(rows, end, whole)
        lengths = range(table.low[0], table.low[0] + len(table.costs[0]))
        for state in "0" if whole else "0sua":
            first = "a" if state == "u" else "u"
            for k in lengths:
                if k and _symbol(end, k) == first:
                    _least(found, (state, end), table.at(0, k), lambda k=k, t=table: t.audit(0, k))
        for i in systems:  # the target starts with a system turn, which only keeping one gives
            stays = TRUNCATED if rows[i].isupper() else 0
            for k in range(max(1, table.low[i + 1]), table.low[i + 1] + len(table.costs[i + 1])):
                if _symbol(end, k) == "u":
                    _least(found, ("0", end), DELETE * i + stays + table.at(i + 1, k), lambda i=i, k=k, t=table: "D" * i + "K" + t.audit(i + 1, k))
    gone = DELETE * len(rows), "D" * len(rows)
    for state in "0" if whole else "0sua":  # the target of length 0
        _least(found, (state, "a" if whole else state), gone[0], lambda: gone[1])
    if not whole:
        for i in systems:
            _least(found, ("0", "s"), gone[0] - DELETE + (TRUNCATED if rows[i].isupper() else 0), lambda i=i: "D" * i + "K" + "D" * (len(rows) - i - 1))
    return found


def apply_audit(audit: str, state: str, turns: Iterable[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """The audited turns (edit, role, text), deleted ones included, starting in ``state``."""
    out, turns = [], iter(turns)
    for edit in audit:
        expected = "a" if state == "u" else "u"
        role, text = (NAMES[expected], "") if edit == "I" else next(turns)
        if edit == "R":
            role = NAMES[expected]
        if edit != "D":
            state = role[:1]
        out.append((edit, role, text))
    return out


@dataclass
class _Turn:
    turn: int | None
    role: str
    text: str
    fault: str  # b, d, t or nothing

    def letter(self) -> str:
        if self.fault in ("b", "d"):
            return "x"
        initial = self.role[:1] if self.role[:1] in ("s", "u", "a") else "o"
        return initial.upper() if self.fault == "t" else initial


def _counts(turns: list[_Turn]) -> dict:
    known = [t.turn for t in turns if t.turn is not None]
    pairs = zip(turns, turns[1:])
    return {
        "n_turns": len(turns), "blank": sum(t.fault == "b" for t in turns), "duplicate": sum(t.fault == "d" for t in turns),
        "truncated": sum(t.fault == "t" for t in turns), "illegal": sum(a.role[:1] + b.role[:1] not in ("su", "ua", "au") for a, b in pairs),
        "n_distinct": len(set(known)), "low": known[0] if known else None, "high": known[-1] if known else None,
    }


def _together(a: dict, b: dict, illegal: bool) -> dict:
    """Counts of neighbouring blocks; ``illegal``: whether the turns at the border may not follow each other."""
    out = {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += illegal
    out["n_distinct"] -= a["high"] is not None and a["high"] == b["low"]
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    return out


def _emit(rows: Iterator[dict], schema: pa.Schema, column: str) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size; ``column`` counts."""
    ready, size = [], 0
    for row in rows:
        ready.append(row)
        size += 50 + sum(len(t["text"]) + 30 for t in row.get(column) or ())
        if size > 4 << 20:
            yield pa.RecordBatch.from_pylist(ready, schema)
            ready, size = [], 0
    if ready:
        yield pa.RecordBatch.from_pylist(ready, schema)


def _pieces(rows: Iterator[tuple], part: int) -> Iterator[dict]:
    """Pieces of a range of sorted rows (conversation, turn, is a turn, role, text, digest)."""
    number, turns, open_before, size = 0, [], True, 0
    conv, seen_at, seen = None, None, set()  # open_before: turns of the conversation may lie before
    first = True

    def piece(open_after: bool) -> dict:
        nonlocal number
        number += 1
        letters = "".join(t.letter() for t in turns)
        out = {"conv": conv, "part": part, "piece": number, "whole": not (open_before or open_after), **_counts(turns), "first": turns[0].role[:1], "last": turns[-1].role[:1]}
        if out["whole"]:
            cost, audit = align(letters, True)["0", "a"]
            edits = apply_audit(audit, "0", [(t.role, t.text) for t in turns])
            return out | {"cost": cost, "audit": audit, "turns": [{"edit": e, "role": r, "text": t} for e, r, t in edits]}
        options = [{"before": a, "after": b, "cost": c, "audit": w} for (a, b), (c, w) in align(letters, False).items()]
        return out | {"options": options, "turns": [{"edit": None, "role": t.role, "text": t.text} for t in turns]}

    for own, turn, is_turn, role, text, digest in rows:
        if first or own != conv:
            if turns:
                yield piece(False)
            conv, turns, size, open_before, seen_at, first = own, [], 0, first, None, False
        if seen_at != (turn,):
            seen_at, seen = (turn,), set()
        if not is_turn:
            seen.add(digest)
            continue
        if len(turns) == BLOCK or size > 4 << 20:
            yield piece(True)
            turns, size, open_before = [], 0, True
        body = text.rstrip(BLANKS)
        fault = "b" if not body else "d" if digest in seen else "t" if body[-1] not in ".!?" else ""
        seen.add(digest)
        turns.append(_Turn(turn, role, text, fault))
        size += len(text)
    if turns:
        yield piece(True)


def _fold(pieces: Iterator[dict]) -> Iterator[dict]:
    """For each conversation in sorted pieces: the chosen edits of every piece, and a summary (piece 0)."""
    chain: list[tuple] = []

    def finish(conv) -> Iterator[dict]:
        cost, _, state = min((cost + INSERT * len(CLOSING[s]), rank, s) for s, (cost, rank) in states.items())
        audits, closing = [], CLOSING[state]
        for part, number, steps in reversed(chain):
            before, audit = steps[state]
            audits.append((part, number, before, audit + (closing if not audits else "")))
            state = before
        for part, number, before, audit in audits:
            yield {"conv": conv, "part": part, "piece": number, "before": before, "audit": audit}
        yield {"conv": conv, "part": 0, "piece": 0, "audit": "".join(a[3] for a in reversed(audits)), "cost": cost, **counts}

    conv, last, states, counts = None, "", {}, {}
    for p in pieces:
        if chain and p["conv"] != conv:
            yield from finish(conv)
            chain = []
        if not chain:
            conv, states, counts = p["conv"], {"0": (0, 0)}, {c: p[c] for c in (*COUNTS, "low", "high")}
        else:
            counts = _together(counts, p, last + p["first"] not in ("su", "ua", "au"))
        last = p["last"]
        best: dict[str, tuple] = {}
        for o in p["options"]:
            if o["before"] in states:
                cost, rank = states[o["before"]]
                way = (cost + o["cost"], rank, o["audit"], o["before"])
                best[o["after"]] = min(best.get(o["after"], way), way)
        order = sorted((rank, audit, state) for state, (_, rank, audit, _) in best.items())
        states = {state: (best[state][0], k) for k, (_, _, state) in enumerate(order)}
        chain.append((p["part"], p["piece"], {state: (way[3], way[2]) for state, way in best.items()}))
    if chain:
        yield from finish(conv)


TURNS = "array<struct<edit string, role string, text string>>"
OPTIONS = "array<struct<before string, after string, cost long, audit string>>"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # few Python rows at once
            yield from batch.slice(at, 256).to_pylist()


def _schema(fields: str, like: DataFrame, conv: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = f"conv {dict(like.dtypes)[conv]}, {fields}"
    return schema, to_arrow_schema(StructType.fromDDL(schema))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(summaries, turns) of all conversations that have rows.

    Summaries have one row a conversation: ``conv``, the counts, ``low`` and ``high`` turn, ``cost`` and ``audit``. Turns are pieces
    (``conv, part, piece, whole, turns``) in order of (part, piece): arrays of (edit, role, text) with the deleted ones marked D.
    """
    one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), one_space(role).alias("role"), one_space(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text").cast("binary"), 256)))
    # where a digest came up in an earlier turn: rows without texts, one a turn
    at = rows.groupBy("conv", "digest", "turn").agg(F.count(F.lit(1)).alias("n"))
    first = at.groupBy("conv", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("conv").alias("_c"), F.col("digest").alias("_d"), F.col("first.turn").alias("_t"))
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d"))
    again = at.join(first, same).where(~F.col("turn").eqNullSafe(F.col("_t")))
    none = F.lit(None).cast("string")
    markers = again.select("conv", "turn", F.lit(False).alias("is_turn"), none.alias("role"), none.alias("text"), "digest")
    both = rows.select("conv", "turn", F.lit(True).alias("is_turn"), "role", "text", "digest").unionByName(markers)
    ranges = both.repartitionByRange("conv", "turn").sortWithinPartitions("conv", "turn", "is_turn", "role", "text")

    counts = "part long, piece long, whole boolean" + COUNT_FIELDS + ", first string, last string"
    schema, arrow = _schema(f"{counts}, cost long, audit string, options {OPTIONS}, turns {TURNS}", rows, "conv")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own = (tuple(r.values()) for r in _rows(batches))
        return _emit(_pieces(own, part), arrow, "turns")

    pieces = stage(ranges.mapInArrow(cut, schema), "conversation-pieces")

    chosen_schema, chosen_arrow = _schema(f"part long, piece long, before string, audit string, cost long{COUNT_FIELDS}", rows, "conv")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emit(_fold(_rows(batches)), chosen_arrow, "")

    torn = pieces.where(~F.col("whole"))
    in_order = torn.drop("turns").repartition("conv").sortWithinPartitions("conv", "part", "piece")
    chosen = stage(in_order.mapInArrow(fold, chosen_schema), "conversation-choices")
    result = ["conv", *COUNTS, "low", "high", "cost", "audit"]
    summaries = pieces.where("whole").select(*result).unionByName(chosen.where("piece = 0").select(*result))

    turns_schema, turns_arrow = _schema(f"part long, piece long, whole boolean, turns {TURNS}", rows, "conv")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def audited() -> Iterator[dict]:
            for r in _rows(batches):
                edits = apply_audit(r["audit"], r["before"], [(t["role"], t["text"]) for t in r["turns"]])
                yield {"conv": r["conv"], "part": r["part"], "piece": r["piece"], "whole": False, "turns": [{"edit": e, "role": o, "text": t} for e, o, t in edits]}

        return _emit(audited(), turns_arrow, "turns")

    choice = chosen.where("piece > 0").select("part", "piece", "before", "audit")
    edited = torn.select("conv", "part", "piece", "turns").join(choice, ["part", "piece"]).select("conv", "part", "piece", "turns", "before", "audit")
    turns = pieces.where("whole").select("conv", "part", "piece", "whole", "turns").unionByName(edited.mapInArrow(edit, turns_schema))
    return summaries, turns


def _lines(turns: Column) -> Column:
    return F.transform(F.filter(turns, lambda t: t["edit"] != "D"), lambda t: F.concat(t["role"], F.lit(":"), t["text"]))


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired ``role:text`` lines, newline-joined. Pieces of torn conversations are hashed one after the other, as SHA-256 has to be."""
    whole = turns.where("whole").select("conv", F.sha2(F.concat_ws("\n", _lines(F.col("turns"))).cast("binary"), 256).alias("sha256"))
    schema, arrow = _schema("sha256 string", turns, "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[dict]:
            conv, state, any_line, any_row = None, hashlib.sha256(), False, False
            for r in _rows(batches):
                if any_row and r["conv"] != conv:
                    yield {"conv": conv, "sha256": state.hexdigest()}
                    state, any_line = hashlib.sha256(), False
                conv, any_row = r["conv"], True
                for line in r["lines"]:
                    state.update((("\n" if any_line else "") + line).encode("utf-8", "surrogatepass"))
                    any_line = True
            if any_row:
                yield {"conv": conv, "sha256": state.hexdigest()}

        return _emit(hashed(), arrow, "")

    torn = turns.where(~F.col("whole")).select("conv", "part", "piece", _lines(F.col("turns")).alias("lines"))
    return whole.unionByName(torn.repartition("conv").sortWithinPartitions("conv", "part", "piece").mapInArrow(run, schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` modulo 20: drop, empty, cut sentence ends, repeat, relabel; nulls read as one space."""
    one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(one_space("conv_id"), F.lit(":"), one_space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(one_space("text"), "[.!?]", "")).otherwise(one_space("text"))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(one_space("role")).alias("role"), text.alias("text"), kind.alias("_kind"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("_kind <> 0").select("conv_id", "turn", "role", "text", copies.alias("_copy")).drop("_copy")
