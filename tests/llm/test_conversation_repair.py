import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import conversation_repair as q
from ledgermill.llm.queries import op11_conversation_repair

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    """The contract, row by row."""
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best_repair(rows):
    """All states of the grammar with the least (cost, audit, lines) each; the audits themselves are compared."""
    def better(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    # edits before the end of a row have equally many row edits, so they may be compared as they are
    table = {"0": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults(rows)):
        after = {}
        # an insertion and then a turn: kept apart from a turn without one, as "I" may only be compared together with what follows
        for state, (cost, audit, lines) in itertools.chain(table.items(), chains(table)):
            better(after, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += 3 * (fault == "truncated")
            nexts = {"0": "su", "s": "u", "u": "a", "a": "u"}[state]
            if role[:1] and role[:1] in nexts:
                better(after, role[:1], (cost, audit + "K", [*lines, f"{role}:{text}"]))
            name = "assistant" if state == "u" else "user"
            if role[:1] != name[0]:
                better(after, name[0], (cost + 3, audit + "R", [*lines, f"{name}:{text}"]))
        table = after
    ends = list(table.items()) + chains(table)
    return min((way for state, way in ends if state in "0a"), key=lambda w: w[:2])


def chains(table):
    """One to three insertions after each state."""
    out = []
    for state, (cost, audit, lines) in table.items():
        for _ in range(3):
            name = "assistant" if state == "u" else "user"
            state, cost, audit, lines = name[0], cost + 3, audit + "I", [*lines, f"{name}:"]
            out.append((state, (cost, audit, lines)))
    return out


def every_repair(rows):
    """All edit strings of a few rows, by enumeration."""
    found = []
    flaws = faults(rows)

    def go(i, roles, cost, audit, lines):
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit, lines))
        if audit.count("I") < len(rows) + 2:
            for name in ("user", "assistant"):
                go(i, roles + name[0], cost + 3, audit + "I", [*lines, f"{name}:"])
        if i < len(rows):
            role, text = rows[i][2:]
            go(i + 1, roles, cost + 4, audit + "D", lines)
            if flaws[i] not in ("blank", "duplicate"):
                more = cost + 3 * (flaws[i] == "truncated")
                go(i + 1, roles + role[:1], more, audit + "K", [*lines, f"{role}:{text}"])
                for name in ("user", "assistant"):
                    go(i + 1, roles + name[0], more + 3, audit + "R", [*lines, f"{name}:{text}"])

    go(0, "", 0, "", [])
    return min(found, key=lambda w: w[:2])


def expected(rows):
    damaged_rows, out = damage(rows), {}
    for conv in {r[0] for r in rows}:
        own = in_order([r for r in damaged_rows if r[0] == conv])
        turns = {r[1] for r in own} - {None}
        flaws = faults(own)
        cost, audit, lines = best_repair(own)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(flaws.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def some_rows(rng, n):
    roles = ["system"] * rng.randint(0, 1) + [rng.choice(["user", "assistant", "user", "assistant", "tool", "system"]) for _ in range(n)]
    return [(1, k, r, rng.choice(["a.", "b?", "cut", " ", f"text {k}.", f"text {k}.", f"text {k}."])) for k, r in enumerate(roles)][:n]


def test_brute_forces_agree():
    rng = random.Random(2)
    for _ in range(60):
        rows = some_rows(rng, rng.randint(0, 3))
        assert best_repair(rows) == every_repair(rows)


@pytest.mark.parametrize("length", [0, 1, 2, 3, 5, 8, 40])
def test_alignment_equals_brute_force(length):
    rng = random.Random(length)
    for _ in range(150 if length < 40 else 20):
        rows = some_rows(rng, length)
        letters = "".join(q._Turn(t, r, x, f[:1]).letter() for (_, t, r, x), f in zip(rows, faults(rows)))
        cost, audit = q.align(letters, True)["0", "a"]
        want = best_repair(rows)
        assert (cost, audit) == want[:2]
        edits = q.apply_audit(audit, "0", [r[2:] for r in rows])
        assert [f"{r}:{t}" for e, r, t in edits if e != "D"] == want[2]


def conversations(rng):
    rows = []
    for conv in [None, *range(60)]:
        n = 700 if conv == 7 else 300 if conv == 9 else rng.choice([1, 2, 3, 6, 8])
        for k, (_, turn, role, text) in enumerate(some_rows(rng, n)):
            turn = None if rng.random() < 0.03 else turn + (5 if k > 4 else 0)
            rows.append((conv, turn, None if rng.random() < 0.03 else role, None if rng.random() < 0.03 else text))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    return rows + [(100, 3, "", "x."), (101, None, "user", "z" * 300_000), (102, 1, "user", ""), (103, 1, "üser", "ü.\n"), (103, 1, "user", "ä!")]


def test_query(spark, folder):
    rows = conversations(random.Random(5))
    lost = [(c, 0, "user", "gone.") for c in range(1000, 1100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows += lost
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("clash")).withColumn("conv", F.lit(1))
    docs.repartition(5).write.parquet(f"{folder}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in op11_conversation_repair(spark, folder).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    want = expected(rows)
    assert got == want
    assert want[lost[0][0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns_and_empty_table(spark):
    rows = [(1, 0, "system", "Hi."), (1, 1, "assistant", "Yes."), (1, 2, "user", "")]
    summaries, turns = q.repair(spark.createDataFrame(rows, SCHEMA))
    assert [(r.cost, r.audit) for r in summaries.collect()] == [(7, "KIKD")]
    assert [[tuple(t) for t in r.turns] for r in turns.collect()] == [[("K", "system", "Hi."), ("I", "user", ""), ("K", "assistant", "Yes."), ("D", "user", "")]]
    none = spark.createDataFrame([], SCHEMA)
    summaries, turns = q.repair(none)
    assert summaries.count() == 0 and turns.count() == 0 and q.digests(turns).count() == 0 and q.damaged(none).count() == 0
