import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import phrase_mining as q
from ledgermill.llm.queries import op13_phrase_mining

SCHEMA = "doc_id long, text string, lang string"


def expected(rows, least, top, percent=80):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            own.update(tuple(words[i:i + k]) for i in range(len(words)) for k in range(1, 5) if i + k <= len(words))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(100 * b >= percent * a and any(o[i:i + len(p)] == p for i in range(len(o) - len(p) + 1)) for o, b in candidates.items() if len(o) > len(p)):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((lang, " ".join(p), a, f[p[:k]], f[p[k:]], totals[lang], score))
        found.sort(key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(x[0], rank, *x[1:]) for rank, x in enumerate(found[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def texts(rng, n=400):
    pool = ["the", "of", "é", "Zeta", "new york", "new york city", "in the long run", "x"] + [f"w{k}" for k in range(40)]
    make = lambda size: "".join(rng.choice(pool) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ! "]) for _ in range(size))
    rows = [(k, make(rng.randint(0, 60)), rng.choice(["en", "fr", None, "und"])) for k in range(n)]
    return rows + [(1, None, "en"), (2, "", None), (3, "only", "xx"), (4, make(30_000), "long"), (4, " . ; ", "en")] + [rows[0]] * 50


def test_equals_brute_force(spark):
    rows = texts(random.Random(1))
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).withColumn("words", F.lit(1)).withColumn("ids", F.lit(2))
    for least, top in ((5, 50), (30, 2000)):
        assert rows_of(q.mine(docs, least=least, top=top)) == expected(rows, least, top)
    assert len(expected(rows, 5, 50)) > 50


def test_bursts_and_spills_change_nothing(spark, monkeypatch):
    rows = texts(random.Random(2), 60)
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(q, "CHUNK", 257)
    monkeypatch.setattr(q.HatTrie.__init__, "__defaults__", (40, 3))
    assert rows_of(q.mine(docs, least=3, top=500)) == expected(rows, 3, 500)


def test_query(spark, folder):
    rows = texts(random.Random(3))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    assert rows_of(op13_phrase_mining(spark, folder)) == expected(rows, 30, 2000)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/none/documents.parquet")
    assert op13_phrase_mining(spark, f"{folder}/none").count() == 0


@pytest.mark.parametrize("depth", [2, 4])
def test_trie(depth):
    rng = np.random.default_rng(depth)
    trie, want, got = q.HatTrie(depth, entries=300, burst=10), Counter(), Counter()
    for _ in range(20):
        columns = [rng.integers(1, 12, 200).astype(np.uint64) << np.uint64(50) for _ in range(depth)]
        if depth == 4:
            columns[3][rng.random(200) < 0.3] = 0
        want.update(zip(*[c.tolist() for c in columns]))
        runs = list(trie.add(columns))
        assert trie.size <= 300
        for run in runs:
            got.update({tuple(w): n for *w, n in zip(*[c.tolist() for c in run])})
    for run in trie.spill(0):
        for *w, n in zip(*[c.tolist() for c in run]):
            got[tuple(w)] += n
    assert got == want and trie.size == 0 and not trie.root


def test_exact_above_64_bits(spark):
    phrases = spark.createDataFrame([([1, 2], 9 * 10**17), ([1], 10**18), ([2], 9 * 10**17 + 1)], "ids array<long>, n long")
    row = q._scored(phrases).first()
    assert row.score == 2000000 * 9 * 10**17 // (10**18 + 9 * 10**17 + 1)
