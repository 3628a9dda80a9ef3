import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgermill.llm import ppm_langid as q
from ledgermill.llm.common import id_crc

DOCS = "doc_id long, text string, lang string"


def brute_bits(samples, text):
    """Code length by the definition, one language."""
    seen = [Counter() for _ in range(q.ORDER + 2)]
    for t in samples:
        t = q.padded(t)
        for i in range(q.ORDER, len(t)):
            for k in range(q.ORDER + 1):
                seen[k][t[i - k:i], t[i]] += 1
    contexts = [{} for _ in range(q.ORDER + 1)]
    for k in range(q.ORDER + 1):
        for (c, _), n in seen[k].items():
            total, different = contexts[k].get(c, (0, 0))
            contexts[k][c] = (total + n, different + 1)
    bits, t = 0.0, q.padded(text)
    for i in range(q.ORDER, len(t)):
        for k in range(q.ORDER, -1, -1):
            c = t[i - k:i]
            if c not in contexts[k]:
                continue
            n, d = contexts[k][c]
            if (c, t[i]) in seen[k]:
                bits -= math.log2(seen[k][c, t[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_code_lengths_equal_the_definition(monkeypatch):
    rng = random.Random(0)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n)).encode()
    samples = [[draw("abc ", 200), draw("abc", 3), b""], [draw("abé ", 150)], [draw("xyz", 80), b"q"]]
    texts = [b"a", draw("abc ", 50), draw("xyzé", 120), draw("日q", 30), draw("abcxyz ", 500)]
    tables = q.Tables.count(samples)
    want = np.array([[brute_bits(s, t) for s in samples] for t in texts])
    assert np.allclose(tables.lengths(texts), want)
    monkeypatch.setattr(q, "WINDOW", 37)  # whole texts, whatever the window
    assert np.allclose(tables.lengths(texts), want)


def corpus(n=400):
    rng = random.Random(3)
    kinds = {"aa": "the and of with that".split(), "bb": "der und die mit das für".split(), "cc": "el los que con día".split()}
    return [(k, " ".join(rng.choice(kinds[lang]) for _ in range(rng.randint(1, 60))), lang) for k in range(n) for lang in [sorted(kinds)[k % 3]]]


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus()
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 ... !", "aa"), (1003, "und die " * 100_000, None), (5, rows[5][1], rows[5][2]), (1004, "日本語", None), (None, "und die mit", "aa")]
    docs = spark.createDataFrame(rows + odd, DOCS).withColumn("score", F.lit("x"))
    out = q.identify(docs, id_crc() % 4 == 2).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 1000]
    assert len(held) > 60 and all(r.lang_pred == ["aa", "bb", "cc"][r.doc_id % 3] for r in held)
    assert [(r.held_out, r.lang_pred) for r in out if r.doc_id is None] == [(False, "bb")]
    by_id = {r.doc_id: r for r in out}
    assert [by_id[k].lang_pred for k in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "bb"]
    assert by_id[1000].score == 0 and by_id[1004].lang_pred in ("aa", "bb", "cc")


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], DOCS)
    assert [(r.lang_pred, r.score) for r in q.identify(docs, F.lit(False)).collect()] == [("und", 0.0)]
    assert q.identify(docs.limit(0), F.lit(False)).count() == 0
