import random

import numpy as np
from pyspark.sql import functions as F

from ledgermill.llm import compression_quality as q
from ledgermill.llm.common import id_crc

DOCS = "doc_id long, text string"


def corpus(n=600):
    rng = random.Random(7)
    good, bad = (["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(200)] for letters in ("abcdefgh", "stuvwxyz"))
    rows = [(k, " ".join(rng.choice(bad if k % 5 == 0 else good) for _ in range(rng.randint(5, 200)))) for k in range(n)]
    return rows, [(k, 0 if k % 5 == 0 else 1) for k in range(n)]


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (1002, rows[1][1] * 500), (2, rows[2][1]), (None, rows[3][1])], DOCS)
    docs = docs.withColumn("score", F.lit("own")).withColumn("difference", F.lit(1))
    table = spark.createDataFrame([*labels, (3, None), (9999, 1)], "doc_id long, quality int")
    out = q.classify(docs, table, id_crc() % 3 == 1).collect()
    assert len(out) == len(rows) + 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 1000]
    assert [(r.held_out, r.predicted) for r in out if r.doc_id is None] == [(False, 1)]
    assert len(held) > 150 and sum(r.predicted == (r.doc_id % 5 != 0) for r in held) / len(held) > 0.97
    assert next(r for r in out if r.doc_id == 1002).predicted == 1


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, DOCS)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    wrong = table.withColumn("quality", F.when(id_crc() % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(q.classify(docs, t, id_crc() % 3 == 1).collect()) for t in (table, wrong))
    assert a == b


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame(corpus(20)[0], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.classify(docs, none, F.lit(False)).collect()} == {0.5}
    assert q.classify(docs.limit(0), none, F.lit(False)).count() == 0
    one = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, quality int")
    assert {r.predicted for r in q.classify(docs, one, F.lit(False)).collect()} == {1}


def rising_fit(y, w):
    """Isotonic regression by its min-max formula, on shares with half a row of either class added."""
    def share(a, b):
        return (sum(p * q for p, q in zip(y[a:b], w[a:b])) + 0.5) / (sum(w[a:b]) + 1)
    n = len(y)
    return [max(min(share(a, b) for b in range(k + 1, n + 1)) for a in range(k + 1)) for k in range(n)]


def test_curve_rises_and_is_the_best_rising_fit():
    rng = np.random.default_rng(3)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-3 * x))).astype(float)
    points, shares = q.isotonic(x, y, np.ones(400))
    assert (np.diff(points) > 0).all() and (np.diff(shares) > 0).all() and len(points) > 3
    grid = np.linspace(-9, 9, 5000)
    p = q.probability(grid, (points, shares))
    assert (np.diff(p) >= 0).all() and 0 < p.min() and p.max() < 1 and np.diff(p)[0] > 0
    weights = [2.0 ** (k % 3) * 1e6 for k in range(8)]  # so heavy that the added half rows do not matter
    marks = [0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0, 1.0]
    points, shares = q.isotonic(np.arange(8.0), np.array(marks), np.array(weights), least=1)
    assert sorted(set(np.round(rising_fit(marks, weights), 4))) == sorted(set(np.round(shares, 4)))
    ties = q.isotonic(np.zeros(50), np.array([0.0, 1.0] * 25), np.ones(50))
    assert len(ties[0]) == 1 and abs(ties[1][0] - 0.5) < 1e-9 and (q.probability(np.zeros(3), ties) == ties[1][0]).all()


def test_scores_are_shares(spark):
    """Of held-out texts with score about p a share of about p is good, whatever the classes' shares in the fit."""
    rng = random.Random(11)
    good, bad = (["".join(rng.choice(letters) for _ in range(4)) for _ in range(200)] for letters in ("abcdefgh", "stuvwxyz"))
    rows, labels = [], []
    for k in range(6000):
        part = rng.random()
        rows.append((k, " ".join(rng.choice(good if rng.random() < part else bad) for _ in range(30))))
        labels.append((k, int(rng.random() < part ** 0.5)))
    docs, table = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")
    marks = dict(labels)
    held = [(r.score, marks[r.doc_id]) for r in q.classify(docs, table, id_crc() % 3 == 1, class_rows=1200).collect() if r.held_out]
    assert abs(sum(s - y for s, y in held)) / len(held) < 0.04
    bins = {}
    for s, y in held:
        bins.setdefault(int(s * 5), []).append((s, y))
    assert sum(abs(sum(s - y for s, y in b)) for b in bins.values()) / len(held) < 0.05 and len(bins) >= 3
