import random
import re

from pyspark.sql import functions as F

from ledgermill.llm import license_scan as q
from ledgermill.llm.queries import op12_license_scan

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(text, block_words=q.BLOCK_WORDS):
    own = words(text)
    places = [(i, label) for p, label in q.PHRASES for i in range(len(own)) if own[i:i + len(words(p))] == words(p)]
    met = []
    for start in range(0, len(own), block_words // 2):
        block = set(own[start:start + block_words])
        for t, label in q.TEMPLATES:
            share = len(block & set(words(t))) / len(set(words(t)))
            if 100 * len(block & set(words(t))) >= q.PERCENT * len(set(words(t))):
                met.append((share, label))
    at = [i for i, _ in places]
    join = lambda labels: ",".join(sorted(set(labels)))
    base = {label for _, label in places}
    return (
        len(own), len(places), min(at, default=None), max(at, default=None), join(base), join(base | {label for _, label in met}),
        1.0 if places else max((s for s, _ in met), default=0.0))


def texts(rng):
    pool = [w for t, _ in q.TEMPLATES for w in words(t)]
    out = [
        None, "", " .,!", "MIT License", "mit-license MIT LICENSE, mit license", "Ünder the mit license", "licensed under cc by-nc 4.0.", "cc by cc by cc", "GNU  General\nPublic/License",
        "x " * 5000 + "Released under the Apache-License" + " y" * 5000, "under license the mit", "released under mit the license", "İ mit\0license \U0001f600license",
    ]
    for t, _ in q.TEMPLATES:
        own = t.split(" ")
        for _ in range(6):
            kept = [w for w in own if rng.random() < 0.85]
            if rng.random() < 0.5:
                rng.shuffle(kept)
            noise = lambda: " ".join(rng.choice(pool + ["lorem", "ipsum", "λ"] * 20) for _ in range(rng.randint(0, 150)))
            out.append(f"{noise()}\n{' '.join(kept)}. {noise()}")
    return out


def rows_of(df):
    return sorted(((r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, folder):
    own = texts(random.Random(3))
    rows = list(enumerate(own)) + [(3, own[3]), (3, own[4]), (None, own[6])] + [(1000 + k, "released under the mit license") for k in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("labels", F.lit(1)).withColumn("n_words", F.lit("x"))
    docs.write.parquet(f"{folder}/documents.parquet")
    want = sorted(((k, (*expected(t)[:6], round(expected(t)[6], 9))) for k, t in rows), key=str)
    assert rows_of(op12_license_scan(spark, folder)) == want
    assert {label for r in want for label in r[1][5].split(",")} >= {"", "bsd", "mit", "apache", "cc-by", "cc0"}  # with labels that only the method gives


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "mit license")], SCHEMA).withColumn("_id", F.lit("x")).withColumn("words", F.lit("y")).withColumn("_n", F.lit(0))
    assert rows_of(q.scan(docs)) == [(1, (2, 1, 0, 0, "mit", "mit", 1.0))]
    assert q.scan(docs.limit(0)).count() == 0


def test_blocks(spark):
    template = [("alpha beta gamma delta epsilon", "greek")]
    text = "x " * 31 + "beta alpha delta x gamma " + "z " * 40
    docs = spark.createDataFrame([("k", words(text))], "key string, words array<string>")
    ranked = q.Templates(template, {"alpha": 9, "beta": 1, "gamma": 1, "delta": 3, "epsilon": 0}, 80)
    assert ranked.words[0] == ["epsilon", "beta", "gamma", "delta", "alpha"]
    found = q.blocks_found(docs, ranked)
    assert [(r.start, r.label, r.containment) for r in found.collect()] == [(0, "greek", 0.8)]


def test_only_phrases_or_templates(spark):
    docs = spark.createDataFrame([(1, "mit license"), (2, "released under the mit license")], SCHEMA)
    assert [r[1][5] for r in rows_of(q.scan(docs, templates=()))] == ["mit", "mit"]
    assert [(r[1][1], r[1][5]) for r in rows_of(q.scan(docs, phrases=()))] == [(0, ""), (0, "mit")]
