import random

import pytest
import sentencepiece

import corpus_pipeline as p
from ledgermill.llm.queries import PIECE_MODEL
from tests.llm.test_quality_rules import brute
from tests.llm.test_simhash import brute_fingerprint, brute_roots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def corpus(spark, folder):
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows = [(k, words(120), "en", f"s{k % 3}") for k in range(90)]
    rows += [(100 + k, rows[k][1] + " tail", "en", "s0") for k in range(10)] + [(200 + k, rows[0][1], "fr", "s9") for k in range(5)]
    rows += [(300 + k, " ".join(w + "###" for w in words(120).split()), "en", "s1") for k in range(30)]
    rows += [(400, None, None, None), (401, "", "en", "s1"), (402, "too short", "en", "s1"), (None, words(100), None, None)]
    rows += [(500, words(100) + " mail anna.b@x.example.com", "en", None)]
    rows = [(k, t, lang, s, None if t is None else len(t)) for k, t, lang, s in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 0 if 300 <= r[0] < 400 else 1, 0) for r in rows if r[0] is not None and r[0] % 2 == 0 and r[0] < 400]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs, rows


def test_stages_against_brute_force(spark, corpus):
    folder, docs, rows = corpus
    good = p.quality(spark, docs, folder)
    assert good.columns == docs.columns
    want = [r for r in rows if r[1] and brute(r[1])[0] >= 50 and "###" not in r[1]]
    assert sorted(good.collect(), key=str) == sorted(want, key=str)

    one = p.near_duplicates(spark, good.unionByName(good.where("doc_id = 5")), folder)
    named = [r for r in want if r[0] is not None]
    roots = brute_roots([brute_fingerprint(r[1]) for r in named], [r[0] for r in named], 3)
    stay = [r for r, root in zip(named, roots) if r[0] == root] + [r for r in want if r[0] is None]
    assert len(stay) < len(want) and sorted(one.collect(), key=str) == sorted(stay, key=str)

    clean = p.surrogates(spark, one, folder).collect()
    assert len(clean) == len(stay) and "anna.b" not in " ".join(r.text for r in clean)
    assert {r.doc_id: r.text for r in clean if r.doc_id != 500} == {r[0]: r[1] for r in stay if r[0] != 500}
    assert all(r.n_chars == len(r.text) for r in clean)

    mixed = p.mixing(spark, spark.createDataFrame(clean, SCHEMA), folder)
    assert sorted(mixed.collect(), key=str) == sorted(clean, key=str) and mixed.columns == docs.columns

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    out = p.tokens(spark, mixed, folder).collect()
    assert {r.doc_id: r.ids for r in out} == {r.doc_id: library.encode(r.text) for r in clean}


def test_texts_of_one_id_are_judged_apart(spark):
    rng = random.Random(12)
    a, b, c, d = (" ".join("".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 8))) for _ in range(120)) for _ in range(4))
    rows = [(3, a), (7, a), (7, b), (8, c), (8, d), (9, d), (10, None), (10, ""), (10, " "), (None, c)]
    docs = spark.createDataFrame([(k, t, "en", f"s{n % 2}", n) for n, (k, t) in enumerate([*rows, (8, c)])], SCHEMA)
    out = p.near_duplicates(spark, docs, "")
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    blank = [x for x in got if x[0] == 10]
    assert len(blank) == 1 and not (blank[0][1] or "").strip()  # texts without words are near-duplicates of each other
    assert [x for x in got if x[0] != 10] == sorted([(3, a), (7, b), (8, c), (8, d), (None, c)], key=str)
    assert out.columns == docs.columns and {r.n_chars for r in out.where("doc_id = 8").collect()} == {4, 10}


def test_run_equals_its_stages(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in p.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(p.run(spark, folder).collect(), key=str) == sorted(docs.collect(), key=str)


def test_empty(spark, corpus):
    folder, docs, _ = corpus
    docs = docs.limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
