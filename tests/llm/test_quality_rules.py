import random
import re

from pyspark.sql import functions as F

from ledgermill.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a a a a", "x\n\nx\nx ", "\x0b\x0ca\x1cb c", "é ß 日本 🎉", "# a|b <c>"]
    texts += ["".join(rng.choice("ab c\n\t#|é") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += [" ".join(rng.choice("abc") for _ in range(500)), " ".join(str(k % 700) for k in range(5000))]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in q.statistics(docs).collect()}
    assert got == {k: brute(t) for k, t in enumerate(texts)}


def corpus(n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(80)]
        if k % 4 == 0:
            words = [w + "###" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, 0 if k % 4 == 0 else 1))
    return rows, labels


def test_learns_a_threshold_and_keeps_the_rest(spark):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "short one"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows + extra, DOCS)
    table = spark.createDataFrame([*labels, (5000, 0), (1, None)], "doc_id long, quality int")
    out = q.judge(docs, table).collect()
    assert len(out) == len(rows) + len(extra)
    for r in out:
        want = r.doc_id < 1000 and r.doc_id % 4 != 0
        assert r.kept == want, r
        assert r.base_failed == (r.doc_id >= 1000)
    assert any("symbol_share" in (r.rule or "") for r in out)


def test_filter_keeps_columns_even_with_names_of_its_own(spark):
    rows, labels = corpus(80)
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("own")).withColumn("_w", F.lit(1)).withColumn("kept", F.lit(True))
    out = q.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert out.columns == docs.columns and out.count() == 60
    assert {r.n_words for r in out.collect()} == {"own"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert q.judge(none, labels).count() == 0
    assert q.keep_good(spark.createDataFrame(corpus(8)[0], DOCS), labels).count() == 8
