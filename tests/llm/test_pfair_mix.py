import hashlib
import time

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import pfair_mix as q
from ledgermill.llm.common import number_rows

DOCS = "doc_id long, source string, text string"


def edf(parts):
    """Earliest deadline first by the definition."""
    period, done, out = sum(parts), [0] * len(parts), []
    for t in range(period):
        ready = [(-(-(d + 1) * period // a), k) for k, (d, a) in enumerate(zip(done, parts)) if d * period // a <= t]
        k = min(ready)[1]
        out.append((k, done[k], t, list(done)))
        done[k] += 1
    return sorted(out)


def test_schedule_equals_the_definition_and_stays_within_a_block(spark):
    for parts in ([1], [3, 2], [7, 5, 3, 1], [1, 1, 1, 1], [50, 30, 19, 1], [13, 11, 29, 3, 3, 5]):
        got = sorted((r.sid, r.nth, r.slot) for r in q.schedule(spark, parts).collect())
        want = edf(parts)
        assert got == [x[:3] for x in want]
        for k, _, slot, before in want:
            after = [b + (i == k) for i, b in enumerate(before)]
            assert all(abs(n * sum(parts) - (slot + 1) * a) < sum(parts) for n, a in zip(after, parts))


def test_many_sources_take_seconds(spark):
    """The schedule is linear in sources (up to a logarithm)."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('s', id % 10000) AS source", "'t' AS text")
    begin = time.time()
    assert q.mix(docs, block_rows=1).agg(F.count_distinct("slot")).head()[0] == 20_000
    assert time.time() - begin < 20


def placed(spark, docs, *how, folder, **more):
    path = f"{folder}/mixed"
    q.lay_out(q.mix(docs, *how, **more)).write.parquet(path)
    return sorted(q.positions(spark.read.parquet(path)).collect(), key=lambda r: r.position)


def test_positions_over_many_spans(spark, folder, monkeypatch):
    monkeypatch.setattr(q, "SPAN", 4)
    monkeypatch.setattr(q, "COUNTS", 8)
    out = placed(spark, spark.createDataFrame(rows(), DOCS), {"a": 5.0, "b": 1.0}, folder=folder, block_rows=3, period=20)
    assert [r.position for r in out] == list(range(len(rows())))
    assert [(r.slot, r.block_row) for r in out] == sorted((r.slot, r.block_row) for r in out)


def test_shares():
    assert q.shares([1, 1, 1], 10) in ([4, 3, 3],) and q.shares([1e9, 1], 10) == [9, 1] and sum(q.shares([3, 1, 4, 1, 5], 97)) == 97


def rows():
    return [(k, ["a", "b", None, "c"][min(k % 7, 3)], "t") for k in range(3000)] + [(5, "a", "t"), (5, "a", "t"), (None, "b", "t")]


def test_positions_blocks_and_deviation(spark, folder):
    docs = spark.createDataFrame(rows(), DOCS)
    weights = {"a": 5.0, "b": 3.0, None: 1.0, "c": 1.0}
    out = placed(spark, docs, weights, folder=folder, block_rows=8, period=100)
    assert [r.position for r in out] == list(range(len(rows()))) and [r.slot for r in out] == sorted(r.slot for r in out)
    sizes = {s: sum(r.source == s for r in out) for s in weights}
    parts = dict(zip([None, "a", "b", "c"], q.shares([1.0, 5.0, 3.0, 1.0], 100)))
    full = min(sizes[s] // 8 * 100 // parts[s] for s in weights)  # slots before a source runs out
    count = dict.fromkeys(weights, 0)
    firsts = {}
    for r in out:
        firsts.setdefault(r.slot, r.source)
    for t in range(full - 1):
        count[firsts[t]] += 1
        assert all(abs(count[s] - (t + 1) * parts[s] / 100) < 1 for s in weights)
    for s in weights:
        own = [(r.block, r.block_row) for r in out if r.source == s]
        assert own == [(k // 8, k % 8) for k in range(len(own))]
    assert sorted((r.doc_id, r.source) for r in out if r.doc_id is not None and r.source) == sorted((k, s) for k, s, _ in rows() if k is not None and s)


def test_sources_that_run_out_lose_nothing(spark, folder):
    data = [(k, "big", "x") for k in range(900)] + [(1000 + k, "small", "x") for k in range(3)]
    docs = spark.createDataFrame(data, DOCS)
    out = placed(spark, docs, {"small": 9.0, "big": 1.0}, folder=folder, block_rows=4, period=10)
    assert [r.position for r in out] == list(range(903)) and {r.source for r in out[:4]} == {"small", "big"}


def test_ordered_table_and_clashing_columns(spark):
    docs = spark.createDataFrame(rows(), DOCS).withColumns({"slot": F.lit(1), "sid": F.lit("x"), "position": F.lit(2)})
    out = q.in_order(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.source) for r in out.collect()]
    want = [(r.doc_id, r.source) for r in sorted(q.mix(spark.createDataFrame(rows(), DOCS)).collect(), key=lambda r: (r.slot, r.block_row))]
    assert got == want
    assert q.in_order(docs.limit(0)).count() == 0 and q.positions(q.mix(docs.drop("slot", "position").limit(0))).count() == 0
    with pytest.raises(ValueError, match="slot"):
        q.mix(docs)
    with pytest.raises(ValueError, match="position"):
        q.positions(docs)


def test_order_does_not_depend_on_how_the_work_is_cut(spark):
    docs = spark.createDataFrame([(k, 0) for k in range(4000)], "doc_id long, g int")
    def numbers(**cut):
        return {r.doc_id: r.n for r in number_rows(docs, "g", [F.col("doc_id")], "n", **cut).collect()}
    want = {k: n for n, k in enumerate(sorted(range(4000), key=lambda k: (hashlib.md5(str(k).encode()).hexdigest()[:8], k)))}
    assert numbers(total=4000) == numbers(total=1) == numbers(total=4000, rows_per_chunk=100) == want
