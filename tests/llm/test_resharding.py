import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import resharding as q
from ledgermill.llm.common import id_crc

DOCS = "doc_id long, text string"


def cost_of(flow, cost=None):
    return sum(v * ((s != t) if cost is None else cost[s][t]) for (s, t), v in flow.items())


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(0)
    for _ in range(60):
        s, t = rng.randint(1, 7), rng.randint(1, 7)
        supply = [rng.randint(0, 50) for _ in range(s)]
        demand = q.equal_capacities(sum(supply), t)
        flow = q.least_cost_flow(supply, demand)
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(s)] == supply
        assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(t)] == demand
        assert cost_of(flow) == sum(supply) - sum(min(a, b) for a, b in zip(supply, demand))


def test_flow_with_costs_equals_brute_force():
    from itertools import product

    rng = random.Random(1)
    for _ in range(20):
        supply, demand = [2, 1, 2], [1, 3, 1]
        cost = [[rng.randint(0, 9) for _ in demand] for _ in supply]
        best = min(
            sum(x[i * 3 + j] * cost[i][j] for i in range(3) for j in range(3)) for x in product(range(4), repeat=9)
            if all(sum(x[i * 3:i * 3 + 3]) == supply[i] for i in range(3)) and all(sum(x[j::3]) == demand[j] for j in range(3)))
        assert cost_of(q.least_cost_flow(supply, demand, cost), cost) == best
    with pytest.raises(ValueError):
        q.least_cost_flow([1], [2])


def place(spark, rows, old=12, new=16, **how):
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.lit(5))
    placed = q.place(docs, F.coalesce(id_crc() % old, F.lit(0)), old, new, **how)
    folder = q.rewrite(placed, ["text", "n_chars"])
    return q.layout(spark, folder, placed.schema).collect()


@pytest.mark.parametrize("block", [500, 1 << 20])
def test_sizes_slots_and_files(spark, block):
    rng = random.Random(2)
    rows = [(k, "é" * rng.randint(0, 60)) for k in range(3000)] + [(5000 + k, "copied text") for k in range(1500)] + [(9000, None), (9001, ""), (7, "again"), (7, "again"), (9002, "x" * 4000)]
    out = place(spark, rows, block_bytes=block)
    assert sorted((r.doc_id, r.size) for r in out) == sorted((k, len((t or "").encode()) + 1) for k, t in rows)
    sizes, slots = [0] * 16, [[] for _ in range(16)]
    for r in out:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.old_shard == zlib.crc32(str(r.doc_id).encode()) % 12 and r.moved == (r.shard != r.old_shard)
        assert r.moved or (r.text is None and r.n_chars is None)
    texts = {r.doc_id: r.text for r in out if r.moved}
    assert all(t == dict(rows)[k] for k, t in texts.items())
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 16 + 200
    moved = sum(r.size for r in out if r.moved)
    per_old = [sum(r.size for r in out if r.old_shard == k) for k in range(16)]
    assert moved <= sum(per_old) - sum(min(a, b) for a, b in zip(per_old, q.equal_capacities(sum(per_old), 16))) + 16 * 121


def test_equal_texts_stay_neighbours(spark):
    rows = [(k, f"text {k // 4}") for k in range(4000)]
    out = place(spark, rows)
    by_old = {}
    for r in out:
        by_old.setdefault((r.old_shard, r.doc_id // 4), set()).add(r.shard)
    assert sum(len(s) > 1 for s in by_old.values()) <= 12 * 4  # only where a cut falls


def test_empty(spark):
    assert place(spark, []) == []


def test_every_shard_of_the_query_is_whole(spark, folder, monkeypatch):
    from ledgermill.llm import queries

    rows = [(k, "é" * (k % 70) + str(k), "en", f"s{k % 3}", k) for k in range(2000)] + [(5000, None, None, None, None), (5001, "", "en", "s1", 0)]
    spark.createDataFrame(rows, DOCS + ", lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(q, "new_folder", lambda spark, label: f"{folder}/{label}")
    out = queries.op6_resharding(spark, folder).collect()
    files = spark.read.parquet(f"{folder}/shards").select("doc_id", "text", "lang", "source", "n_chars", "shard", "slot").collect()
    assert sorted((tuple(r)[:5] for r in files), key=str) == sorted(rows, key=str)
    assert {(r.doc_id, r.shard, r.slot) for r in files} == {(r.doc_id, r.shard, r.slot) for r in out}
    assert {r.shard for r in files} == set(range(16)) and {r.moved for r in out} == {True, False}
    assert {r.doc_id: r.text_crc32 for r in out} == {r[0]: zlib.crc32((r[1] or "").encode()) for r in rows}
