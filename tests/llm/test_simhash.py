import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgermill.llm import simhash as q

DOCS = "doc_id long, text string"


def brute_fingerprint(text, words=3):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_roots(values, ids, bits):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(values)):
        least[find(i)] = min(least.get(find(i), 1 << 62), ids[i])
    return [least[find(i)] for i in range(len(values))]


def test_fingerprints_equal_brute_force_and_spark(spark):
    rng = random.Random(2)
    texts = [None, "", " \x0b\n", "A", "a B", "Ä É ß", "one two three", "a b c d", "\x1c x"]
    texts += [" ".join(rng.choice(["the", "Cat", "sat", "ÉTÉ", "on"]) for _ in range(rng.randint(1, 30))) for _ in range(50)] + ["w " * 70_000]
    got = {r.id: r.fp % (1 << 64) for r in q.fingerprints(spark.createDataFrame(list(enumerate(texts)), DOCS), 3).collect()}
    assert got == {k: brute_fingerprint(t) for k, t in enumerate(texts)}
    assert spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


def test_links_equal_brute_force_in_a_dense_ball(spark):
    rng = random.Random(3)
    values = [0, (1 << 64) - 1]
    for centre in (0, rng.getrandbits(64), rng.getrandbits(64)):
        for _ in range(400):
            v = centre
            for _ in range(rng.randint(0, 9)):
                v ^= 1 << rng.randrange(64)
            values.append(v)
    values = sorted(set(values + [rng.getrandbits(64) for _ in range(300)]))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in q.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 3, block=64).collect()]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in links)
    place = {v: k for k, v in enumerate(values)}
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(place[a]), find(place[b])
        parent[max(ra, rb)] = min(ra, rb)
    assert [find(k) for k in range(len(values))] == brute_roots(values, list(range(len(values))), 3)


def test_allocated_radii_add_up_and_cost_least():
    rng = np.random.default_rng(0)
    for parts in (2, 3, 4, 5):
        costs = [np.concatenate([np.zeros((1, 20)), np.cumsum(rng.random((4, 20)) * 10, axis=0)]) for _ in range(parts)]
        radii = q.allocate(costs, 3)
        assert (radii.sum(axis=0) == 3 - parts + 1).all()
        grid = np.stack(np.meshgrid(*[np.arange(-1, 4)] * parts, indexing="ij"), -1).reshape(-1, parts)
        grid = grid[grid.sum(axis=1) == 4 - parts]
        best = np.min([sum(costs[i][g[i] + 1] for i in range(parts)) for g in grid], axis=0)
        assert np.allclose(sum(costs[i][radii[i] + 1, np.arange(20)] for i in range(parts)), best)


def test_whole_operator(spark):
    rng = random.Random(5)
    base = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)) for _ in range(4)]
    texts = [b + f" {k}" for b in base for k in range(10)] + [base[0]] * 5 + [None, "", " "] + ["other words here"]
    docs = spark.createDataFrame([(k * 7 + 3, t) for k, t in enumerate(texts)], DOCS).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1))
    out = {r.doc_id: (r.fingerprint, r.component_id) for r in q.near_duplicates(docs).collect()}
    values = [brute_fingerprint(t) for t in texts]
    roots = brute_roots(values, [k * 7 + 3 for k in range(len(texts))], 3)
    assert out == {k * 7 + 3: (format(v, "016x"), roots[k]) for k, v in enumerate(values)}
    again = q.near_duplicates(docs.union(docs))
    assert again.count() == 2 * len(texts) and {(r.doc_id, r.component_id) for r in again.collect()} == {(k, v[1]) for k, v in out.items()}
    assert q.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    from ledgermill.llm.components import components

    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000)]
    random.Random(0).shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(300)}
