import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import ego_join as q

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = [np.array(r[1], np.float32).astype(float) / np.linalg.norm(np.array(r[1], np.float32).astype(float)) for r in ok]
    links, parent = [0] * len(ok), list(range(len(ok)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ok)):
        for j in range(i):
            if ok[i][2] == ok[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(ok):
        least[find(i)] = min(least.get(find(i), 1 << 62), r[0])
    out = [(r[0], links[i], least[find(i)]) for i, r in enumerate(ok)]
    return sorted(out + [(r[0], 0, r[0]) for r in rows if not any(r is x for x in ok)], key=str)


def cloud(seed, n, d, spread, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    return [(k * 3 + 1, (centres[k % 6] + rng.normal(size=d) * spread).astype(np.float32).tolist(), int(k % labels)) for k in range(n)]


@pytest.mark.parametrize("spread, block", [(0.05, 16), (0.15, 16), (0.3, 1024)])
def test_equals_brute_force(spark, spread, block):
    rows = cloud(1, 300, 12, spread)
    random.Random(0).shuffle(rows)
    out = q.near_duplicates(spark.createDataFrame(rows, VECTORS), block=block).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 3.0], 0),
            (9, [1.0, float("nan"), 3.0], 0), (10, [1.0, float("inf"), 3.0], 0), (11, [1.0, 2.0], 0), (12, [1.0, 2.0], 0), (13, v, 1), (14, [1e-30, 2e-30, 3e-30], 0),
            (15, [1e30, 2e30, 3e30], 0), (16, [], 0), (None, v, 0), (17, [-1.0, -2.0, -3.0], 0)]
    rows += [(100 + k, [5.0, 1.0, 1.0], 2) for k in range(50)]
    out = q.near_duplicates(spark.createDataFrame(rows, VECTORS).withColumns({"ids": F.lit(1), "d": F.lit("x")})).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str) == brute(rows)
    assert q.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    assert q.near_duplicates(spark.createDataFrame([(1, None, 0)], VECTORS)).count() == 1


def test_distant_blocks_are_skipped(spark):
    rng = np.random.default_rng(0)
    angles = np.linspace(0, np.pi, 4000)
    rows = [(k, [float(np.cos(a)), float(np.sin(a))] + (rng.normal(size=2) * 1e-3).tolist(), 0) for k, a in enumerate(angles)]
    classes = spark.createDataFrame(rows, "id long, vector array<double>, label int").withColumn("n", F.lit(1).cast("long")).withColumn("d", F.lit(4))
    basis = q.principal(classes, 4)
    blocks = q._blocks(classes.select("label", "d", "id", "n", "vector"), basis, 0.2, 50).withColumn("block", F.concat_ws("-", "part", "at"))
    blocks.cache()
    n = blocks.count()
    assert n >= 80 and q.block_pairs(blocks, 0.2).count() < 0.25 * n * n
