import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import ptolemaic_clusters as pc

SCHEMA = "vec_id long, embedding array<float>, label int"


def _expected(rows, count, rounds, scale, width):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, *_ in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), w) for i, w in kept if i is not None)[:count]
    centroids = [w for _, w in start]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda w: min((far(w, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        own = [nearest(w)[1] for _, w in kept]
        for k in range(len(centroids)):
            if members := [w for (_, w), c in zip(kept, own, strict=True) if c == k]:
                centroids[k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    last = [(i, *reversed(nearest(w))) for i, w in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, sum(e for _, j, e in last if j == k), sum(e for *_, e in last), digest[k]) for i, k, d in last), key=str)


def _rows(draw, n, width):
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [(i, [x + draw.gauss(0, 0.3) for x in draw.choice(centres)], 0) for i in range(n)]


def test_against_plain_rounds_with_awkward_rows(spark):
    draw = random.Random(5)
    rows = _rows(draw, 120, 4)
    rows += [(200 + i, rows[3][1], None) for i in range(60)]  # one vector is a third of all
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[9][1], 1), (300, None, 1), (301, [], 1), (302, [1.0, None, 0.0, 0.0], 1), (303, [1.0, float("nan"), 0.0, 0.0], 1), (304, [1.0, float("-inf"), 0.0, 0.0], 1), (305, [1.0] * 5, 1), (306, [0.0, -0.0, -1e-9, 5.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("cluster", F.lit("x")).withColumn("near", F.lit("x"))
    for count, rounds, pivots in ((8, 10, 6), (3, 2, 2), (5, 4, 1)):
        got = pc.clusters(df, count=count, rounds=rounds, scale=16, width=4, pivots=pivots, sample=20)
        assert sorted((tuple(r) for r in got.collect()), key=str) == _expected(rows, count, rounds, 16, 4)


def test_few_vectors_none_and_too_large(spark):
    rows = [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [5.0, 2.0], 0)]
    for some in (rows, rows[:1], []):
        got = pc.clusters(spark.createDataFrame(some, SCHEMA), width=2, rounds=3)
        assert sorted((tuple(r) for r in got.collect()), key=str) == _expected(some, 8, 3, 1024, 2)
    with pytest.raises(Exception, match="too large"):
        pc.clusters(spark.createDataFrame([(1, [1e30, 0.0], 0)], SCHEMA), width=2).collect()


def test_bounds_hold_and_spare_distances():
    draw = np.random.default_rng(1)
    centres = draw.integers(-900, 900, (8, 16))
    x = np.concatenate([centres[i % 8] + draw.integers(-40, 40, (50, 16)) for i in range(16)]).astype(np.int64)
    pivots = pc.choose_pivots(x[:100], 6)
    near, to = pc.pivot_distances(x, pivots), pc.pivot_distances(centres, pivots)
    among = pc.pivot_distances(pivots, pivots)
    pairs = [(p, s, among[p, s]) for p in range(6) for s in range(p)]
    exact = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (pc.lower_bounds(near, to, pairs) ** 2 <= exact).all()
    cluster, distance, measured = pc.nearest(x, near, centres, to, pairs)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert measured < 0.5 * exact.size
