"""Centroid clustering against plain integer rounds."""

import hashlib
import math
import random

import numpy as np

from indistar.llm.clusters import cluster_vectors, nearest, _rotated

SCHEMA = "vec_id long, embedding array<float>, label int, x int, cluster string"


def table(seed=1, n=120):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(4)]
    rows = [(i, [c + r.gauss(0, .3) for c in r.choice(centres)], 0, 1, "c") for i in range(n)]
    rows += [rows[3], (900, rows[3][1], 0, 1, "c"), (None, rows[5][1], None, None, None), (3, rows[9][1], 0, 1, "c")]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [math.nan] + [1.0] * 63, [math.inf] + [1.0] * 63, [-math.inf] * 64]
    return rows + [(1000 + i, v, 0, 1, "c") for i, v in enumerate(bad)] + [(None, None, None, None, None)]


def brute(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(np.float32(y))) for y in v]) for i, v, *_ in rows
            if v and len(v) == 64 and all(y is not None and math.isfinite(y) for y in v)]
    h = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "z"
    cs = [x for _, x in sorted(kept, key=lambda t: (h(t[0]), t[1]))[:k]]

    def pick(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [pick(x)[1] for _, x in kept]
        for j in range(len(cs)):
            mine = [x for (_, x), o in zip(kept, own) if o == j]
            if mine:
                cs[j] = [sum(col) // len(mine) for col in zip(*mine)]
    got = [(i, *pick(x)) for i, x in kept]
    part = {j: sum(d for _, d, o in got if o == j) for j in range(len(cs))}
    return [(i, j, d, part[j], sum(part.values()), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest())
            for i, d, j in got]


def check(spark, rows):
    got = cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, brute(rows)))


def test_against_plain_rounds(spark):
    check(spark, table())


def test_fewer_vectors_than_centroids(spark):
    rows = table()
    check(spark, rows[:5] + [rows[2]] * 3)
    check(spark, [rows[0]] * 4)
    check(spark, rows[-9:])
    check(spark, [])


def test_bound_leaves_centroids_out_and_no_nearest():
    r = np.random.default_rng(4)
    x = r.integers(-300, 300, (500, 64)) + r.integers(0, 3, (500, 1)) * 900
    c = x[r.choice(500, 8, replace=False)].copy()
    c[5] = c[2]  # a tie
    turn = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :16]
    best, distance, verified = nearest(x, *_rotated(x, turn), c, turn)
    full = ((x[:, None] - c) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (distance == full.min(1)).all() and verified < full.size
