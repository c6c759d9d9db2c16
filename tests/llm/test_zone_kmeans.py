import hashlib
import random
from itertools import product

import numpy as np
import pytest
from taxaframe.llm import zone_kmeans as zk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, cluster string, distance string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def brute(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), a in zip(kept, own) if a[1] == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    inertia = [sum(d for _, c, d in own if c == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, inertia[c], sum(inertia), digest[c]) for i, c, d in own)


def report(spark, rows, **more):
    got = zk.cluster_report(*zk.cluster_vectors(table(spark, rows), **more)).collect()
    return sorted((str(r.vec_id), *r[1:]) for r in got)


def vectors(draw, n, centres=9):
    mid = [[draw.gauss(0, 3) for _ in range(64)] for _ in range(centres)]
    return [[x + draw.gauss(0, 0.3) for x in draw.choice(mid)] for _ in range(n)]


def test_against_brute_force(spark):
    draw = random.Random(4)
    rows = list(enumerate(vectors(draw, 300)))
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # copies of one vector
    rows += [rows[3]] * 5 + [(3, rows[4][1]), (None, rows[5][1]), (None, rows[5][1]), (77_000, [0.0] * 64)]
    rows += [(5, None), (6, []), (7, [1.0] * 63), (8, [None] + [1.0] * 63), (9, [float("nan")] * 64), (10, [float("inf")] + [0.0] * 63)]
    assert report(spark, rows, block_rows=16) == brute(rows) == report(spark, rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = list(enumerate(vectors(random.Random(n), n)))
    assert report(spark, rows) == brute(rows)


def test_too_large_components(spark):
    with pytest.raises(Exception, match="2\\*\\*27"):
        report(spark, [(1, [1e9] * 64)])


def test_hilbert_curve_is_connected():
    for dims, bits in ((2, 3), (3, 2), (8, 1), (4, 2)):
        points = np.array(list(product(range(1 << bits), repeat=dims)))
        keys = [k.tobytes() for k in zk.hilbert_keys(points, bits)]
        assert len(set(keys)) == len(points)
        walk = points[sorted(range(len(points)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_boxes_bound_distances():
    draw = np.random.default_rng(1)
    pruned = 0
    for _ in range(200):
        y = draw.integers(-20, 20, (30, 64)) + draw.integers(-300, 300, 64)
        centroids = draw.integers(-300, 300, (16, 64))
        centroids[0] = y[0]
        d = ((y[:, None] - centroids) ** 2).sum(2)
        own, best = zk.nearest(y, y.min(0), y.max(0), centroids)
        assert (own == d.argmin(1)).all() and (best == d.min(1)).all()
        pruned += 16 - len(zk.candidates(y.min(0), y.max(0), centroids))
    assert pruned > 200 * 8
