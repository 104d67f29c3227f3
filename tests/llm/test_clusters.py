"""Integer k-means against plain Python, and the bounds of the projection."""

import hashlib
import math
import random

import numpy as np
import pytest

from pagetally.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance string, key int"


def brute(rows, count, rounds, seed):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == 64 and all(
                x is not None and math.isfinite(x) for x in vector):
            text = f"{seed}:" + ("" if vec_id is None else str(vec_id))
            kept.append((hashlib.sha256(text.encode()).hexdigest(),
                         [math.floor(1024 * x) for x in vector], vec_id))
    centroids = [v for _, v, _ in sorted(kept, key=lambda k: k[:2])[:count]]

    def assign():
        found = []
        for _, v, _ in kept:
            found.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), i)
                             for i, c in enumerate(centroids)))
        return found

    for _ in range(rounds):
        found = assign()
        for i in range(len(centroids)):
            own = [v for (_, v, _), (_, n) in zip(kept, found) if n == i]
            if own:
                centroids[i] = [sum(x) // len(own) for x in zip(*own)]
    found = assign() if kept else []
    inertia = [sum(d for d, n in found if n == i) for i in range(len(centroids))]
    return sorted((str(vec_id), n, d, inertia[n], sum(inertia), hashlib.sha256(
        ",".join(map(str, centroids[n])).encode()).hexdigest())
        for (_, _, vec_id), (d, n) in zip(kept, found))


def report(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia,
                   r.centroid_sha256) for r in clusters.Clusters(frame, **options).report().collect())


def vectors(seed, n, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 3) for _ in range(64)] for _ in range(5)]
    return [(i, [m + rng.gauss(0, spread) for m in rng.choice(middles)]) for i in range(n)]


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = vectors(1, 300)
    rows += [(7, rows[7][1]), (None, rows[9][1]), (None, rows[9][1]), (500, [0.0] * 64),
             (501, None), (502, [1.0] * 63), (503, [1.0] * 65), (504, [float("nan")] + [0.0] * 63),
             (505, [0.0] * 63 + [float("-inf")]), (506, [None] + [0.0] * 63), (507, []),
             (508, [-0.0] * 64), (509, [1e-300] * 64), (510, [-1e-300] * 64)]
    rng.shuffle(rows)
    assert report(spark, rows) == brute(rows, 8, 10, 3)
    assert report(spark, rows, count=3, rounds=1, seed=11) == brute(rows, 3, 1, 11)


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(40)],
    [(i, [float(i % 2)] * 64) for i in range(20)]])
def test_few_equal_and_no_vectors(spark, rows):
    assert report(spark, rows) == brute(rows, 8, 10, 3)


def test_too_large_components_end_with_an_error(spark):
    with pytest.raises(Exception, match="components beyond"):
        report(spark, [(1, [2.0 ** 40] + [0.0] * 63)])


def test_bounds_hold_and_filter(spark):
    rng = np.random.default_rng(5)
    for dimensions, n in ((64, 200), (3, 50), (64, 5), (2, 1)):
        points = np.floor(1024 * rng.normal(size=(n, dimensions))).astype(np.int64)
        simplex = clusters.Simplex(points[:40])
        apex = simplex.apexes(points)
        for _ in range(200):
            a, b = rng.integers(0, n, 2)
            true = math.sqrt(((points[a] - points[b]) ** 2).sum())
            flat = ((apex[a, :-1] - apex[b, :-1]) ** 2).sum()
            lower = math.sqrt(flat + (apex[a, -1] - apex[b, -1]) ** 2)
            upper = math.sqrt(flat + (apex[a, -1] + apex[b, -1]) ** 2)
            assert lower <= true + 1e-6 * (true + 1) and true <= upper + 1e-6 * (upper + 1)
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in vectors(6, 400, 0.1)], SCHEMA)
    made, every = clusters.Clusters(frame).comparisons()
    assert every == 8 * 400 and made < every / 2
