"""Nearest neighbours over several shards against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetally.llm import neighbours


def frame_of(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(vectors)],
                                 "vec_id long, embedding array<double>")


def recall(vectors, found, every, k=5):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = total = 0
    for q in range(0, len(vectors), every):
        near = unit @ unit[q]
        assert all(abs(near[v] - s) < 1e-9 for v, s in got[q].items())
        near[q] = -9
        hits += len(set(got[q]) & set(np.argsort(-near, kind="stable")[:k].tolist()))
        total += k
    return hits / total


@pytest.fixture
def routes_of(monkeypatch):
    """The routes of the last search."""
    made, build = [], neighbours._routes
    monkeypatch.setattr(neighbours, "_routes", lambda *a: made.append(build(*a)) or made[-1])
    return made


def test_queries_go_to_the_shards_near_them(spark, monkeypatch, routes_of):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 250)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 20)
    random = np.random.default_rng(3)
    middles = random.normal(size=(10, 24))
    vectors = middles[random.integers(10, size=3000)] + 0.2 * random.normal(size=(3000, 24))
    frame = frame_of(spark, vectors)
    found = neighbours.nearest(frame, frame.filter("vec_id % 20 = 0")).collect()
    routes = routes_of[-1]
    assert len(routes.pivots[24]) == 12 and routes.probed[24] <= 4 and max(routes.blocks.values()) > 1
    assert recall(vectors, found, 20) >= 0.95 and len(found) == 150 * 5
    asked = frame.filter("vec_id % 20 = 0").withColumn("dim", F.size("embedding"))
    assert neighbours._sent(asked, routes).count() <= 150 * routes.total // 2


def test_without_structure_all_cells_are_searched_that_matter(spark, monkeypatch, routes_of):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 500)
    vectors = np.random.default_rng(4).normal(size=(2000, 32))
    frame = frame_of(spark, vectors)
    found = neighbours.nearest(frame, frame.filter("vec_id % 40 = 0")).collect()
    assert routes_of[-1].total >= 4 and recall(vectors, found, 40) >= 0.93


def test_a_direction_that_most_vectors_share_is_split(spark, monkeypatch, routes_of):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 200)
    random = np.random.default_rng(5)
    line, rest = random.normal(size=8), random.normal(size=(500, 8))
    vectors = np.concatenate([line * np.arange(1, 1001)[:, None], rest])
    frame = frame_of(spark, vectors)
    found = neighbours.nearest(frame, frame.filter("vec_id % 50 = 0")).collect()
    routes = routes_of[-1]
    assert max(number for _, number in routes.shards.values()) >= 5
    assert len(found) == 30 * 5
    assert all(abs(r.score - 1) < 1e-12 for r in found if r.query_id < 1000)
    assert len({(r.query_id, r.vec_id) for r in found}) == len(found)


def test_dimensions_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 100)
    random = np.random.default_rng(6)
    small, large = random.normal(size=(300, 4)), random.normal(size=(250, 12))
    frame = frame_of(spark, small).unionByName(frame_of(spark, large, 1000)) \
        .unionByName(frame_of(spark, random.normal(size=(3, 5)), 5000))
    found = neighbours.nearest(frame, frame.filter("vec_id % 10 = 0")).collect()
    kind = lambda v: v // 1000
    assert all(kind(r.query_id) == kind(r.vec_id) and r.query_id != r.vec_id for r in found)
    assert sum(r.query_id == 5000 for r in found) == 2
    assert len(found) == 5 * 55 + 2
