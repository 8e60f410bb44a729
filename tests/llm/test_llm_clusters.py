"""Centroid clustering against a plain version."""

import hashlib
import math
import random

import numpy as np
import pytest
from llm_helpers import found

from duelmetrics.llm import clustering
from duelmetrics.llm.clustering import Chunk, cluster_vectors, clusters, encode_chunk

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, distance string, q int, ids string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, "x", 1, "y") for i, v in rows], SCHEMA)


def plain(rows, dims=64, count=40, rounds=5):
    """(id, cluster, distance) and centroids, one vector and one component at a time."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~", q) for i, q in kept]
    centroids = [q for _, q in sorted(named)[:count]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, q in kept:
            members.setdefault(near(q)[1], []).append(q)
        centroids = [
            [sum(x) // len(members[k]) for x in zip(*members[k])] if k in members else c for k, c in enumerate(centroids)
        ]
    return [(i, near(q)[1], near(q)[0]) for i, q in kept], centroids


def draw(seed, n, dims=64):
    r = random.Random(seed)
    return [[r.choice((-0.5, 0.25, 0.1, -0.013)) + r.random() * (k % 3) for k in range(dims)] for _ in range(n)]


def key(row):
    return (row[0] is not None, row)


def test_clusters_equal_a_plain_version(spark):
    given = draw(1, 150)
    rows = list(enumerate(given))
    rows += [(1_000 + k, given[3]) for k in range(80)]  # a hot vector
    rows += [(5, given[5]), (None, given[6]), (None, given[7])]  # repeated and missing ids
    rows += [(2_001, None), (2_002, []), (2_003, given[0][:-1]), (2_004, given[0] + [0.0])]
    rows += [(2_005, [None, *given[0][1:]]), (2_006, [float("nan"), *given[0][1:]]), (2_007, [float("-inf"), *given[0][1:]])]
    expected, centroids = plain(rows)
    got = found(clusters(vectors(spark, rows).repartition(5)))
    assert sorted([(r["vec_id"], r["cluster"], r["distance"]) for r in got], key=key) == sorted(expected, key=key)
    inertia = sum(d for _, _, d in expected)
    for r in got:
        assert r["inertia"] == inertia
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


@pytest.mark.parametrize("block, chunk", [(1, 7), (5, 3), (64, 4_096)])
def test_blocks_and_chunks_change_nothing(spark, block, chunk):
    rows = list(enumerate(draw(2, 90)))
    expected, centroids = plain(rows, count=6, rounds=3)
    assigned, found_centroids = cluster_vectors(vectors(spark, rows), count=6, rounds=3, block=block, chunk=chunk)
    assert sorted(map(tuple, assigned.collect())) == expected
    assert found_centroids.tolist() == centroids


def test_dictionaries_lose_nothing():
    matrix = np.random.default_rng(3).integers(-3, 3, (500, 7)).astype(np.int64)
    codes, entries, sizes = encode_chunk(matrix, 2)
    chunk = Chunk.read(len(matrix), codes, entries, sizes, 7, 2)
    again = np.concatenate([d[c] for c, d in zip(chunk.codes, chunk.dictionaries)], axis=1)
    assert (again == matrix).all()
    assert all(len(np.unique(d, axis=0)) == len(d) <= 36 for d in chunk.dictionaries)
    cluster = np.arange(len(matrix)) % 4
    assert (chunk.sums(cluster, 4) == [matrix[cluster == k].sum(axis=0) for k in range(4)]).all()


def test_few_and_no_vectors(spark):
    rows = list(enumerate(draw(4, 3)))
    assert sorted((r["vec_id"], r["distance"]) for r in found(clusters(vectors(spark, rows)))) == [(0, 0), (1, 0), (2, 0)]
    empty = clusters(vectors(spark, [(1, None)]))
    assert found(empty) == [] and empty.columns[:3] == ["vec_id", "cluster", "distance"]
    assert found(clusters(vectors(spark, rows).filter("false"))) == []


def test_components_beyond_the_range_end_the_job(spark):
    with pytest.raises(Exception, match="beyond"):
        clusters(vectors(spark, [(1, [1e30] + [0.0] * 63)])).collect()


def test_a_round_shuffles_sums_only(spark):
    kept = clustering.quantised(vectors(spark, list(enumerate(draw(5, 4)))), "embedding")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
