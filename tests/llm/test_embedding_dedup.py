"""Near vectors against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from llm_cases import components

from cohortkit.llm.embedding_dedup import near_vectors, spherical_kmeans

SCHEMA = "vec_id long, embedding array<float>, label int, EMBEDDING string, node string, cell int"


def cloud(n: int, seed: int, dims: int = 32):
    """Groups of vectors at graded distances, and a group of copies."""
    r, out = np.random.default_rng(seed), []
    while len(out) < n:
        base = r.normal(size=dims)
        base /= np.linalg.norm(base)
        for _ in range(r.integers(1, 7)):
            noise = r.normal(size=dims)
            out.append(base + noise / np.linalg.norm(noise) * r.choice([0.02, 0.1, 0.2, 0.33]))
    out = [v.astype(np.float32) for v in out[:n]]
    return out + [out[0]] * 30 + [2 * out[1]]


def direct(vectors: dict[int, np.ndarray]):
    ids = list(vectors)
    x = np.array([vectors[i] for i in ids], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    low = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    return {i: (int(n), low[i]) for i, n in zip(ids, near.sum(axis=1), strict=True)}


@pytest.mark.parametrize(("cell_rows", "block_rows"), [(400, 2048), (60, 16)])
def test_recall_and_exactness(spark, cell_rows, block_rows):
    vectors = dict(enumerate(cloud(1500, 2)))
    df = spark.createDataFrame([(i, [float(x) for x in v], 0, "x", "y", 1) for i, v in vectors.items()], SCHEMA)
    got = {r["vec_id"]: r for r in near_vectors(df, cell_rows=cell_rows, block_rows=block_rows).collect()}
    exact = direct(vectors)
    assert len(got) == len(exact)
    assert all(got[i]["n_links"] <= n for i, (n, _) in exact.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(n for n, _ in exact.values())
    assert np.mean([got[i]["component_id"] == c for i, (_, c) in exact.items()]) > 0.95
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_one_cell_is_exact(spark):
    vectors = dict(enumerate(cloud(300, 7)))
    df = spark.createDataFrame([(i, [float(x) for x in v], 0, "x", "y", 1) for i, v in vectors.items()], SCHEMA)
    for block in (2048, 7):
        got = near_vectors(df, block_rows=block).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == direct(vectors)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, v), (2, v), (2, v), (3, None), (4, []), (5, [0.0] * 3), (6, [nan, 1.0, 1.0]), (7, [inf, 1.0, 1.0]), (8, [None, 1.0, 1.0]), (9, [1.0, 2.0]), (10, w), (None, v), (11, [2.0, 4.0, 6.0]), (12, [1e38, 2e38, 3e38]), (13, [-0.0, 0.0, -0.0])]
    got = near_vectors(spark.createDataFrame([(i, x, None, "x", "y", 1) for i, x in rows], SCHEMA)).collect()
    assert sorted(tuple(r) for r in got if r["vec_id"] is not None) == sorted(
        [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (11, 4, 1, False), (12, 4, 1, False)] + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 13)]
    )
    assert [tuple(r) for r in got if r["vec_id"] is None] == [(None, 0, None, False)]


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_vectors(spark.createDataFrame([(1, None, 0, "x", "y", 1)], SCHEMA).limit(1)).count() == 1


def test_centres_are_unit_vectors():
    x = np.random.default_rng(1).normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(np.linalg.norm(spherical_kmeans(x, 20), axis=1), 1)
