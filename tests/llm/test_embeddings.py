"""Embedding links over a grid of several projections, and cells cut into chunks, against brute force."""

import math

import numpy as np
import pytest

from catloss.llm import embeddings


def planted(rng, n: int, d: int = 32) -> np.ndarray:
    """Random vectors, chains of near ones around the bound, and one group whose members are all near."""
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, n // 3):
        noise = rng.standard_normal(d)
        noise -= noise @ x[i] * x[i]
        angle = math.acos(rng.uniform(0.93, 0.97))
        x[n // 3 + i] = math.cos(angle) * x[i] + math.sin(angle) * noise / np.linalg.norm(noise)
    crowd = slice(n - n // 6, n)
    x[crowd] = x[n - 1] + rng.standard_normal((n // 6, d)) * 0.01
    x[5], x[6] = x[4], x[4] * 7  # equal, and of another length
    return x


def brute(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = u @ u.T >= embeddings.COSINE
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(near, root[None, :], len(x)).min(axis=1))
        if (new == root).all():
            return near.sum(axis=1), root
        root = new


@pytest.mark.parametrize("shape, block", [((3, 25), 16), ((5, 40), 1024), (None, 1024)])
def test_links_and_components_equal_brute_force(spark, monkeypatch, shape, block):
    x = planted(np.random.default_rng(2), 900)
    if shape:
        monkeypatch.setattr(embeddings, "grid_shape", lambda n: shape)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "SLICE", 500)
    rows = [(i * 3, v.tolist(), "x", 1) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string, chunk int").repartition(5)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    links, roots = brute(x)
    assert links.sum() > 20_000 and len(got) == len(x)
    for i in range(len(x)):
        r = got[i * 3]
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[i], roots[i] * 3, roots[i] == i), i


def test_pairs_at_the_bound_are_found_and_few_others_tested():
    """Recall of the count at exactly the bound, and the share of unrelated pairs that pass it."""
    rng = np.random.default_rng(5)
    d, n = 64, 4000
    a = rng.standard_normal((n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    noise = rng.standard_normal((n, d))
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    b = embeddings.COSINE * a + math.sqrt(1 - embeddings.COSINE**2) * noise
    k, rounds = embeddings.grid_shape(50_000)
    directions, offsets = embeddings.lines(d, k, rounds)
    p = np.vstack([a, b]) @ directions
    counted = np.rint(p[:, : 1 + embeddings.COUNTED] * embeddings.UNIT).astype("int64")
    grid = np.floor((p[:, 1 + embeddings.COUNTED :] + offsets) / embeddings.WIDTH).reshape(2 * n, rounds, k)
    near = np.abs(counted[:n] - counted[n:])
    passed = (near[:, 0] <= embeddings.SORTED * embeddings.UNIT) & ((near[:, 1:] <= embeddings.REACH).sum(axis=1) >= embeddings.least_count())
    met = (grid[:n] == grid[n:]).all(axis=2).any(axis=1)
    assert passed.mean() > 0.995 and met.mean() > 0.995 and (passed & met).mean() > 0.99
    pairs = sum(len(x) for x, _ in embeddings.passing(counted[:n].astype("int16"), *np.zeros((4, n), int)))
    assert pairs < 1e-3 * n * n / 2


def test_grid_tests_far_fewer_than_all_pairs_as_tables_grow():
    shares, entries = [], []
    for n in (50_000, 1_000_000, 100_000_000):
        k, rounds = embeddings.grid_shape(n)
        shares.append(rounds * embeddings.MEET**k)
        entries.append(rounds)
    assert shares[0] < 0.1 and shares[1] < 0.01 and shares[2] < 0.001 and entries[0] < 40 and entries[2] < 200
