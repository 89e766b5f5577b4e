import numpy as np
import pytest
from helpers import Union, frame

from capset.llm.embedding_dedup import near_vectors

VEC = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine):
    unit = {}
    for i, v, *_ in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            x /= np.abs(x).max()
            unit[i] = x / np.linalg.norm(x)
    u, n = Union([r[0] for r in rows]), dict.fromkeys([r[0] for r in rows], 0)
    ids = sorted(unit)
    for a in ids:
        for b in ids:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                u.join(a, b)
                n[a] += 1
                n[b] += 1
    return sorted((i, n[i], u.find(i), u.find(i) == i) for i in n)


def vectors(seed, n=300, dim=12):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(20, dim))
    rows = []
    for i in range(n):
        c = centre[0] if i % 3 == 0 else centre[rng.integers(20)]
        rows.append((i, [float(np.float32(x)) for x in c + rng.normal(size=dim) * rng.choice([0.05, 0.15, 0.5])], 1))
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim, [1.0, 2.0], [2.0, 4.0],
           rows[0][1], rows[0][1], [2 * x for x in rows[0][1]], [-x for x in rows[0][1]], [1e-30] * dim, [1e30] * dim, [-0.0, 1.0], [0.0, 1.0]]
    return rows + [(n + k, v, None) for k, v in enumerate(odd)]


@pytest.mark.parametrize("block", [256, 16])
def test_against_brute_force(spark, block):
    rows = vectors(1)
    got = near_vectors(frame(spark, rows, VEC), block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 0.95)


def test_odd_tables(spark):
    assert near_vectors(frame(spark, [], VEC)).collect() == []
    assert list(map(tuple, near_vectors(frame(spark, [(3, None, 1)], VEC)).collect())) == [(3, 0, 3, True)]
    got = near_vectors(frame(spark, [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.01], 1), (None, [0.0, 1.0], 1)], VEC)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True)], key=str)


def test_null_and_negative_ids_between_near_vectors(spark):
    """A vector without an id joins what it is near to; negative ids name components like others."""
    a, n, b = [1.0, 0.0], [0.98, 0.199], [0.97, 0.243]
    got = near_vectors(frame(spark, [(5, a, 1), (None, n, 1), (7, b, 1)], VEC)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, 5, False), (5, 2, 5, True), (7, 2, 5, False)], key=str)
    far = [0.9, 0.436]  # near to n, not to a
    got = near_vectors(frame(spark, [(5, a, 1), (None, n, 1), (7, far, 1)], VEC)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, 5, False), (5, 1, 5, True), (7, 1, 5, False)], key=str)
    got = near_vectors(frame(spark, [(-3, a, 1), (-9, n, 1), (4, b, 1)], VEC)).collect()
    assert sorted(map(tuple, got)) == [(-9, 2, -9, True), (-3, 2, -9, False), (4, 2, -9, False)]
