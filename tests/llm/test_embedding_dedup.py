import random

import numpy as np
import pytest

from cases import Forest
from gaugeworks.llm.embedding_dedup import compare, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, _k1 string, _x string, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", None, "b") for r in rows], SCHEMA).repartition(3)


def brute(rows, threshold=0.98):
    """(links, component, kept) by id; ids are distinct."""
    units = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = np.array(np.array(v, np.float32), float)
        if (norm := np.sqrt(x @ x)) > 0:
            units[i] = (label, x / norm)
    links, forest = dict.fromkeys(units, 0), Forest(units)
    for a, (la, x) in units.items():
        for b, (lb, y) in units.items():
            if a != b and la == lb and len(x) == len(y) and x @ y >= threshold:
                links[a] += 1
                forest.link(a, b)
    out = {}
    for i, _, _ in rows:
        root = forest.find(i) if i in units else i
        out[i] = (links.get(i, 0), root, i is not None and root == i)
    return out


def clusters(seed, n, dim=24, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    rows = []
    for i in range(n):
        c = centres[rng.integers(8)]
        v = c + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.12, 0.2, 1.0])
        rows.append((int(i), [float(x) for x in v * rng.choice([1.0, 3.0])], int(rng.integers(labels))))
    return rows


def as_dict(got):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()}


@pytest.mark.parametrize("tile_rows", [5, 60, 2048])
def test_equals_brute_force(spark, tile_rows):
    rows = clusters(tile_rows, 300)
    want = brute(rows)
    assert as_dict(near_duplicates(frame(spark, rows), tile_rows=tile_rows)) == want
    assert sum(n for n, _, _ in want.values()) > 50


def test_unusable_vectors_and_dimensions(spark):
    v = [0.5, 1.0, -2.0]
    rows = [
        (1, v, 1), (2, [1.0, 2.0, -4.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [0.5, None, -2.0], 1), (9, [float("nan"), 1.0, -2.0], 1), (10, [float("inf"), 1.0, -2.0], 1),
        (11, [0.5, 1.0, -2.0, 0.0], 1), (12, [-0.5, -1.0, 2.0], 1), (13, [3e38, 3e38, 0.0], 1), (14, [1e-30, 1e-30, 0.0], 1),
    ]
    want = brute(rows)
    assert want[1] == (1, 1, True) and want[2] == (1, 1, False)
    want[13], want[14] = (1, 13, True), (1, 13, False)
    assert as_dict(near_duplicates(frame(spark, rows))) == want


def test_null_and_repeated_ids(spark):
    v = [1.0, 2.0]
    rows = [(3, v, 1), (3, v, 1), (5, v, 1), (None, v, 1)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect())
    assert got == [(0, 0, None, False), (3, 1, 3, True), (3, 1, 3, True), (5, 1, 3, False)]


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 0.0], 1) for i in range(4000)] + [(5000, [0.99, 0.05], 1), (5001, [0.0, 1.0], 1)]
    got = as_dict(near_duplicates(frame(spark, rows), tile_rows=64))
    assert got[17] == (4000, 0, False) and got[5000] == (4000, 0, False) and got[5001] == (0, 5001, True)


def test_chain_is_one_component(spark):
    rows = [(i, [float(np.cos(i * 0.15)), float(np.sin(i * 0.15))], 1) for i in range(30)]
    assert as_dict(near_duplicates(frame(spark, rows), tile_rows=3)) == brute(rows)


def test_empty_table_and_bad_threshold(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        near_duplicates(frame(spark, []), threshold=0)


def test_pruned_comparison_finds_every_pair():
    rng = np.random.default_rng(1)
    for threshold in (0.3, 0.8, 0.98):
        a = rng.normal(size=(70, 40)) + 2 * rng.normal(size=40)
        a /= np.linalg.norm(a, axis=1)[:, None]
        axes = np.linalg.eigh(a.T @ a)[1][:, ::-1]
        found = {(i, j) for x, y in compare(a, a, axes, threshold, True, rows=16) for i, j in zip(x.tolist(), y.tolist())}
        dots = a @ a.T
        assert found == {(i, j) for i in range(70) for j in range(70) if i != j and dots[i, j] >= threshold}


def test_labels_do_not_mix(spark):
    rng = random.Random(1)
    rows = [(i, [1.0, 1.0 + i / 1e4], rng.randrange(4)) for i in range(40)]
    assert as_dict(near_duplicates(frame(spark, rows), tile_rows=4)) == brute(rows)
