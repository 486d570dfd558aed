"""Dual-tree codes against a comparison of all points with all entries."""

import random

import numpy as np
import pytest

from playtrail.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA)


def single(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], la) for i, v, la in rows]


def same(spark, rows, **options):
    got = [tuple(r) for r in V.codes(frame(spark, rows), **options).collect()]
    options.pop("block", None)
    want = V.brute_force(single(rows), **options)
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


@pytest.mark.parametrize("dimension,block", [(16, 2048), (16, 70), (20, 300)])
def test_random_vectors(spark, dimension, block):
    rnd = random.Random(dimension + block)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(dimension)], rnd.choice([1, 2, None])) for i in range(400)]
    rows += [(None, [rnd.gauss(0, 0.3) for _ in range(dimension)], 3), rows[5], rows[5]]
    rnd.shuffle(rows)
    assert len(same(spark, rows, block=block)) == 403


def test_ties_go_to_the_lower_entry(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([0.0, 0.25, -0.25]) for _ in range(16)], i % 2) for i in range(300)]
    same(spark, rows, block=64)
    same(spark, [(i, [0.5] * 8, None) for i in range(50)])


def test_vectors_that_cannot_be_coded(spark):
    good = [(i, [i / 10, -i / 7] * 8, 1) for i in range(20)]
    bad = [(100, None, 1), (-1, [float("nan")] * 16, 1), (-2, [None] + [0.1] * 15, 1), (-3, [float("inf")] * 16, 2)]
    got = same(spark, good + bad)
    assert {r[0] for r in got} == set(range(20))
    # Empty vectors and vectors of another length have no parts to compare.
    odd = V.codes(frame(spark, good + [(-4, [], 1), (-5, [0.1] * 24, 1)]))
    assert sorted(map(tuple, odd.collect()), key=str) == sorted(got, key=str)


def test_few_rows_and_none(spark):
    same(spark, [(3, [0.1, -0.2, 0.3], 1)])  # fewer components than parts
    empty = V.codes(frame(spark, []))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large for integer distances"):
        V.codes(frame(spark, [(i, [1e30] * 8, 1) for i in range(3)])).collect()


def test_trees_prune_and_stay_exact():
    """Clustered points: whole nodes are assigned, and every point still gets its nearest entry."""
    rnd = np.random.default_rng(1)
    centres = rnd.integers(-4000, 4000, (16, 8))
    points = (centres[rnd.integers(0, 16, 2048)] + rnd.integers(-40, 40, (2048, 8))).astype(np.int64)
    tree, book = V.Tree.build(points), V.EntryTree(centres.astype(np.int64))
    compared = whole = 0
    for level, which, _ in V.assign(tree, book):
        if level < 0:
            compared += len(which)
        else:
            whole += len(V._spans(tree, level, which)[0])
    assert compared + whole == 2048 and whole > 1000
    distance = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    chosen, error = V.nearest(tree, book)
    assert (chosen == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
    total, count = V.sums(tree, book)
    for k in range(16):
        assert (total[k] == points[chosen == k].sum(axis=0)).all() and count[k] == (chosen == k).sum()
