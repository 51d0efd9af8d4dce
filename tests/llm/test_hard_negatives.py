"""Hard negatives against plain Python, and what the trees promise."""

import math
import random

import numpy as np
import pytest

from pixeltally.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, place string, id string, score string"


def brute(rows, every=50, positives=5, negatives=3):
    """The definition, with Python's integers."""
    good = []
    for number, (vec_id, vector, label, *_) in enumerate(rows):
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((number, vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  shorter vectors end in zeros
    found = []
    for number, anchor, vector, label in good:
        if anchor % every:
            continue
        same = sorted((-score(vector, v), i) for n, i, v, other in good if other == label and n != number)[:positives]
        for least, positive in same:
            p = -least
            fits = sorted((-s, i) for _, i, v, other in good if other != label
                          and 50 * p <= 100 * (s := score(vector, v)) <= 95 * p)[:negatives]
            found += [(anchor, positive, rank, i, p, -s) for rank, (s, i) in enumerate(fits, 1)]
    return sorted(found)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "p", "i", "s") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.mine(df, **more).collect())


def clouds(n, dims, seed, spread=0.3):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(6, dims))
    vectors = centres[dice.integers(0, 6, n)] + spread * dice.normal(size=(n, dims))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return [(i, [float(x) for x in v], int(dice.integers(0, 3))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("blocks", [4096, 40])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(hn, "QUERY_ROWS", 3)
    rows = clouds(400, 7, 1)
    rows += [(i + 400, *rows[i % 5][1:]) for i in range(60)]  # equal rows, ties by id
    expected = brute(rows, every=20)
    assert len(expected) > 100
    # One anchor to a set, or all in one.
    assert mined(spark, rows, every=20) == expected
    assert mined(spark, rows, every=20, query_bytes=2000) == expected


def test_odd_rows(spark):
    dice = random.Random(3)
    vector = lambda n=4: [dice.uniform(-1, 1) for _ in range(n)]
    rows = [
        (0, vector(), 1), (50, vector(), 2), (100, [0.0] * 4, 1), (150, [], 2), (200, vector(2), 1), (None, vector(), 1),
        (250, None, 1), (300, vector(), None), (350, [1.0, None, 0.0, 0.0], 1), (400, [1.0, float("nan"), 0.0, 0.0], 1),
        (450, [float("inf"), 0.0, 0.0, 0.0], 2), (500, vector(), 9), (50, vector(), 2), (50, vector(), 2),
        (-50, vector(), 2), *[(i, vector(), i % 3) for i in range(1, 40)]]
    assert mined(spark, rows) == brute(rows)


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], None), (50, None, 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []  # no positive
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]


@pytest.mark.parametrize("size", [1, 60, 40_000, 4_000_000])
def test_scores_are_exact_at_every_size(spark, size):
    """Single and double precision, and whole numbers beyond both."""
    dice = random.Random(size)
    rows = [(i, [float(np.float32(dice.uniform(-size, size))) for _ in range(5)], i % 2) for i in range(60)]
    expected = brute(rows, every=10)
    assert expected and max(abs(r[4]) for r in expected) >= size ** 2
    assert mined(spark, rows, every=10) == expected


def test_trees_cover_and_keep_apart():
    rows = np.array([v for _, v, _ in clouds(500, 6, 4)]) * 256
    norm2 = np.einsum("ij,ij->i", rows, rows).max()
    points = hn._augmented(rows, norm2)
    assert np.allclose(np.linalg.norm(points, axis=1), np.sqrt(norm2))
    tree = hn.Tree(rows, norm2, (1, 4, 16, 64))
    at = tree.leaf
    for level in reversed(range(len(tree.sizes))):
        gap = np.linalg.norm(points - points[tree.centres[at]], axis=1)
        assert (gap <= tree.radii[level][at]).all()
        size = tree.sizes[level]
        among = np.linalg.norm(points[tree.centres[:size], None] - points[None, tree.centres[:size]], axis=2)
        nearest = np.linalg.norm(points[:, None] - points[tree.centres[:size]][None], axis=2).min(axis=1)
        if size > 1:
            assert among[np.triu_indices(size, 1)].min() >= nearest.max() - 1e-9
        if level:
            at = tree.parents[level][at]


def test_leaves_outside_the_windows_are_skipped():
    """Tight clouds: a query scores a small part of the rows, and still finds the best of them."""
    rows = np.array([v for _, v, _ in clouds(4000, 16, 5, spread=0.02)]) * 256
    norm2 = np.einsum("ij,ij->i", rows, rows).max()
    asked = rows[::200]
    n = len(asked)
    queries = hn.Queries(np.full(n, -1), np.zeros(n, int), asked, np.full((n, 1), -np.inf), np.full((n, 1), np.inf), 5, same=True)
    everything = np.arange(len(rows))
    queries.search(hn.Tree(rows, norm2), rows, everything, everything, np.zeros(len(rows), int), norm2)
    scores = asked @ rows.T
    assert queries.scored < 0.35 * scores.size
    queries.top.settle()
    windows, found, ids = queries.top.found[0]
    for i in range(n):
        best = np.lexsort((everything, -scores[i]))[:5]
        assert np.array_equal(ids[windows == i], best)
