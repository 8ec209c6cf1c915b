"""Hard negatives against all pairs in plain Python, and bit-plane scores against plain products."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from tripweave.llm import negatives
from tripweave.llm.common import shipped

SCHEMA = "vec_id long, embedding array<float>, label int, id long, key long, parts string, score int, anchor long, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, None, "x", 2, 3, 4) for row in rows], SCHEMA)


def mined_by_hand(rows, asked, positives=5, wanted=5, share=80):
    whole = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole.append((math.inf if i is None else i, tuple(math.floor(256 * float(np.float32(x))) for x in vector), label))
    out = Counter()
    for anchor in {r for r in whole if r[0] != math.inf and asked(r[0])}:
        scored = [
            (-sum(map(int.__mul__, anchor[1], parts)), i, label)
            for i, parts, label in whole
            if i != anchor[0] and len(parts) == len(anchor[1])
        ]
        own = sorted(s for s in scored if s[2] == anchor[2])[:positives]
        for score, positive, _ in own:
            window = sorted(s for s in scored if s[2] != anchor[2] and share * -score <= 100 * -s[0] <= 100 * -score)
            for rank, (low, negative, _) in enumerate(window[:wanted], 1):
                names = [None if x == math.inf else x for x in (positive, negative)]
                out[anchor[0], names[0], rank, names[1], -score, -low] += 1
    return out


@pytest.mark.parametrize("dims, size", [(1, 1.0), (8, 1.0), (21, 0.2), (64, 0.1), (5, 3000.0)])
def test_scores_of_bit_planes(dims, size):
    rng = np.random.default_rng(dims)
    rows = np.floor(256 * size * rng.standard_normal((3000, dims))).astype(np.int64)
    anchors = np.floor(256 * size * rng.standard_normal((70, dims))).astype(np.int64)
    got = negatives.scores(negatives.bit_planes(rows), anchors)
    assert (got == rows @ anchors.T).all()
    assert (got.dtype == np.int64) == (size > 1)


def test_scores_at_the_edges():
    edge = np.array([[-1, 0], [-256, 255], [0, 0], [-(2**24), 2**24 - 1]])
    for rows in (edge, edge[:1], edge[2:3], edge[:0]):
        assert (negatives.scores(negatives.bit_planes(rows), edge) == rows @ edge.T).all()
    assert negatives.scores(negatives.bit_planes(np.zeros((3, 0), np.int64)), np.zeros((2, 0), np.int64)).tolist() == [[0, 0]] * 3


def clustered(rng, n, dims=13):
    """Vectors near few centres, of labels that cross them, so that windows are full and ties are many."""
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = centres[rng.randrange(4)]
        noise = 0 if i % 5 == 0 else 0.1
        rows.append((i, [x + rng.gauss(0, noise) if noise else x for x in centre], rng.randrange(4)))
    return rows


@pytest.mark.parametrize("block_rows", [7, 1 << 15])
def test_hard_negatives_by_hand(spark, monkeypatch, block_rows):
    shipped(spark)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block_rows)
    rows = clustered(random.Random(block_rows), 300)
    rows += [(7, None, 1), (20, [1.0, None], 2), (30, [math.nan] * 13, 1), (40, [math.inf] * 13, 1), (50, rows[3][1], None)]
    rows += [(None, rows[i][1], i % 4) for i in range(3)] + [rows[10], rows[10], rows[11], (10, rows[11][1], 3)]
    rows += [(1000 + i, [0.5, -0.5], i % 2) for i in range(12)] + [(2000, [], 1), (2010, [], 0), (2020, [], 1)]
    table = frame(spark, rows)
    got = negatives.mine(table, table.where("vec_id % 10 = 0"))
    expected = mined_by_hand(rows, lambda i: i % 10 == 0)
    assert Counter(map(tuple, got.collect())) == expected and len(expected) > 300


def test_other_numbers_of_places(spark):
    shipped(spark)
    rows = clustered(random.Random(3), 120)
    table = frame(spark, rows)
    got = negatives.mine(table, table.where("vec_id < 9"), positives=2, negatives=3, share=30)
    assert Counter(map(tuple, got.collect())) == mined_by_hand(rows, lambda i: i < 9, 2, 3, 30)


def test_nothing_to_mine(spark):
    shipped(spark)
    empty, one = frame(spark, []), frame(spark, [(0, [1.0], 1)])
    assert negatives.mine(empty, empty).count() == 0
    assert negatives.mine(one, one).count() == 0
    assert negatives.mine(one, empty).count() == 0
    assert negatives.mine(empty, one).count() == 0
