import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterscope.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, vector array<double>, key string, score string, slot int"


def brute(rows, anchor):
    """Rows (vec_id, label, vector) that take part, scored one by one."""
    out = []
    anchors = {(i, y, tuple(v)) for i, y, v in rows if anchor(i)}
    for i, y, v in anchors:
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(v, w, strict=False)), j, z) for j, z, w in rows)
        same = [(-s, j) for s, j, z in scored if z == y and j != i][:5]
        for top, j in same:
            fits = [(-s, k) for s, k, z in scored if z != y and 80 * top <= -100 * s <= 100 * top][:5]
            out += [(i, j, r + 1, k, top, s) for r, (s, k) in enumerate(fits)]
    return sorted(out)


def random_rows(seed, n, width, spread, labels=3):
    rng = random.Random(seed)
    centres = [[rng.randrange(-200, 200) for _ in range(width)] for _ in range(4)]
    return [(k, rng.randrange(labels), [float(c + rng.randrange(-spread, spread + 1)) for c in rng.choice(centres)]) for k in range(n)]


def search(spark, rows, every=10):
    table = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.hard_negatives(spark, table, F.col("vec_id") % every == 0).collect())


@pytest.mark.parametrize("spread", [1, 60, 400])
def test_equals_brute_force(spark, spread):
    rows = random_rows(spread, 300, 6, spread)
    got = search(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0) and got


def test_ties_repeated_rows_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, k % 2, [4.0, 0.0]) for k in range(40)]  # all scores are equal
    rows += [(10, 0, [4.0, 0.0]), (11, 1, [4.0, 0.0]), (50, 0, []), (51, 1, [3.0]), (60, 1, [4.0, 1.0, 5.0]), (70, 1, [-9.0, -9.0]), (80, 5, [7.0])]
    odd = [(90, None, [1.0]), (None, 1, [1.0]), (100, 1, None), (110, 1, [1.0, None]), (120, 1, [nan]), (130, 1, [inf, 1.0]), (140, 1, [-inf])]
    assert search(spark, rows + odd) == brute(rows, lambda i: i % 10 == 0)


def test_empty_tables_and_no_anchors(spark):
    for rows in ([], [(3, 1, [1.0])], [(10, 1, [2.0])]):
        assert search(spark, rows) == []
    assert search(spark, [(10, 1, []), (11, 1, []), (12, 0, [])]) == [(10, 11, 1, 12, 0, 0)]


def test_many_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hn, "MEMBERS", 4)
    monkeypatch.setattr(hn, "LISTS", 2)
    monkeypatch.setattr(hn, "STEP", 16)
    rows = random_rows(11, 240, 5, 80)
    assert search(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_large_numbers_stay_exact(spark):
    rows = [(i, y, [x * 1_000.0 for x in v]) for i, y, v in random_rows(12, 120, 5, 80)]
    assert search(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_a_walk_ends_once_its_bound_is_below_what_is_needed():
    """With rows in tight clusters members look at a part of the list, and find what a full search finds."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(8, 16)) * 200
    of = rng.integers(0, 8, 20_000)
    vectors = np.floor(centres[of] + rng.normal(size=(20_000, 16)) * 20)
    ids, labels = np.arange(20_000), rng.integers(0, 3, 20_000)
    anchors = np.arange(0, 20_000, 400)
    centroids = hn.spherical_means(vectors[anchors], 8)
    clusters = np.argmax(hn._unit(vectors[anchors]) @ centroids.T, axis=1)
    block = hn.anchor_block(ids[anchors], labels[anchors], vectors[anchors], clusters, clusters, centroids)
    best = hn.Best(len(anchors), 5)

    def offer(members, scores, there, numbers):
        m, r = np.nonzero((block.labels[members][:, None] == there) & (block.ids[members][:, None] != numbers))
        best.offer(members[m], scores[m, r], numbers[r])

    looked = hn.walk(block, vectors, labels, ids, lambda members: best.scores[members, -1], offer)
    assert looked < 0.5 * len(anchors) * len(ids)
    for k, i in enumerate(block.ids):
        scores = vectors @ vectors[i]
        others = sorted((-scores[j], j) for j in ids if j != i and labels[j] == labels[i])[:5]
        assert best.ids[k].tolist() == [j for _, j in others]


def test_no_bound_is_below_a_score():
    rng = np.random.default_rng(3)
    rows, members = rng.normal(size=(500, 8)), rng.normal(size=(40, 8))
    centre = hn._unit(members.sum(axis=0)[None])
    block = hn.anchor_block(np.arange(40), np.zeros(40), members, np.zeros(40, int), np.zeros(40, int), centre)
    limit = hn.bounds(rows, block.groups[0])
    scores = rows @ members.T / np.linalg.norm(members, axis=1)
    assert (scores <= limit[:, None] + 1e-9).all()
