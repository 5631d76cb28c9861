"""Hard negatives against all scores, the pruning against what it must keep, and odd tables."""

import random

import numpy as np
import pytest

from lexigrid.llm import hard_negatives as hard

SCHEMA = "id long, label int, vector array<long>, anchor boolean, row long, score long, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


def brute(rows, positives=5, negatives=10, low=30, high=90):
    known = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]

    def best(scored):
        return sorted(scored, key=lambda x: (-x[1], x[0] is None, x[0] or 0))

    out = []
    for i, (anchor, label, vector, asks) in enumerate(known):
        if not asks:
            continue
        scored = [(j, r, sum(x * y for x, y in zip(vector, r[2], strict=False))) for j, r in enumerate(known)]
        near = best([(r[0], s) for j, r, s in scored if r[1] == label and j != i])
        far = best([(r[0], s) for _, r, s in scored if r[1] != label])
        for positive, score in near[:positives]:
            held = [x for x in far if low * score <= 100 * x[1] <= high * score]
            out += [(anchor, positive, k + 1, x[0], score, x[1]) for k, x in enumerate(held[:negatives])]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    return sorted(map(tuple, hard.HardNegatives(table(spark, rows), **options).found.collect()), key=repr)


def draw(seed, n=300, width=6, top=300):
    rng = random.Random(seed)
    centres = [[rng.randrange(-top, top) for _ in range(width)] for _ in range(4)]
    return [(i, i % 4, [x + rng.randrange(-top // 4, top // 4) for x in centres[rng.randrange(4)]], i % 5 == 0) for i in range(n)]


@pytest.mark.parametrize("seed,block", [(1, 8192), (2, 13)])
def test_all_scores(spark, seed, block):
    rows = draw(seed)
    assert found(spark, rows, block=block) == brute(rows)
    assert found(spark, rows, positives=2, negatives=3, low=10, high=99) == brute(rows, 2, 3, 10, 99)


def test_nulls_ties_repeated_rows_and_short_vectors(spark):
    rng = random.Random(3)
    odd = [None, [], [None, 1], [0] * 6]
    rows = [
        (i % 40 if i % 9 else None, i % 4 if i % 11 else None,
         [rng.choice([0, 0, 1, -3, 2, 300]) for _ in range(rng.choice([3, 6]))] if i % 13 else rng.choice(odd), i % 5 == 0)
        for i in range(300)
    ]
    assert found(spark, rows) == brute(rows)
    same = [(i, i % 2, [3, 4], i % 100 == 0) for i in range(1500)]  # one vector, more rows than a bucket
    assert found(spark, same) == []  # all scores are equal, none is in the band
    assert found(spark, same, high=100) == brute(same, high=100)


def test_nothing_to_find(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, 1, [1], None), (2, 2, [1], False)]) == []
    assert found(spark, [(1, 1, [], True), (2, 1, [], False), (3, 2, [], False)], low=0, high=100) == [(1, 2, 1, 3, 0, 0)]


def test_scores_beyond_doubles_and_64_bits(spark):
    rows = [(i, i % 2, [2**29 + i, -(2**28) * (i % 3), 1], i < 2) for i in range(30)]
    assert found(spark, rows) == brute(rows)
    huge = [(i, i % 2, [2**62, i], i == 0) for i in range(6)]  # scores stop at the largest long
    most = 2**63 - 1
    assert found(spark, huge, high=100) == [(0, p, k + 1, n, most, most) for p in (2, 4) for k, n in enumerate((1, 3, 5))]


def test_other_labels_and_components(spark):
    rows = [(i, "xy"[i % 2], [0.5 * i, float("nan") if i == 4 else 1.0, None if i == 5 else 2.0], i == 0) for i in range(8)]
    frame = spark.createDataFrame(rows, "id long, label string, raw array<float>, anchor boolean")
    frame = frame.where(hard.finite(frame.raw)).withColumn("vector", hard.quantised(frame.raw))
    whole = [(i, c, [int(256 * x // 1) for x in v], a) for i, c, v, a in rows if i not in (4, 5)]
    assert sorted(map(tuple, hard.HardNegatives(frame).found.collect()), key=repr) == brute(whole)


@pytest.mark.parametrize("width,spread", [(2, 0.05), (8, 0.3), (64, 1.0)])
def test_pruning_loses_nothing_and_passes_rows_over(width, spread):
    draw_from = np.random.default_rng(width)
    centres = draw_from.normal(size=(40, width))
    vectors = ((centres[draw_from.integers(40, size=1500)] + spread * draw_from.normal(size=(1500, width))) * 300).astype(np.int64)
    bucket = hard.Bucket(np.arange(1000), np.arange(1000), np.zeros(1000, int), vectors[:1000])
    anchors = hard.Anchors(np.arange(500), np.zeros(500, int), vectors[1000:])
    scores = vectors[1000:] @ vectors[:1000].T
    which, kept = np.arange(500), 0
    for least, most in [(np.sort(scores)[:, -5], np.full(500, hard.MOST)), (np.sort(scores)[:, -60], np.sort(scores)[:, -30]), (np.full(500, -50), np.full(500, 50))]:
        at, row = hard.candidates(bucket, anchors, which, least, most)
        assert len(set(zip(at.tolist(), row.tolist(), strict=True))) == len(at)
        counted = np.zeros(scores.shape, bool)
        counted[at, row] = True
        assert counted[(scores >= least[:, None]) & (scores <= most[:, None])].all()
        kept = kept or len(at)
    assert kept < {2: 0.3, 8: 0.6, 64: 1.0}[width] * scores.size
