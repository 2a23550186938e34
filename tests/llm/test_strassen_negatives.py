import math
import random

import numpy as np
import pytest

from salesmart.llm import strassen_negatives as sn

SMALL = sn.Settings(anchor_values=40, row_values=200, tile=7, leaf=2)
DDL = "vec_id long, embedding array<float>, label int, rank string, group string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DDL).repartition(3)


def brute(rows, settings, every):
    good = {}
    for name, vector, label in rows:
        if None in (name, label) or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        scaled = [math.floor(settings.scale * float(np.float32(x))) for x in vector]
        if sum(float(x) ** 2 for x in scaled) < sn.LONGEST:
            good[name] = min(good.get(name, (label, scaled)), (label, scaled))
    out = []
    for a, (la, va) in good.items():
        if a % every:
            continue
        scores = {b: sum(x * y for x, y in zip(va, vb)) for b, (_, vb) in good.items()}
        order = sorted(scores, key=lambda b: (-scores[b], b))
        for p in [b for b in order if b != a and good[b][0] == la][:settings.positives]:
            fits = [b for b in order if good[b][0] != la
                    and settings.low_percent * scores[p] <= 100 * scores[b] <= settings.high_percent * scores[p]]
            out += [(a, p, rank, b, scores[p], scores[b]) for rank, b in enumerate(fits[:settings.negatives], 1)]
    return sorted(out)


def mined(spark, rows, settings, every=5):
    found = sn.mine(frame(spark, rows), lambda c: c % every == 0, settings)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 9), (16, 16, 16), (33, 64, 70), (64, 3, 40), (0, 4, 3), (3, 4, 0)])
def test_products_are_exact(shape):
    m, k, n = shape
    r = np.random.default_rng(1)
    a, b = r.integers(-2**27, 2**27, (m, k)), r.integers(-2**27, 2**27, (k, n))
    assert (sn.multiply(a, b, 2) == a.astype(object) @ b.astype(object)).all()


def test_the_recursion_is_taken(monkeypatch):
    seen = []
    whole = sn.multiply
    monkeypatch.setattr(sn, "multiply", lambda a, b, leaf: seen.append(a.shape) or whole(a, b, leaf))
    sn.multiply(np.ones((8, 8), np.int64), np.ones((8, 8), np.int64), 4)
    assert seen.count((4, 4)) == 7


def test_heaps_merge_like_one_sort():
    r = random.Random(3)
    heaps, all_of = sn.Heaps.empty(2, 4), [[], []]
    for _ in range(6):
        ids = [[r.randrange(1000) for _ in range(3)] for _ in range(2)]
        scores = [[r.randrange(5) for _ in range(3)] for _ in range(2)]
        for i in range(2):
            all_of[i] += zip(scores[i], ids[i])
        heaps.merge(np.arange(2), np.array(scores), np.array(ids))
    for i in range(2):
        best = sorted(all_of[i], key=lambda x: (-x[0], x[1]))[:4]
        assert list(zip(heaps.scores[i].tolist(), heaps.ids[i].tolist())) == best


def test_against_brute_force_with_ties(spark):
    r = random.Random(7)
    # Few different components make many equal scores; a third of the rows have one label.
    rows = [(i, [r.choice((-0.5, 0.0, 0.25, 0.5)) for _ in range(6)], r.choice((0, 0, 0, 1, 2, 3, 4))) for i in range(150)]
    for settings in (SMALL, sn.Settings(), sn.Settings(least_rows=20)):
        got = mined(spark, rows, settings)
        assert got == brute(rows, settings, 5) and len(got) > 50


def test_spread_vectors(spark):
    r = random.Random(8)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(12)], i % 4) for i in range(200)]
    assert mined(spark, rows, SMALL) == brute(rows, SMALL, 5)


def test_odd_rows(spark):
    r = random.Random(9)
    rows = [(i, [r.choice((0.25, 0.5, 1.0)) for _ in range(4)], i % 3) for i in range(40)]
    rows += [(None, [1.0] * 4, 1), (100, None, 1), (105, [1.0, None, 0.0, 0.0], 1), (110, [float("nan")] * 4, 1), (115, [float("inf")] * 4, 2)]
    rows += [(120, [1.0] * 4, None), (125, [1e30] * 4, 1), (130, [1.0, 0.5], 1), (135, [], 2), (140, [0.5] * 9, 0), (-5, [1.0] * 4, 2)]
    rows += rows[:12] + [(10, [0.0] * 4, 9), (15, [9.0] * 4, 0)]  # whole repeats, and others of the same id
    got = mined(spark, rows, SMALL)
    assert got == brute(rows, SMALL, 5) and got


def test_no_anchor_no_rows(spark):
    assert mined(spark, [], SMALL) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)], SMALL) == []
    assert mined(spark, [(5, [1.0], 1)], SMALL) == []
    assert mined(spark, [(5, [1.0], 1), (6, [1.0], 2)], SMALL) == []  # no positive
    assert mined(spark, [(5, [1.0], 1), (6, [-1.0], 1), (7, [-0.7], 2)], SMALL) == []  # no window below zero
    assert mined(spark, [(5, [0.0], 1), (6, [1.0], 1), (7, [-0.7], 2)], SMALL) == [(5, 6, 1, 7, 0, 0)]
