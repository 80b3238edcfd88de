from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import hard_negatives as hn
from weftline.llm import rotated_codes as rc

SCHEMA = "vec_id long, embedding array<float>, label int, c int, q string, v string, code int, row int"
NAN, INF = float("nan"), float("inf")


def _table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "q", "v", 2, 3) for i, v, label in rows], SCHEMA)


def _random(n, width, seed, n_labels=4, whole=False):
    rng = np.random.default_rng(seed)
    v = rng.integers(-3, 4, (n, width)) / 4 if whole else rng.standard_normal((n, width)).astype(np.float32)
    return [(int(i), [float(x) for x in row], int(rng.integers(n_labels))) for i, row in enumerate(v)]


def _usable(rows, zero):
    return [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and (zero or any(r[1]))]


AWKWARD = [
    (None, [1.0, 2.0, 0.5], 0), (900, None, 1), (901, [], 1), (902, [None, 1.0, 0.0], 1), (903, [NAN, 1.0, 0.0], 1), (904, [INF, 0.0, 0.0], 0),
    (905, [0.0, 0.0, 0.0], 0), (906, [0.25, 0.5], 0), (907, [0.25, 0.5, 0.75, 1.0], 1), (908, [0.5, 0.5, 0.5], None),
]


def _nearest(rows, every, k):
    """Brute force over rows whose (id, vector) are distinct."""
    width = max((len(v) for _, v, _ in rows), default=0)
    padded = sorted({(i, tuple(np.float64(np.float32(x)) for x in v) + (0.0,) * (width - len(v))) for i, v, _ in rows})
    out = []
    for q, x in padded:
        if q % every == 0:
            far = []
            for i, y in padded:
                if i != q:
                    total = 0.0
                    for a, b in zip(y, x):
                        total += (a - b) ** 2
                    far.append((math.sqrt(total), i))
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(far)[:k])]
    return sorted(out)


@pytest.mark.parametrize("whole", [False, True])
def test_nearest_equals_brute_force(spark, whole):
    rows = _random(300, 3, 5, whole=whole) + AWKWARD  # whole: few different vectors, so many ties and copies
    df = rc.nearest(_table(spark, rows), F.col("vec_id") % 20 == 0, k=7, candidate_block=64, query_block=8, epsilon=6.0)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, df.collect())) == _nearest(_usable(rows, zero=False), 20, 7)


def test_recall_is_at_least_nine_tenths(spark):
    rows = _random(3000, 48, 9)
    found = {(r.query_id, r.vec_id) for r in rc.nearest(_table(spark, rows), F.col("vec_id") % 100 == 0).collect()}
    want = {(q, i) for q, _, i, _ in _nearest(rows, 100, 10)}
    assert len(found) == len(want) and len(found & want) >= 0.9 * len(want)


def test_bounds_hold_and_codes_are_packed():
    rng = np.random.default_rng(3)
    v, q = rng.standard_normal((400, 24)), rng.standard_normal((30, 24))
    code, length, fit = rc.encode(v, v.mean(0), 256)
    assert code.shape == (400, 32) and code.dtype == np.uint8
    low, high = rc.bounds(code, length, fit, q, v.mean(0), 1.9)
    real = ((v[:, None] - q[None]) ** 2).sum(2)
    assert ((low <= real) & (real <= high)).mean() > 0.9
    assert (low > np.sort(real, axis=0)[10]).mean() > 0.5  # and they rule most rows out


def test_copies_of_a_vector_stay_few(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(500)] + [(1000, [1.0, 2.0], 0)] * 40 + [(2000, [5.0, 5.0], 0)]
    table = _table(spark, rows)
    coded, _ = rc.index(table, k=3)
    assert coded.count() <= 5
    got = sorted(map(tuple, rc.nearest(table, F.col("vec_id").isin(0, 1000, 2000), k=3).collect()))
    far = math.sqrt(4.0**2 + 3.0**2)
    assert got == [
        (0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 0.0), (1000, 1, 0, 0.0), (1000, 2, 1, 0.0), (1000, 3, 2, 0.0),
        (2000, 1, 0, far), (2000, 2, 1, far), (2000, 3, 2, far),
    ]


def test_repeated_rows_are_candidates_each_and_one_query(spark):
    rows = [(0, [1.0, 0.0], 0)] * 3 + [(1, [1.0, 0.0], 0)] * 2 + [(2, [0.0, 1.0], 0)]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in rc.nearest(_table(spark, rows), F.col("vec_id") == 0, k=4).collect())
    assert got == [(0, 1, 1), (0, 2, 1), (0, 3, 2)]


def _mined(rows, every, scale=256):
    rows = {(i, label, tuple(math.floor(scale * np.float64(np.float32(x))) for x in v)) for i, v, label in rows}
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in rows:
        if a[0] % every:
            continue
        seen = [(-score(a[2], c[2]), c[0], c[1] == a[1]) for c in rows if c[0] != a[0]]
        for s, p, _ in sorted(x for x in seen if x[2])[:5]:
            near = sorted((t, i) for t, i, same in seen if not same and 50 * -s <= 100 * -t <= 95 * -s)
            out += [(a[0], p, n + 1, i, -s, -t) for n, (t, i) in enumerate(near[:3])]
    return Counter(out)


@pytest.mark.parametrize("whole", [False, True])
def test_hard_negatives_equal_brute_force(spark, whole):
    rows = _random(400, 4, 2, whole=whole) + AWKWARD + [(20, [0.5, 0.25, 0.5, 1.0], 3)] * 2 + [(41, [0.5, 0.5, 0.5, 0.5], 3)] * 3
    df = hn.hard_negatives(_table(spark, rows), F.col("vec_id") % 20 == 0, bucket=32, candidate_block=100, query_block=8)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    usable = [r for r in _usable(rows, zero=True) if r[2] is not None]
    assert Counter(map(tuple, df.collect())) == _mined(usable, 20)


def test_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(1)
    v = np.round(rng.standard_normal((2000, 6)) * rng.exponential(50, (2000, 1)) * [9, 4, 1, 1, 1, 1]).astype(np.int64)
    anchors = hn.Anchors(v[:20])
    real = hn.scores(anchors.vectors, v)
    least = np.sort(real, axis=1)[:, -8].astype(float)
    seen = [set() for _ in range(20)]
    scored = 0
    for a, rows, score in hn.pruned(anchors, hn.buckets(v, 256), lambda: least):
        assert (real[a, rows] == score).all()
        seen[a] |= set(rows[score >= least[a]])
        scored += len(rows)
    assert seen == [set(np.flatnonzero(line >= t)) for line, t in zip(real, least)]
    assert scored < 0.5 * real.size


def test_scores_stay_exact_beyond_doubles():
    a = np.array([[2**30 + 1, 3]])
    assert hn.scores(a, a)[0, 0] == (2**30 + 1) ** 2 + 9
    big = np.array([[2**62, 2**62]])
    assert hn.scores(big, big)[0, 0] == 2**63 - 1 and hn.scores(big, -big)[0, 0] == -(2**63)


@pytest.mark.parametrize("rows", [[], [(0, None, 0)], [(0, [1.0], 0)]])
def test_too_few_rows_give_none(spark, rows):
    table = _table(spark, rows)
    assert rc.nearest(table, F.col("vec_id") % 10 == 0).collect() == []
    assert hn.hard_negatives(table, F.col("vec_id") % 10 == 0).collect() == []


def test_huge_numbers_do_not_crash(spark):
    rows = [(i, [x, 1.0], i % 2) for i, x in enumerate([1e300, -1e300, 1e308, 1.0, 2.0, 1e300])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {(r.query_id, r["rank"]): r.vec_id for r in rc.nearest(table, F.col("vec_id").isin(0, 3), k=3).collect()}
    assert got[0, 1] == 5 and got[3, 1] == 4
    assert hn.hard_negatives(table, F.col("vec_id") == 0).count() >= 0
