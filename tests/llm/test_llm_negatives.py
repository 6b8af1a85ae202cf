"""Hard negatives against brute force, their bounds, and odd rows."""

import math
import random

import numpy as np
import pytest

from facetmill.llm import negatives

MOST = (1 << 63) - 1


def plain(rows):
    """[(anchor, positive, rank, negative, positive score, negative score)] by scoring all pairs."""
    use = []
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    score = lambda a, b: max(-MOST - 1, min(MOST, sum(x * y for x, y in zip(a, b))))
    out = []
    for a in sorted({i for i, _, _ in use if i % 100 == 0}):
        label, v = min((lab, w) for i, lab, w in use if i == a)
        others = sorted((-score(v, w), i, lab) for i, lab, w in use if i != a and len(w) == len(v))
        for s, p, _ in [o for o in others if o[2] == label][:5]:
            p_score = -s
            hard = [(i, -t) for t, i, lab in others if lab != label and 80 * p_score <= -100 * t <= 100 * p_score][:5]
            out += [(a, p, r + 1, i, p_score, t) for r, (i, t) in enumerate(hard)]
    return sorted(out)


def exact(rows):
    return [(i, g, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, g, v in rows]


@pytest.mark.parametrize("shard_values", [700, negatives.SHARD_VALUES])
def test_negatives_equal_all_pairs(spark, shard_values):
    rng = random.Random(4)
    centers = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(4)]
    rows = []
    for i in range(-100, 500):
        c = rng.choice(centers)
        v = [x + rng.gauss(0, 0.3) for x in c] if i % 5 else list(centers[1])  # a fifth are copies of one vector
        rows.append((i, rng.randrange(-2, 6) if i % 3 else 1, v))
    rows += [(600, 1, None), (700, 1, [1.0, None] * 10), (800, None, centers[0]), (900, 1, [float("nan")] * 20), (1000, 2, [float("inf")] * 20), (1100, 3, [])]
    rows += [(1200, 1, [3.0, 4.0]), (1201, 1, [3.0, 4.0]), (1202, 2, [3.0, 3.5]), (None, 1, centers[0]), (1300, 99, centers[0]), (1301, 99, centers[0])]
    rows += [(100, 1, centers[1]), (100, 0, centers[2]), (701, 1, centers[1]), (701, 1, centers[1])] + [(702, 1, centers[1])] * 7 + [(703, 2, centers[1])] * 7
    table = spark.createDataFrame([(i, v, g, 1, "x", 2) for i, g, v in rows], "vec_id long, embedding array<float>, label int, part int, v string, copies int")
    from pyspark.sql import functions as F

    got = negatives.mine(table, F.col("id") % 100 == 0, negatives.noisy_label(), shard_values=shard_values)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    # A positive that occurs twice brings its negatives twice.
    assert sorted(map(tuple, got.collect())) == plain(exact(rows))
    assert negatives.digest(table.limit(0)).count() == 0


def test_large_components_score_exactly_or_count_as_the_nearest(spark):
    rng = random.Random(6)
    rows = [(i, i % 2, [rng.choice([-1, 1]) * rng.uniform(1e5, 2e5) * 2**8 for _ in range(4)]) for i in range(0, 60)]
    rows += [(100 + i, i % 2, [3e9 * (1 + i), 1.0]) for i in range(6)] + [(200, 0, [-3e9, 1.0]), (300, 1, [3e38, -3e38, 1.0]), (301, 1, [3e38, 3e38, 1.0]), (302, 0, [3e38, 0.0, 1.0])]
    table = spark.createDataFrame([(i, v, g) for i, g, v in rows], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, negatives.digest(table).collect())) == plain(exact(rows))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(7)
    for n in (1, 3, 4, 17, 64, 100):
        rows, q = np.floor(256 * rng.normal(size=(300, n)) + rng.normal(size=(300, 1)) * 300), np.floor(256 * rng.normal(size=(1, n)) + 200)
        exact_ = (rows @ q[0])
        last = None
        for starts in negatives.segment_bounds(n):
            (m, s), (a, b) = negatives.summaries(rows, starts), negatives.summaries(q, starts)
            low, high = m @ a[0] - s @ b[0] - 1e-3, m @ a[0] + s @ b[0] + 1e-3
            assert (low <= exact_).all() and (exact_ <= high).all()
            width = (high - low).mean()
            assert last is None or width <= last + 1e-6
            last = width
    ids = np.arange(300)
    shelf = negatives.Shelf(ids, ids % 3, np.ones(300, np.int64), rows)
    best, = shelf.search(q, np.array([-1]), None, [[(-MOST - 1, MOST), (0, 10**6)]], 5)
    for (at, scores), keep in zip(best, (exact_ > -np.inf, (exact_ >= 0) & (exact_ <= 10**6))):
        want = sorted((-s, i) for i, s in zip(ids[keep], exact_[keep]))[:5]
        assert [(-s, i) for i, s in zip(at, scores)] == want
