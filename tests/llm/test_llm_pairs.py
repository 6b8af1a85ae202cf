"""Near duplicates, repeated passages and nearest vectors against brute force, and odd rows."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from facetmill.llm import components, jaccard, substrings, topk


def words_of(text):
    return (text or "").encode().split()


def plain_groups(rows, words=5, percent=80):
    """[(id, size, least id of the component)] by comparing all pairs."""
    sets = []
    for i, text in rows:
        w = [x.lower() for x in words_of(text)]
        sets.append((i, {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                r, s = root(i), root(j)
                parent[max(r, s)] = min(r, s)
    return collections.Counter((i, len(x), None if i is None else root(i)) for i, x in sets)


def texts_with_copies(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 9, 40, 60, 120]))] for _ in range(n // 6)]
    line = [rng.choice(vocabulary) for _ in range(12)]
    out = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.5:
            w += line
        out.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
    return list(enumerate(out))


@pytest.mark.parametrize("limits", [{}, {"small_bucket": 2, "tile_rows": 3}])
def test_groups_equal_all_pairs(spark, limits):
    rows = texts_with_copies(11, 240)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = collections.Counter(map(tuple, jaccard.group(docs, **limits).collect()))
    assert got == plain_groups(rows)


def test_groups_of_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert collections.Counter(map(tuple, jaccard.digest(odd_documents).collect())) == plain_groups(rows)
    assert jaccard.digest(no_documents).count() == 0
    kept = jaccard.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 10, 11]


@pytest.mark.parametrize("limits", [{}, {"small_bucket": 2, "tile_rows": 3}])
def test_groups_of_ids_with_several_texts(spark, limits):
    rows = [((i * 7) % 150 - 20, text) for i, text in texts_with_copies(12, 240)]
    one, two, three = (" ".join(f"{k}{i}" for i in range(40)) for k in "xyz")
    # 2007 holds two classes of other least ids, 3001 links one near copy by each of its texts, 3005 has a row without words.
    rows += [(2007, one), (2003, one), (2007, two), (2001, two + " end"), (3001, one.upper() + " a b"), (3001, three), (3002, three + " end"), (3005, three), (3005, None), (3006, None), (3006, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = collections.Counter(map(tuple, jaccard.group(docs, **limits).collect()))
    assert got == plain_groups(rows)


def test_tiles_list_few_pairs_of_long_texts_that_share_a_passage(spark, monkeypatch):
    passage = [f"p{i}" for i in range(150)]
    rows = [(i, " ".join([*passage, *(f"d{i}w{k}" for k in range(2400))])) for i in range(60)]
    # Two near copies that the star of their bucket does not find.
    rows += [(60, " ".join([*passage, *(f"ew{k}" for k in range(2400))])), (61, " ".join([*passage, *(f"ew{k}" for k in range(2390))]))]
    made, tile_pairs = [], jaccard.tile_pairs
    monkeypatch.setattr(jaccard, "tile_pairs", lambda *args: made.append(tile_pairs(*args)) or made[-1])
    got = collections.Counter(map(tuple, jaccard.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == plain_groups(rows)
    # Once for each of 20 or so shared hashes it would be above 30,000.
    assert made[0].count() < len(rows)


def test_prefix_and_bitmap_bounds_hold():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (1, 4, 5, 10, 99, 100, 101, 5000):
        assert jaccard.prefix_length(n) == n - -(-80 * n // 100) + 1
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: n * 9 // 10], rng.integers(0, 2**63, n // 5 + 1).astype(np.uint64))))
        x, y = (np.frombuffer(jaccard.bitmap(s), np.uint64) for s in (a, b))
        words = min(len(x), len(y))
        x, y = jaccard.fold(x, words), jaccard.fold(y, words)
        bound = min(len(a) - np.bitwise_count(x & ~y).sum(), len(b) - np.bitwise_count(y & ~x).sum())
        assert bound >= len(np.intersect1d(a, b))


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5), (300, 200)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 300: 200}


def plain_repeats(rows, window=20):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    for i, text in order:
        w = words_of(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            place = (i is not None, i or 0, k)
            first[key] = min(first.get(key, place), place)
    out = collections.Counter()
    for i, text in rows:
        w = words_of(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < (i is not None, i or 0, k):
                gone[k:k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_repeats_equal_plain_search(spark):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(50)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 70))] for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 40))] for _ in range(rng.randint(0, 6))]
        rows.append((i // 2 if i > 110 else i, rng.choice([" ", "\n", "  "]).join(w for p in parts for w in p)))
    rows += [(500, "loop " * 300), (501, "x " + "loop " * 30), (None, "loop " * 25), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert collections.Counter(map(tuple, substrings.digest(docs).collect())) == plain_repeats(rows)


def test_repeats_of_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert collections.Counter(map(tuple, substrings.digest(odd_documents).collect())) == plain_repeats(rows)
    assert substrings.digest(no_documents).count() == 0


def plain_nearest(rows, k=10):
    import math

    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in whole if i % 100 == 0}):
        vector = min(v for i, v in whole if i == q)
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in whole if i != q and len(v) == len(vector))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [40, 100_000])
def test_nearest_equals_all_pairs(spark, shard_rows):
    rng = random.Random(4)
    near = [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)] if i % 3 else list(near)) for i in range(501)]
    rows += [(600, None), (700, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (800, [float("nan")] * 6), (900, [float("inf")] * 6), (1000, [1.0, 2.0]), (1001, [3.0, 1.0])]
    rows += [(100, [0.5] * 6), (200, list(near)), (None, list(near)), (2000, []), (3000, [1e4] * 6)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, query int, shard string")
    import numpy as np

    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.search(table, F.col("vec_id") % 100 == 0, shard_rows=shard_rows)
    assert sorted(map(tuple, got.collect())) == plain_nearest(exact)
    assert topk.digest(table.limit(0)).count() == 0
