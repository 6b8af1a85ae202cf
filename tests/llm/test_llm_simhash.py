"""Fingerprints, their links and components against brute force, and odd rows."""

import collections
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from facetmill.llm import components, queries, simhash

from test_llm_pairs import texts_with_copies, words_of

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    w = [x.lower() for x in words_of(text)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_groups(nodes):
    """{node: least node of its component}; ``nodes``: node -> its codes."""
    parent = {i: i for i in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    every = [(i, c) for i, codes in nodes.items() for c in codes]
    for k, (i, x) in enumerate(every):
        for j, y in every[:k]:
            if (x ^ y).bit_count() <= 3:
                r, s = root(i), root(j)
                parent[max(r, s)] = min(r, s)
    return {i: root(i) for i in nodes}


def plain_rows(rows):
    codes = [(i, plain_fingerprint(t)) for i, t in rows]
    nodes = collections.defaultdict(set)
    for i, c in codes:
        if i is not None:
            nodes[i].add(c)
    least = plain_groups(nodes)
    return collections.Counter((i, f"{c:016x}", least.get(i)) for i, c in codes)


@pytest.mark.parametrize("hot", [simhash.HOT_CLASSES, 1])
def test_groups_equal_all_pairs(spark, hot):
    rows = texts_with_copies(5, 300)
    rows += [(10_000 + i, t) for i, t in enumerate(["", None, " \n", "one", "ONE", "one two", "One  TWO", "a b c", "A\tb\x0bC"])]
    rows += [((i * 7) % 90, t) for i, t in texts_with_copies(6, 60)] + [(None, rows[0][1]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = collections.Counter(map(tuple, simhash.group(docs, hot_classes=hot).collect()))
    assert got == plain_rows(rows)


def test_query_equals_brute_force_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert collections.Counter(map(tuple, queries.QUERIES["op13_simhash"](spark, SMALL).collect())) == plain_rows(rows)


def test_groups_of_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert collections.Counter(map(tuple, simhash.digest(odd_documents).collect())) == plain_rows(rows)
    assert simhash.digest(no_documents).count() == 0


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["Ab", "é", " ", "\n", "  ", "x" * 40, "\t"]) for _ in range(4000))
    whole = simhash.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "CHUNK_BYTES", size)
        assert simhash.fingerprint(text.encode()) == whole


@pytest.mark.parametrize("hot, cells", [(10**9, 1 << 22), (8, 1 << 22), (8, 64), (1, 1)])
def test_links_join_what_is_close(spark, monkeypatch, hot, cells):
    """Dense clusters whose codes share halves: every link is true, and the links join what all pairs join."""
    monkeypatch.setattr(simhash, "CELLS", cells)
    rng = random.Random(8)
    codes = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for center in rng.sample(sorted(codes), 4):
        weak = rng.sample(range(64), 9) if center % 2 else list(range(40, 52))
        codes |= {center ^ sum(1 << b for b in weak if rng.random() < 0.4) for _ in range(90)}
    low = rng.getrandbits(32)
    codes |= {low | (1 << (32 + rng.randrange(32))) | (1 << (32 + rng.randrange(32))) for _ in range(60)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    found = simhash.links(simhash.index(spark.createDataFrame([(c,) for c in signed], "code long"), hot))
    pairs = [tuple(r) for r in found.collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 and a != b for a, b in pairs)
    want = plain_groups({c: [c % 2**64] for c in signed})
    got = dict(map(tuple, components.components(found).collect()))
    assert {c: got.get(c, c) for c in signed} == want


def test_components_of_chains_settle_in_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(components, "_jump", lambda t, old=components._jump: rounds.append(1) or old(t))
    n = 2000
    rng = random.Random(1)
    for order in (list(range(n)), list(range(n))[::-1], rng.sample(range(n), n), [0, *range(n - 1, 0, -1)]):
        rounds.clear()
        links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(n + 5, n + 4), (7, 7)], "a long, b long")
        got = components.components(links)
        assert got.filter("label = 0").count() == n and got.filter(F.col("node") >= n).groupBy().min("label").first()[0] == n + 4
        assert len(rounds) < 20
    assert components.components(links.limit(0)).count() == 0
