"""URL filters, mixing and quality rules: SQL, brute force and odd rows."""

import collections
import os
import sys

import pytest
from pyspark.sql import functions as F

from facetmill.llm import mixing, quality, queries, urls

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import check, database  # noqa: E402


SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert check(spark, database(SMALL), SMALL, name, queries.QUERIES[name], queries.SQL[name]) is None


def test_native_plans_hold_no_python(spark):
    for name in ("op1_url_filters", "op2_mixing", "op10_quality_rules"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


URLS = [
    ("http://Example.COM/en/1", "example.com", "/en/1", "example.com/en/", "block"),
    ("http://www.example.com/en/1?x=/es/", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://example.com/english", "example.com", "/english", "com/", "allow"),
    ("http://x.net/es/1#a", "x.net", "/es/1", "net/es/", "block"),
    ("http://x.net/ES/1", "x.net", "/ES/1", None, "allow"),
    ("http://com/", "com", "/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://example.com?/en/", "example.com", "", None, "allow"),
    ("x://a://b/c", "a:", "//b/c", None, "allow"),
    ("/en/ example.com", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://m.free-bets.example.org/1", "m.free-bets.example.org", "/1", None, "block"),
    ("http://x.org/anti-casino/", "x.org", "/anti-casino/", None, "allow"),
    ("http://casino.org/\n/net/es/", "casino.org", "/\n/net/es/", None, "block"),
    ("http://x.org/casinos", "x.org", "/casinos", None, "allow"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "x", "y") for i, u in enumerate(URLS)] + [(99, URLS[0][0], "x", "y")], "page_id long, url string, token string, host string")
    got = {r["page_id"]: tuple(r)[1:] for r in urls.digest(pages).collect()}
    assert got == {**{i: u[1:] for i, u in enumerate(URLS)}, 99: URLS[0][1:]}
    assert urls.digest(pages.limit(0)).count() == 0
    kept = urls.allowed(pages)
    assert kept.columns == pages.columns and kept.count() == sum(u[4] == "allow" for u in URLS)


def test_rules_are_filed_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("com",)] * 5 + [("example",)] * 3 + [("www",)] * 4 + [("en",)], "token string")
    rules = urls.rule_set(patterns=(("block", "*x*"), ("block", "/rare/path/")))
    index = {r["name"] or r["regex"]: r["token"] for r in urls.rarest_tokens(spark, tokens, rules).collect()}
    assert index["www.example.com/en/"] == "en" and index["com/"] == "com" and "" in index.values()


def fill(sizes, weights, total, most):
    """Targets by the contract's words: share, cap, and share the excess again until none is above."""
    out, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        left = total - sum(v for k, v in out.items() if k not in open_)
        w = sum(weights[k] for k in open_)
        out |= {k: left * weights[k] / w for k in open_}
        over = {k for k in open_ if out[k] > most * sizes[k]}
        if not over:
            break
        out |= {k: float(most * sizes[k]) for k in over}
        open_ -= over
    return out


def test_targets_fill_like_water(spark):
    sizes = {"a": 10, "b": 900, "c": 30, "é": 500, "z": 5, None: 40}
    rows = [(k, v // 2) for k, v in sizes.items()] + [(k, v - v // 2) for k, v in sizes.items()]
    df = mixing.targets(spark.createDataFrame(rows, "_source string, _size long"))
    got = {r["_key"]: r["target"] for r in df.collect()}
    names = sorted((k for k in sizes if k is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = fill(sizes, {k: (3, 1, 2)[i % 3] for i, k in enumerate(names)}, 1.5 * sum(sizes.values()), 2)
    for k, v in want.items():
        assert got["n" if k is None else "s" + k] == pytest.approx(v)


def test_mix_of_odd_documents(spark, odd_documents, no_documents):
    rows = mixing.digest(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert sorted(map(str, rows)) == sorted(map(str, mixing.digest(odd_documents.repartition(7)).collect()))
    assert mixing.digest(no_documents).count() == 0
    mixed = mixing.mix(odd_documents)
    assert mixed.columns == odd_documents.columns
    assert mixed.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == sum(r["taken"] for r in rows)


def test_sources_come_near_their_targets(spark):
    df = mixing.digest(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    source = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source")
    for r in df.join(source, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r["t"] - r["g"]) < 0.15 * r["g"]


def measures(text):
    words = [w for w in __import__("re").split(r"[ \t-\r]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    seen = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark, odd_documents, no_documents):
    texts = ["a b c a b c a", "x\nx\ny\n \n \nx", "a b a b a b", "", None, "p q r p q r s " * 40, "#$ | <b> &amp;", "a b c d\x0ba b\x0cc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(odd_documents.select("doc_id", "text").filter("doc_id is not null"))
    rows = docs.withColumn("want", F.col("text")).select("doc_id", "text")
    got = collections.Counter(tuple(r)[:6] for r in quality.digest(docs).collect())
    assert got == collections.Counter((r["doc_id"], *measures(r["text"])) for r in rows.collect())
    assert quality.digest(no_documents).count() == 0
    kept = quality.filter_good(odd_documents)
    assert kept.columns == odd_documents.columns and kept.filter("n_words is null").count() == 0


def test_quality_follows_labels(spark):
    got = quality.digest(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    r = got.filter("not base_failed").join(labels.withColumnRenamed("quality", "label"), "doc_id").agg(
        F.avg(F.when(F.col("label") == 1, F.col("kept").cast("int"))).alias("good"), F.avg(F.when(F.col("label") == 0, F.col("kept").cast("int"))).alias("junk")
    ).first()
    assert r["good"] > 0.99 and (r["junk"] is None or r["junk"] < 0.1)
