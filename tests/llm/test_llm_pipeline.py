"""The pipeline's stages one by one against brute force, and the entry points."""

import collections

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from facetmill.llm import mixing, pii, quality, urls, workers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from test_llm_pairs import plain_groups

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.materialize(stage(spark, steps[-1], SMALL), "test"))
    raw, good, single, masked, mixed, tokens = steps
    assert all(s.columns == columns for s in steps[:-1])
    judged = quality.digest(raw)
    assert {r[0] for r in judged.filter("kept").select("doc_id").collect()} == {r[0] for r in good.select("doc_id").collect()}
    groups = plain_groups([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(r[0] for r in single.select("doc_id").collect()) == sorted({c for _, _, c in groups})
    field = pii.train(pii.labelled_table())
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in masked.collect():
        base, every = pii.find([texts[r["doc_id"]]], field)[0]
        assert r["text"] == pii.masked(texts[r["doc_id"]], every) and r["n_chars"] == len(r["text"])
        assert not base or "<" in r["text"]
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    for r in mixing.plan(masked, ["doc_id"]).collect():
        assert times[r["doc_id"]] == r["_copies"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in masked.collect()}
    assert tokens.columns == ["doc_id", "source", "n_tokens", "ids"] and tokens.count() == mixed.count()
    assert all(r["ids"] == want[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in tokens.collect())


def test_odd_and_no_documents_run_through(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), "test")
        assert docs.columns == ["doc_id", "source", "n_tokens", "ids"]


def test_entry_points():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_of_any_name_come_through_unchanged(spark, odd_documents):
    given = {tuple(r)[5:] for r in odd_documents.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_documents, SMALL)
        assert out.schema == odd_documents.schema, name
        kept = {tuple(r)[5:] for r in out.collect()}
        # The rules keep none of these rows.
        assert kept <= given and (kept or name == "quality rules"), name
    pages = odd_documents.withColumn("url", odd_documents["text"])
    assert {tuple(r)[5:-1] for r in urls.allowed(pages).collect()} == given


def test_batches_for_python_are_bounded_in_bytes(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    docs = spark.range(40).select(F.repeat(F.lit("x"), 1_000_000).alias("text")).coalesce(1)
    sizes = [r["bytes"] for r in workers.map_batches(docs, run, "bytes long").collect()]
    assert sum(sizes) >= 40_000_000 and max(sizes) <= 10_000_000


def test_masked_texts_travel_once(spark, monkeypatch):
    sent, map_batches = [], pii.map_batches
    monkeypatch.setattr(pii, "map_batches", lambda rows, *rest: sent.append(rows.schema) or map_batches(rows, *rest))
    rows = [(1, "mail a@b.example.com now", "x"), (2, None, "y"), (3, "", None), (None, "nothing", "z"), (1, "mail a@b.example.com now", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(map(tuple, pii.mask(docs).collect()), key=str)
    assert got == sorted([(i, t and t.replace("a@b.example.com", "<email>"), s) for i, t, s in rows], key=str)
    assert len(sent[0]["_row"].dataType.fields) == 2
    assert [tuple(r) for r in pii.mask(docs.select("text").limit(1)).collect()] == [("mail <email> now",)]
