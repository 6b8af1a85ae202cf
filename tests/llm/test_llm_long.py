"""No text may stop a job: long and deep inputs, and plain versions of what fast searches find."""

import collections
import random
import time

import pytest
from facetmill.llm import html, pii
from facetmill.llm.urls import host_of
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def plain_spans(text):
    """Base spans by the contract's patterns alone."""
    out = [(m.start(), 0, m.end()) for m in pii.EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in pii.CARD.finditer(text):
        digits = [c for c in m.group() if c.isdigit()]
        if 14 <= len(digits) <= 19 and pii.luhn("".join(digits)):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(11)
    pieces = ["a", "b.c", "@", "@", ".", ".", "-", "_", "%", "+", "1", "25", "255", "256", "0", "000", "..", " ", "\n", "é", "4111 1111 1111 1111", "(", ")", "٣", "x@y.z"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 22)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", [
    "7" * 2_000_000, "0" * 5000 + ".0.0.0", "1." * 500_000, "a" * 2_000_000 + "@b", "a@" * 300_000, "a@b" * 300_000, "(at)" * 300_000, "+1" + "(" * 1_000_000, "+1 " * 300_000, "1 " * 500_000,
], ids=["digits", "zeros", "groups", "letters", "signs", "domains", "brackets", "phone", "phones", "card"])
def test_long_texts_are_searched_in_linear_time(text):
    start = time.process_time()
    pii.base_spans(text)
    list(pii.runs(text))
    assert time.process_time() - start < 15
    assert pii.base_spans("0" * 5000 + ".0.0.0") == [(0, 1, 5006)]


@pytest.mark.parametrize("page", [
    "<b>x" * 200_000, "<b>" * 200_000 + "<p>a" * 1000, "</i>" * 200_000, "<b>" * 100_000 + "</i>" * 100_000, "<div>x" * 100_000, "<li>a" * 200_000, "<ul><li>" * 50_000, "<p>" * 200_000,
    "<div class=x " + "a" * 1_000_000 + ">t", "<div class=x" + " " * 1_000_000 + "y>t", "&#" + "1" * 100_000 + "; t", "<script>" * 100_000, "<table><tr><td>" * 30_000, "<!--" * 100_000, "<a" * 200_000,
], ids=["inline", "paragraphs", "ends", "mixed", "deep", "items", "lists", "p", "attribute", "spaces", "reference", "scripts", "tables", "comments", "cut"])
def test_long_and_deep_pages_are_parsed_in_linear_time(page):
    start = time.process_time()
    texts, spans = html.main_part(page)
    assert time.process_time() - start < 30
    assert len(spans) <= page.count("<") + 1 and all(0 <= a < b <= len(texts) for _, a, b in spans)


def test_references_beyond_the_last_character():
    assert html.main_part(f"<p>a &#{'9' * 9000}; &#{'0' * 9000}65; b")[0] == ["a � A b"]


def plain_templates(pages, key, least, known=None):
    """{key: hashes} that recur; ``pages``: [(key, blocks)]. With ``known`` (key -> hashes gone already) the rule of sections."""
    bodies = collections.defaultdict(dict)
    for k, blocks in pages:
        bodies[k][tuple(t for t, _ in blocks)] = blocks
    out = {}
    for k, found in bodies.items():
        gone = known(k) if known else set()
        count = collections.Counter(c for blocks in found.values() for c in {c for _, codes in blocks if not gone & set(codes) for c in codes})
        if len(found) < least:
            continue
        often = {c for c, n in count.items() if n >= least and n >= (html.LEAST_SHARE_IN_ARTICLE if c & 1 else html.LEAST_SHARE) * len(found)}
        differ = collections.Counter()
        for blocks in found.values():
            left = [(len(t), set(codes)) for t, codes in blocks if not gone & set(codes)]
            recurs = often if known else {c for c in often if c & 1}
            own, same = sum(n for n, codes in left if not codes & often), sum(n for n, codes in left if codes & recurs)
            if own >= same * (1 if known else html.OWN_TIMES):
                differ.update(c for c in often if any(c in codes for _, codes in left))
        out[k] = {c for c in often if (not known and not c & 1) or 2 * differ[c] >= count[c]}
    return out


def test_whole_table_equals_plain_counts(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    story = "<body><main><p>Menu {s}</p><article><p>Sold by us</p><h1>{i}</h1><p>A story of {i}, long enough to be one. {i} again, and {i}.</p></article><p>End {s}</p></main>"
    more = spark.createDataFrame([(10**6 + 40 * k + i, f"http://big.example/{s}/{i}", story.format(s=s, i=f"{s}{i}")) for k, s in enumerate("abcd") for i in range(14)], "page_id long, url string, html string")
    pages = pages.select("page_id", "url", "html").unionByName(more)
    section = F.regexp_extract("url", r"^[^/?#]*//[^/?#]*/([^/?#]+)/", 1)
    rows = [(r[0], r[1], r[2], html.blocks(r[3] or "")) for r in pages.select("page_id", host_of(F.col("url")), section, "html").collect()]
    hosts = plain_templates([(h, b) for _, h, _, b in rows], "host", html.LEAST_PAGES)
    sections = {k for k in {(h, s) for _, h, s, _ in rows} if len({s for _, h, s, _ in rows if h == k[0]}) > 1}
    parts = plain_templates([((h, s), b) for _, h, s, b in rows if (h, s) in sections], "section", html.LEAST_IN_SECTION, lambda k: hosts.get(k[0], set()))
    want = {i: "\n\n".join(t for t, codes in b if not set(codes) & (hosts.get(h, set()) | parts.get((h, s), set()))) for i, h, s, b in rows}
    got = {r["page_id"]: r["text"] for r in html.digest(pages).collect()}
    assert got == want
    assert got[10**6] == "a0\n\nA story of a0, long enough to be one. a0 again, and a0."
