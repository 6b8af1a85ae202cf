"""Tokens, personal data, language and main text: the library, brute force, held-out accuracy and odd rows."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetmill.llm import bpe, html, language, pii

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def tables():
    with open(VOCABULARY, encoding="utf-8") as file:
        return bpe.Tables(file.read())


def test_tokens_equal_the_library(library, tables):
    encoder, decoder, rng = bpe.Encoder(tables, bpe.sufficient_lookahead(tables)), bpe.Decoder(tables), random.Random(5)
    letters = "abthe inor  \n\t'sré<|endoftext|>0123.,\x1c\x85  üß漢字👍́\x00"
    for i in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        if i % 3 == 0:
            text = "".join(chr(rng.choice([rng.randint(1, 255), rng.randint(1, 0x2FFF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(30))
        if i % 100 == 0:
            text = ("q" * 9000 if i % 200 else " " * 5000) + "".join(text.split()) * 300 + "theinthe" * 2000
        ids = np.frombuffer(encoder.encode(text), "<u4")
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert decoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_a_window_is_as_good_as_the_whole(tables):
    need = bpe.sufficient_lookahead(tables)
    encoder, rng = bpe.Encoder(tables, need), random.Random(6)
    assert 0 < need < 1000
    for _ in range(30):
        data = "".join(rng.choice("abcdeinorstuh") for _ in range(rng.randint(1, 6 * encoder.window))).encode()
        assert list(encoder.stream(data)) == tables.merge(data)


def test_decoder_repairs_broken_text(library, tables):
    rng = random.Random(8)
    for _ in range(300):
        ids = [rng.randrange(256) for _ in range(rng.randint(0, 20))]
        assert bpe.Decoder(tables).decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)


def test_token_query(spark, odd_documents, no_documents, library):
    def want(r):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    got = collections.Counter(map(tuple, bpe.digest(odd_documents, VOCABULARY).collect()))
    assert got == collections.Counter(map(want, odd_documents.collect()))
    assert bpe.digest(no_documents, VOCABULARY).count() == 0
    listed = bpe.encode(odd_documents, VOCABULARY, ["doc_id"]).filter("doc_id = 8").first()
    assert listed["_ids"] == library.encode("one two").ids and listed["_n_tokens"] == 2


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in pii.EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in pii.CARD.finditer(text) if 14 <= len(d := pii._digits(m.group())) <= 19 and pii.luhn(d)]
    return sorted(out + [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(text) if 10 <= len(pii._digits(m.group())) <= 15])


def test_patterns_equal_plain_search():
    rng = random.Random(3)
    parts = ["a", "b1", "@", ".", ".", "-", "_", "+", "1", "22", "255", "300", " ", "(", ")", "4111 1111 1111 1111", "é", "a@b.c"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert pii.base_spans(text) == plain_spans(text)


@pytest.fixture(scope="module")
def field():
    return pii.train(pii.labelled_table())


def test_field_on_held_out_lines(field):
    table = pii.labelled_table(400, seed=99)
    paths = field.decode([[pii.features(w) for w in words] for words, _ in table])
    pairs = [(pii.LABELS[x], tag) for path, (_, tags) in zip(paths, table) for x, tag in zip(path, tags)]
    assert sum(a == b for a, b in pairs) > 0.97 * len(pairs)


def test_viterbi_is_the_best_path(field):
    rng = np.random.default_rng(1)
    small = pii.Field(rng.normal(size=field.emit.shape), *(rng.normal(size=w.shape) for w in (field.move, field.first, field.last)))
    words = [pii.features(w) for w in ("+1", "(212)", "555-0100", "x@y.com")]
    n = len(pii.LABELS)
    emit = small.scores(words)
    paths = np.stack(np.meshgrid(*[np.arange(n)] * 4, indexing="ij"), -1).reshape(-1, 4)
    total = emit[np.arange(4), paths].sum(1) + small.first[paths[:, 0]] + small.last[paths[:, -1]] + small.move[paths[:, :-1], paths[:, 1:]].sum(1)
    assert (small.decode([words, words[:1], words])[0] == paths[total.argmax()]).all()


def test_personal_data(spark, odd_documents, no_documents, field):
    text = "é call +1 (269) 555-3296 4524132264652876 or 10.0.0.1, a.b@c.example.com."
    base, every = pii.find([text], field)[0]
    assert pii.written(base) == pii.written(plain_spans(text)) and "phone:7:24,card:25:41" in pii.written(every)
    assert pii.masked(text, every) == "é call <phone> <card> or <ip>, <email>."
    rows = pii.digest(odd_documents).collect()
    assert collections.Counter((r["doc_id"], r["base_sha256"]) for r in rows) == collections.Counter(
        (r["doc_id"], hashlib.sha256(pii.written(plain_spans(r["text"] or "")).encode()).hexdigest()) for r in odd_documents.collect()
    )
    assert pii.digest(no_documents).count() == 0
    out = pii.mask(odd_documents, length="n_chars")
    assert out.schema == odd_documents.schema
    assert out.filter("doc_id = 10").first()["text"].endswith("<email> <phone> <card>")
    assert out.filter("text is null").count() == 2


def test_language_on_held_out_documents(spark, odd_documents, no_documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    assert language.digest(docs).filter("score < 0 or score > 1 or score is null").count() == 0
    # Nothing of a row but its text counts.
    fitted = language.fit(docs)
    swapped = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s"))
    one = {r["doc_id"]: tuple(r) for r in language.predict(docs, fitted, ["doc_id"]).collect()}
    assert one == {r["doc_id"]: tuple(r) for r in language.predict(swapped, fitted, ["doc_id"]).collect()}
    odd = language.predict(odd_documents, fitted, ["doc_id", "text"]).collect()
    assert len(odd) == odd_documents.count()
    for r in odd:
        assert (r["_lang_pred"] == "und") == (r["text"] is None or not any(c.isalpha() for c in r["text"]))
    assert language.digest(no_documents).count() == 0


def test_filter_returns_every_language_that_holds_a_gram():
    rng = np.random.default_rng(4)
    grams = rng.integers(0, 2**40, 30_000)
    held = [(int(g), int(l)) for g, l in zip(grams, rng.integers(0, 9, 30_000))]
    fitted = language.Filter.build([f"l{i}" for i in range(9)], held)
    masks = fitted.look_up(grams.view(np.uint64))
    assert all(int(m) >> l & 1 for m, (_, l) in zip(masks, held))
    others = fitted.look_up(rng.integers(2**41, 2**42, 50_000).view(np.uint64))
    for i, chance in enumerate(fitted.chance()):
        assert abs(np.mean(others >> i & 1) - chance) < 0.01


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="x">
<div class="cookie-notice">c</div><nav><ul><li>n</ul></nav><div class="wrap"><div class="tpl"><p>Our site since 1999</p></div>
<article><h1>Head {i}</h1><p><b>One &amp; <i>two</i>{i}<br>three<p>four
 five<ul><li>a<li>b</ul><div class="share">s</div><form>f</form><section class="comments"><p>c</p></section><p>a &lt; b &am</article></div>
<aside>s</aside><footer>&copy;</footer>"""


def test_main_text(spark):
    text = "Head {i}\n\nOne & two{i} three\n\nfour five\n\na\n\nb\n\na < b &am"
    rows = [(i, f"http://h.example/{i}", PAGE.format(i=i), "x") for i in range(8)]
    # Without an article element: the template goes because it recurs, the text stays.
    rows += [(100 + i, f"http://g.example/{i}", f"<body><div><p>Site of G</p><p>join us</p></div><div><p>Story {i}</p></div>", "x") for i in range(8)]
    # One article published many times on one host is no template.
    rows += [(200 + i, "http://k.example/", "<body><article><p>Copied</p></article>", "x") for i in range(30)]
    rows += [(300, None, None, "x"), (301, "", "", None), (302, "no host", "plain <b>words</b> < 3 <p", "x"), (303, "http://h.example/", "<nav>only", "x"), (0, "http://h.example/0", PAGE.format(i=0), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, template string")
    got = collections.defaultdict(set)
    for r in html.digest(pages).collect():
        got[r["page_id"]].add((r["text"], r["n_chars"] == len(r["text"])))
    for i in range(8):
        assert got[i] == {(text.format(i=i), True)}
        assert got[100 + i] == {(f"Story {i}", True)}
    assert all(got[200 + i] == {("Copied", True)} for i in range(30))
    assert [got[i] for i in (300, 301, 302, 303)] == [{("", True)}, {("", True)}, {("plain words < 3", True)}, {("", True)}]
    assert html.digest(pages.limit(0)).count() == 0


def page_text(page):
    return [text for text, _ in html.blocks(page)]


@pytest.mark.parametrize("name", ["content has-sidebar", "site no-sidebar", "container has-header", "page nav-open", "post category-social tag-legal", "elementor-widget elementor-widget-text"])
def test_doubtful_wrappers_keep_the_main_text(name):
    long = "The whole story, told at length and without links. " * 4
    assert page_text(f'<body><div class="{name}"><article><p>{long}</p></article></div><p>Older</p>') == [long.strip()]
    assert page_text(f'<body><div id="{name}"><div><p>{long}</p></div></div><div class="menu"><a>Home</a></div>') == [long.strip()]
    assert page_text(f'<body><p>Lead</p><div class="{name}"><p>{long}</p></div><div class="{name}"><p>{long}</p></div>') == ["Lead", long.strip(), long.strip()]


def test_a_form_around_the_page_keeps_it():
    long = "A page of a server that wraps all in one form. " * 4
    assert page_text(f'<body><form id="aspnetForm"><nav>n</nav><div class="footer">f</div><main><p>{long}</p><input></main></form>') == [long.strip()]
    assert page_text(f"<body><form><div><p>{long}</p></div></form>") == [long.strip()]
    # Small doubtful parts still go, and teasers in them displace nothing.
    assert page_text(f'<body><p>{long}</p><form>Search</form><div class="comments">c</div>') == [long.strip()]
    assert long.strip() in page_text(f'<body><main><p>{long}</p><div class="related"><article><p>teaser</p></article></div></main>')


def test_all_main_parts_are_read():
    one, two = "The first part of the story. " * 3, "The second part of the story. " * 3
    want = [one.strip(), two.strip()]
    for open_, close in (('<div role="article">', "</div>"), ("<main>", "</main>"), ('<div role="main">', "</div>")):
        assert page_text(f"<body><p>x</p>{open_}<p>{one}</p>{close}<p>y</p>{open_}<p>{two}</p>{close}") == want
    assert page_text(f'<body><article><p>{one}</p></article><div role="article"><p>{two}</p></div>') == want
    # A part of role article inside a main element does not displace the rest of it.
    assert page_text(f'<body><p>x</p><main><p>{one}</p><div role="article" class="post tag-legal"><p>{two}</p></div></main>') == want
    assert all(c & 1 for _, codes in html.blocks(f'<body><div role="article"><p>{one}</p></div>') for c in codes)


@pytest.mark.parametrize("kind, span", [
    ("phone", "555-123-4567"), ("phone", "555.123.4567"), ("phone", "1-800-555-0199"), ("phone", "(555) 123-4567"), ("phone", "030/12345678"), ("phone", "0171/2345678"),
    ("email", "jörg@müller.de"), ("email", "name at host dot com"), ("email", "anna [at] firma [dot] de"), ("email", "max.muster(at)firma.de"), ("email", "名字@例子.org"),
    ("card", "4111.1111.1111.1111"), ("card", "4111–1111–1111–1111"), ("ip", "2001:db8::8a2e:370:7334"), ("ip", "10[.]20[.]30[.]40"),
])
def test_field_adds_what_the_patterns_miss(field, kind, span):
    text = f"Please write to {span}, thanks."
    base, every = pii.find([text], field)[0]
    assert not base and pii.written(every) == f"{kind}:16:{16 + len(span)}"
    assert pii.masked(text, every) == f"Please write to <{kind}>, thanks."


def test_field_leaves_look_alikes(field):
    for text in (
        "on 2020-01-28 at 12:30:45", "ISBN 978-3-16-148410-0", "number 123-45-6789", "zip 12345-6789", "pi is 3.1415926535", "a total of 123.456.789", "look at polka dot dresses",
        "part 123-456-789", "00:1a:2b:3c:4d:5e", "std::1", "seen @user", "they looked at it and saw a dot on it", "version 10.2.33", "id 1234567890", "f(at) x",
    ):
        assert pii.find([text], field)[0] == ([], []), text


def test_sections_of_a_large_host_have_templates(spark):
    story = "Story {i} tells of {i} things that no other page has, and of {i} more."
    page = "<body><div><p>Menu of {s}</p><p>join {s}</p></div><div><p>" + story + "</p></div>"
    rows = [(100 * k + i, f"http://h.example/{s}/{i}", page.format(s=s, i=100 * k + i)) for k, s in enumerate("abcde") for i in range(20)]
    # Near copies of one page are no template.
    rows += [(1000 + i, f"http://h.example/n/{i}", f"<body><div><p>{'The one report. ' * 9}</p><p>{'Its second part. ' * 9}</p><p>Copy {i}</p></div>") for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[100 * k + i] == story.format(i=100 * k + i) for k in range(5) for i in range(20))
    assert all(got[1000 + i].startswith("The one report.") and "second part" in got[1000 + i] and got[1000 + i].endswith(f"Copy {i}") for i in range(12))
