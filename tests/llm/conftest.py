import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns whose names an operator might use."""
    long = " ".join(f"word{i % 5000}" for i in range(60_000))
    same = "the same text with enough words to be a shingle or two in all, and then some more of them"
    rows = [
        (1, same, "en", "a"), (1, same, "en", "a"), (2, same, "en", None), (3, None, None, None), (4, "", "de", "b"), (5, " \t\n", "de", "b"),
        (6, long, "fr", "b"), (None, same, "en", "c"), (None, None, None, None), (7, "é" * 3000, "es", "c"), (8, "one two", "en", "a"), (9, "one two", "en", "a"),
        (10, "\x00 odd 漢字 👍 <|endoftext|> a@b.example.com +1 (269) 555-3296 4111111111111111", "en", "z"), (11, "nbsp sep next", "en", "z"),
    ]
    table = [(i, t, g, s, None if t is None else len(t), 1, "x", "y", "z", 0, "w") for i, t, g, s in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, n_words int, token string, id string, `_row` string, label int, size string"
    # Names that operators use for columns of their own.
    clashing = "_q _v _once _gone _masked _spans _host _ids target source_size _copies _size _copy _text code rep a b _in0 _in1 part load _key".split()
    return spark.createDataFrame([(*r, *[f"own {c} {i}" for c in clashing]) for i, r in enumerate(table)], names + "".join(f", `{c}` string" for c in clashing))


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
