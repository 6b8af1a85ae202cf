"""Language by n-grams in a bit-sliced Bloom filter: one look-up returns all languages that hold an n-gram.

A slot of the filter is a bit mask with one bit per language. The masks at an n-gram's slots, and-ed, are the
languages that hold it, or seem to. A text's vote for a language is the number of its n-grams with that
bit, corrected for the bits that would be there by chance.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .words import mix
from .workers import Batches, bounded, map_batches

GRAM = 4  # bytes
#: The classifier is fitted on at most so many documents of each language, those with the least hash of their id.
FIT_DOCUMENTS = 2000
GRAMS_PER_LANGUAGE = 40_000
#: An n-gram counts for each language in which it is at least so frequent, against the language where it is most frequent.
LEAST_SHARE = 0.25
SLOTS = 1 << 21
HASHES = 3
UNKNOWN = "und"
SLICE = 1 << 20

_SIDE, _NONE = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
_LETTER = np.full(256, ord(" "), np.uint8)
_LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[128:] = np.arange(128, 256)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, row) of lower-cased texts: all runs of ``GRAM`` bytes, with anything but letters
    taken as a space, and a space on either side of a text."""
    plain = pc.fill_null(texts.cast(pa.large_string()), "")
    lowered = pc.utf8_lower(pc.binary_join_element_wise(_SIDE, plain, _SIDE, _NONE))
    n = len(lowered)
    offsets = np.frombuffer(lowered.buffers()[1], np.int64, n + 1, lowered.offset * 8)
    buffer = lowered.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    data = _LETTER[data[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    if len(data) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(data) - GRAM + 1
    key = np.zeros(count, np.uint64)
    for i in range(GRAM):
        key = (key << np.uint64(8)) | data[i:i + count]
    start = np.arange(count)
    row = np.searchsorted(offsets, start, "right") - 1
    # Inside one text, and not a run that begins with two spaces.
    good = (start + GRAM <= offsets[row + 1]) & ~((data[:count] == 32) & (data[1:count + 1] == 32))
    return key[good], row[good]


@dataclass
class Filter:
    languages: list[str]
    masks: np.ndarray  # one mask per slot

    @classmethod
    def build(cls, languages: list[str], held: list[tuple[int, int]]) -> Filter:
        """``held``: (n-gram, index of language)."""
        width = next(w for w in (8, 16, 32, 64) if len(languages) <= w)
        out = cls(languages, np.zeros(SLOTS, f"u{width // 8}"))
        if held:
            key = np.array([k for k, _ in held], np.int64).view(np.uint64)
            bit = np.left_shift(np.ones(len(held), out.masks.dtype), np.array([i for _, i in held], out.masks.dtype))
            for slot in out.slots(key):
                np.bitwise_or.at(out.masks, slot, bit)
        return out

    @staticmethod
    def slots(key: np.ndarray) -> list[np.ndarray]:
        return [(mix(key + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)) % np.uint64(SLOTS)).astype(np.int64) for i in range(HASHES)]

    def look_up(self, key: np.ndarray) -> np.ndarray:
        out = None
        for slot in self.slots(key):
            out = self.masks[slot] if out is None else out & self.masks[slot]
        return out

    def chance(self) -> np.ndarray:
        """For each language, how often an n-gram that nobody holds shows its bit."""
        one = self.masks.dtype.type(1)
        return np.array([np.mean((self.masks >> self.masks.dtype.type(i)) & one) ** HASHES for i in range(len(self.languages))])

    def votes(self, texts: pa.Array) -> np.ndarray:
        """Rows by languages: corrected counts."""
        key, row = grams(texts)
        mask = self.look_up(key)
        total = np.bincount(row, minlength=len(texts)).astype(float)
        out = np.zeros((len(texts), len(self.languages)))
        for i, chance in enumerate(self.chance()):
            hits = np.bincount(row, (mask >> mask.dtype.type(i)) & mask.dtype.type(1), len(texts))
            out[:, i] = np.maximum(0.0, (hits - total * chance) / (1 - chance))
        return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, doc_id="doc_id", text="text", lang="lang") -> Filter:
    """The filter, from rows that are not held out and have a language and a text.

    The n-grams of the fitting sample are counted by Spark; at most ``GRAMS_PER_LANGUAGE`` per language reach the driver.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{text}`").alias("_text"))
    rows = rows.filter(~held_out(F.col("_id")) & F.col("_lang").isNotNull() & F.col("_text").isNotNull())
    order = Window.partitionBy("_lang").orderBy(F.xxhash64(F.col("_id").cast("string")), "_id")
    chosen = rows.select("_lang", "_id").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= FIT_DOCUMENTS)
    sample = rows.join(F.broadcast(chosen.select("_lang", "_id").distinct()), ["_lang", "_id"], "left_semi")

    def count(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "_text", SLICE):
                key, row = grams(batch["_text"])
                langs = batch["_lang"].dictionary_encode()
                code = langs.indices.to_numpy()[row]
                for i, name in enumerate(langs.dictionary.to_pylist()):
                    gram, n = np.unique(key[code == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], names=["_lang", "gram", "n"]
                    )

    counts = map_batches(sample.select("_lang", "_text"), count, "_lang string, gram long, n long").groupBy("_lang", "gram").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("_lang"))
    kept = (
        counts.withColumn("share", share)
        .withColumn("top", F.max("share").over(Window.partitionBy("gram")))
        .filter((F.col("n") > 1) & (F.col("share") >= LEAST_SHARE * F.col("top")))
        .withColumn("_r", F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("n"), "gram")))
        .filter(F.col("_r") <= GRAMS_PER_LANGUAGE)
        .select("_lang", "gram")
    )
    held = kept.collect()
    languages = sorted({r["_lang"] for r in held})
    if len(languages) > 64:
        raise ValueError(f"a mask holds 64 languages, not {len(languages)}")
    place = {name: i for i, name in enumerate(languages)}
    return Filter.build(languages, [(r["gram"], place[r["_lang"]]) for r in held])


def predict(docs: DataFrame, fitted: Filter, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row plus ``_lang_pred`` and ``_score`` (the winner's share of all votes).

    Looks at the whole text alone. ``und`` with score 0 if the text is null or has no letter, or nothing was learned; a text whose
    n-grams are all unknown gets the first language with score 0. Equal votes go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    rows = docs.select(F.struct(*[F.col(f"`{k}`") for k in keep]).alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, _lang_pred string, _score double"

    def run(batches: Batches) -> Batches:
        model = shared.value
        for whole in batches:
            for batch in bounded(whole, "_text", SLICE):
                lettered = pc.match_substring_regex(batch["_text"], r"\p{L}").to_numpy(zero_copy_only=False)
                if model.languages:
                    votes = model.votes(batch["_text"])
                    best, total = votes.argmax(axis=1), votes.sum(axis=1)
                    names = np.array(model.languages, object)[best]
                    score = np.divide(votes.max(axis=1), total, out=np.zeros(len(batch)), where=total > 0)
                    names[~lettered], score[~lettered] = UNKNOWN, 0.0
                else:
                    names, score = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
                yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(names, pa.string()), pa.array(score)], names=["_row", "_lang_pred", "_score"])

    return map_batches(rows, run, schema).select(*[F.col(f"_row.`{k}`").alias(k) for k in keep], "_lang_pred", "_score")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op9."""
    return predict(docs, fit(docs), ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score")
    )
