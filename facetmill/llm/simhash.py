"""SimHash fingerprints and the groups of documents whose fingerprints differ in few bits.

1. A document's fingerprint is the bitwise majority of the 64-bit hashes of its 3-word shingles. Equal fingerprints
   become one class, so copies cost one row.
2. Multi-index hashing: a fingerprint is cut into two halves. Of two fingerprints with at most 3 differing bits one
   half has at most one of them. Each half is filed in a table; the Hamming ball of radius one around it fetches the
   matches, whose complete distances are verified. Of two halves that differ in one bit only the one that lacks the
   bit enumerates it, so that a pair is fetched from one side.
3. The tables are dealt out by half. Where thousands of classes share a half, their other half is cut in two quarters
   that are filed likewise: with 48 of 64 bits given, at most 2**16 classes share a place, however large the corpus.
4. Within a place a verified link is given away only if it joins two parts, so links follow the classes, not their
   pairs. Components over all places are joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import fits_broadcast, lookup_join
from ..session import materialize
from .components import components
from .workers import Batches, bounded, map_batches

WORDS = 3
SEED = 42
DISTANCE = 3  # what halves and quarters with one bit each are made for
HOT_CLASSES = 2048
CHUNK_BYTES = 1 << 20
CELLS = 1 << 22  # distances held at once
_HALF, _QUARTER = 32, 16
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: bytes, words: int = WORDS) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, repeats included, a bounded number of bytes at a time. Fewer words are one shingle, none gives none."""
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    at, none_yet = 0, True
    while at < len(text):
        cut = _SPACE.search(text, at + CHUNK_BYTES)
        to = cut.start() if cut else len(text)
        part = carry + text[at:to].lower().split()
        at = to
        if len(part) >= words:
            line = b" ".join(part)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            pairs = zip(starts[: len(part) - words + 1].tolist(), ends[words - 1:].tolist())
            yield np.array([digest(line[a:b], SEED) for a, b in pairs], np.uint64)
            none_yet = False
        carry = part[-(words - 1):] if words > 1 else []
    if none_yet and carry:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bit i is set if more than half of the shingles' hashes set it. No word gives 0."""
    counts, n = np.zeros(64, np.int64), 0
    for codes in shingle_hashes(text, words):
        n += len(codes)
        for low in range(0, len(codes), 1 << 15):
            part = codes[low:low + (1 << 15)]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprint_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, code) of every row; ``code`` is the fingerprint as a signed 64-bit integer. A null text has no word."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "text"):
                codes = np.array([fingerprint(t.as_buffer().to_pybytes(), words) for t in batch["text"]], np.uint64)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(codes.view(np.int64))], names=["doc_id", "code"])

    return map_batches(rows, run, "doc_id long, code long")


def _part(low: int, bits: int) -> Column:
    """The ``bits`` bits of ``code`` from bit ``low`` on."""
    return F.shiftrightunsigned("code", low).bitwiseAND(F.lit((1 << bits) - 1))


def _ball(part: Column, bits: int) -> Column:
    """(key, own): the part itself, and the parts that have one more bit."""
    lacking = F.filter(F.array(*[F.lit(1 << i).cast("long") for i in range(bits)]), lambda b: part.bitwiseAND(b) == 0)
    more = F.transform(lacking, lambda b: F.struct(part.bitwiseOR(b).alias("key"), F.lit(False).alias("own")))
    return F.concat(F.array(F.struct(part.alias("key"), F.lit(True).alias("own"))), more)


def index(classes: DataFrame, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """(place, rank, code): where classes are filed, and where they look.

    Rank 0 is filed there by all its bits; 1 lacks a bit of the place in a quarter, 2 in a half, 3 in both.
    """
    def halves(keys) -> DataFrame:
        return classes.select("code", F.explode(F.array(F.lit(0), F.lit(1))).alias("half")).select(
            "code", "half", F.explode(keys(F.when(F.col("half") == 0, _part(0, _HALF)).otherwise(_part(_HALF, _HALF)))).alias("at")
        ).select("code", "half", F.col("at.own").alias("own"), (F.shiftleft(F.col("half").cast("long"), _HALF) + F.col("at.key")).alias("place"))

    filed = halves(lambda part: F.array(F.struct(part.alias("key"), F.lit(True).alias("own"))))
    hot = materialize(filed.groupBy("place").count().filter(F.col("count") > hot_classes).select("place"), "hot")
    rows = halves(lambda part: _ball(part, _HALF))
    flat = lambda df: df.select("place", F.when(F.col("own"), 0).otherwise(2).cast("byte").alias("rank"), "code")
    if hot.isEmpty():
        return flat(rows)
    hot_side = F.broadcast(hot) if fits_broadcast(hot) else hot
    shared = rows.join(hot_side, "place", "left_semi")
    # The place's other half, as two quarters.
    part = F.expr(f"shiftrightunsigned(code, IF(half = 0, {_HALF}, 0) + {_QUARTER} * quarter) & {(1 << _QUARTER) - 1}")
    near = shared.withColumn("quarter", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("part", part)
    near = near.withColumn("at", F.explode(_ball(F.col("part"), _QUARTER)))
    place = F.shiftleft(F.shiftleft(F.col("place"), 1) + F.col("quarter"), _QUARTER) + F.col("at.key") + F.lit(1 << 52)
    rank = F.when(F.col("own"), 0).otherwise(2) + F.when(F.col("at.own"), 0).otherwise(1)
    refined = near.select(place.alias("place"), rank.cast("byte").alias("rank"), "code")
    return flat(rows.join(hot_side, "place", "left_anti")).unionByName(refined)


class _Place:
    """The classes of one place that others are compared with, and the parts their links make."""

    def __init__(self):
        self.full, self.half = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # of rank 0; of rank 1
        self.part = np.zeros(0, np.int64)  # of both, one after the other
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, rank: int, codes: np.ndarray) -> None:
        if rank == 0:
            known = len(self.full)
            self.full = np.concatenate((self.full, codes))
            self.part = np.concatenate((self.part, np.arange(known, known + len(codes))))
            self._compare(codes, self.full, np.arange(known, known + len(codes)))
        elif len(self.full):
            if rank == 1:
                known = len(self.full) + len(self.half)
                self.half = np.concatenate((self.half, codes))
                self.part = np.concatenate((self.part, np.arange(known, known + len(codes))))
                self._compare(codes, self.full, np.arange(known, known + len(codes)))
            else:
                self._compare(codes, self.full if rank == 3 else np.concatenate((self.full, self.half)), None)
        elif rank == 1:
            self.half = np.concatenate((self.half, codes))
            self.part = np.arange(len(self.half))
        elif rank == 2 and len(self.half):
            self._compare(codes, self.half, None)

    def _compare(self, codes: np.ndarray, held: np.ndarray, places: np.ndarray | None) -> None:
        """Link ``codes`` to ``held``; ``places``: where codes stand among the held, if they do."""
        step = max(1, CELLS // max(1, len(held)))
        a, b = [], []
        for low in range(0, len(codes), step):
            some = codes[low:low + step]
            close = np.bitwise_count(some[:, None] ^ held[None, :]) <= DISTANCE
            for r in np.flatnonzero(close.any(axis=1)):
                near = np.flatnonzero(close[r])
                own = None if places is None else int(places[low + r])
                parts, first = np.unique(self.part[near], return_index=True)
                if own is not None:
                    other = parts != self.part[own]
                    parts, first = parts[other], first[other]
                    if not len(parts):
                        continue
                a.append(np.full(len(parts), some[r]))
                b.append(held[near[first]])
                joined = parts if own is None else np.append(parts, self.part[own])
                if len(joined) > 1:
                    self.part[np.isin(self.part, joined)] = joined.min()
        if a:
            self.links.append((np.concatenate(a), np.concatenate(b)))


def links(rows: DataFrame) -> DataFrame:
    """(a, b): codes at most ``DISTANCE`` bits apart, enough of them to join what a place joins. ``rows``: see ``index``."""
    rows = rows.repartition("place").sortWithinPartitions("place", "rank")

    def run(batches: Batches) -> Batches:
        place, held = None, _Place()
        for batch in batches:
            at, rank = batch["place"].to_numpy(), batch["rank"].to_numpy()
            code = batch["code"].to_numpy().view(np.uint64)
            if not len(at):
                continue
            cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (rank[1:] != rank[:-1]))))
            ends = np.append(cut[1:], len(at))
            found = []
            # A place of one row, all of whose rows are in this batch, links nothing.
            alone = (ends - cut == 1) & np.concatenate(([False], at[cut[1:]] != at[cut[:-1]])) & np.concatenate((at[cut[:-1]] != at[cut[1:]], [False]))
            for k in np.flatnonzero(~alone):
                low, high = cut[k], ends[k]
                if at[low] != place:
                    found += held.links
                    place, held = at[low], _Place()
                held.add(int(rank[low]), code[low:high])
            found += held.links
            held.links = []
            if found:
                a, b = (np.concatenate([x[i] for x in found]).view(np.int64) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return map_batches(rows, run, "a long, b long")


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``; other columns are not read.

    Null and empty texts, and texts without words, have the fingerprint zero, which links like any other. Rows that
    repeat an id are one node: what one of them is linked with, all are. A null id keeps its fingerprint, takes part
    in no link and has a null component. Ties cannot occur: the component is the least id.
    """
    rows = materialize(fingerprint_table(docs, doc_id, text, words), "fingerprints")
    known = rows.filter("doc_id is not null")
    classes = materialize(known.groupBy("code").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "classes")
    found = links(index(classes.select("code"), hot_classes))
    several = materialize(known.groupBy("doc_id").agg(F.min("code").alias("a"), F.max("code").alias("b")).filter("a < b").select("doc_id", "a"), "several")
    if not several.isEmpty():
        own = lookup_join(known, several, ["doc_id"], ["code"], counted=known).filter("a <> code")
        found = found.union(own.select("a", F.col("code").alias("b")).distinct())
    labels = components(materialize(found, "links"))
    named = materialize(classes.join(labels.withColumnRenamed("node", "code"), "code", "left").withColumn("label", F.coalesce("label", "code")), "classes")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    # A class of one id without links is its own component.
    shared = named.join(least, "label").filter("least <> most or component_id <> least").select("code", "component_id")
    out = lookup_join(rows, materialize(shared, "components"), ["code"], ["doc_id"], counted=rows)
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op13."""
    return group(docs)
