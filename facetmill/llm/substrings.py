"""Removal of passages that occur earlier in the corpus: seed and extend on winnowed anchors.

A window is ``WINDOW`` consecutive words. Of the word groups in a window, the one with the least hash is its
anchor, so equal windows have equal anchors (winnowing), and neighbouring windows mostly share theirs.

1. Seeds: anchors that occur once in the corpus cannot lie in a repeat. The others are told to their documents.
2. Extension: around each such anchor, the document's windows to the left and right that hang on it are compared with those of
   the anchor's other occurrences, in corpus order. All but the first occurrence of a window are repeats.
   Each task first compares the occurrences it has before it: of a passage that a third of all documents share, hardly one
   occurrence per task goes on to where the anchor's occurrences meet.
3. Runs of repeated windows join into maximal repeats, whose words are removed.

Texts travel once, by document id, for steps 2 and 3 together; windows of unique text never do.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .words import Words, mix, text_slices
from .workers import Batches, bounded, map_batches

WINDOW = 20
GROUP = 5
SLICE = 1 << 20
_NO_ID = -(1 << 63)  # stands for a null id: before all others


def anchors(split: Words, window: int = WINDOW, group: int = GROUP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window: its first word, its hash, and its anchor's first word; ties go to the leftmost group."""
    words = split.hashes()
    n = len(words) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none
    groups = split.windows(words, group)
    best, at = groups[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, window - group + 1):
        less = groups[k:n + k] < best
        best[less] = groups[k:n + k][less]
        at[less] = k
    first = np.flatnonzero(split.whole(window))
    return first, split.spans(words, first, window), first + at[first]


def _group_hashes(split: Words, at: np.ndarray, group: int) -> np.ndarray:
    return split.spans(split.hashes(), at, group).view(np.int64)


def _earlier(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which windows have an equal one before them in corpus order, where the first of each distinct window is)."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    order = np.lexsort((places, ids, hashes))
    new = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
    first = order[new]
    back = np.empty(len(hashes), np.int64)
    back[order] = np.cumsum(new) - 1
    own = first[back]
    return (ids[own] < ids) | ((ids[own] == ids) & (places[own] < places)), first


def _bits(row: np.ndarray, step: np.ndarray, hit: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows, a bit per window ``step`` that is hit."""
    return np.bincount(row, hit * (1 << step), n).astype(np.int64)


def _runs(key: np.ndarray) -> np.ndarray:
    """Where a new value begins, and the end."""
    return np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key)) if len(key) else np.zeros(1, np.int64)


def _seeds(texts: DataFrame, window: int, group: int) -> DataFrame:
    """(anchor, id, often): each anchor of each document once, and whether it occurs there several times."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "text", SLICE):
                ids = batch["id"].to_numpy()
                for low, _, split in text_slices(batch["text"], limit=SLICE):
                    at = np.unique(anchors(split, window, group)[2])
                    hashes, row = _group_hashes(split, at, group), split.row[at]
                    order = np.lexsort((hashes, row))
                    hashes, row = hashes[order], row[order]
                    new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, bool)
                    cuts = np.append(np.flatnonzero(new), len(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[new]), pa.array(ids[low + row[new]]), pa.array(np.diff(cuts) > 1)], names=["anchor", "id", "often"]
                    )

    return map_batches(texts, run, "anchor long, id long, often boolean")


def _repeated(seeds: DataFrame) -> DataFrame:
    """(id, anchor) of anchors that occur twice or more. Rows stream by anchor; one row is held between batches."""

    def run(batches: Batches) -> Batches:
        held = None  # last row of the batch before, and whether it is already known as repeated
        for batch in batches:
            anchor, ids, often = (batch[c].to_numpy(zero_copy_only=False) for c in ("anchor", "id", "often"))
            if not len(anchor):
                continue
            before = np.append(held[0] if held else ~anchor[0], anchor[:-1])
            after = np.append(anchor[1:], ~anchor[-1])
            same = anchor == before
            keep = same | (anchor == after) | often
            if held and same[0] and not held[2]:
                yield pa.RecordBatch.from_arrays([pa.array([held[1]], pa.int64()), pa.array([held[0]], pa.int64())], names=["id", "anchor"])
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(anchor[keep])], names=["id", "anchor"])
            held = (int(anchor[-1]), int(ids[-1]), bool(keep[-1]))

    return map_batches(seeds.repartition("anchor").sortWithinPartitions("anchor"), run, "id long, anchor long")


def _extensions(texts: DataFrame, repeated: DataFrame, window: int, group: int) -> DataFrame:
    """(anchor, id, print, start, known, hashes): the windows that hang on each occurrence of a repeated anchor, from word ``start`` on.

    ``known``: those that this task has seen before in corpus order. Without others, the hashes are left out.
    """
    told = repeated.groupBy("id").agg(F.collect_list("anchor").alias("anchors"))
    rows = texts.join(told, "id").select("id", "row", "print", "text", "anchors")  # all columns: the same exchange as in the last join

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "text", SLICE):
                ids, prints = batch["id"].to_numpy(), batch["print"].to_numpy()
                told = [np.asarray(x.values) for x in batch["anchors"]]
                for low, high, split in text_slices(batch["text"], limit=SLICE):
                    first, hashes, at = anchors(split, window, group)
                    if not len(first):
                        continue
                    cuts = _runs(at)
                    begin = cuts[:-1]
                    anchor, row = _group_hashes(split, at[begin], group), split.row[at[begin]]
                    wanted = np.zeros(len(begin), bool)
                    bounds = np.searchsorted(row, np.arange(high - low + 1))
                    for r in range(high - low):
                        own = slice(bounds[r], bounds[r + 1])
                        wanted[own] = np.isin(anchor[own], told[low + r])
                    picked = np.flatnonzero(wanted)
                    counts = np.diff(cuts)[picked]
                    which = np.repeat(np.arange(len(picked)), counts)
                    step = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
                    at_window = begin[picked][which] + step
                    start = (first[begin] - split.first[row])[picked]
                    own, own_prints = ids[low + row[picked]], prints[low + row[picked]]
                    known, _ = _earlier(hashes[at_window], own[which], start[which] + step)
                    left = np.bincount(which, ~known, len(picked)) > 0
                    data = hashes.tobytes()
                    # Nothing is left to compare of a row whose windows are all known: it may go anywhere.
                    key = np.where(left, anchor[picked], mix(own.view(np.uint64) + start.astype(np.uint64)).view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(own), pa.array(own_prints), pa.array(start.astype(np.int32)),
                         pa.array(_bits(which, step, known, len(picked)).astype(np.int32)),
                         pa.array([data[8 * cuts[i]:8 * cuts[i + 1]] if more else b"" for i, more in zip(picked, left)], pa.binary())],
                        names=["anchor", "id", "print", "start", "known", "hashes"],
                    )

    return map_batches(rows, run, "anchor long, id long, print long, start int, known int, hashes binary")


def _repeats(extensions: DataFrame) -> DataFrame:
    """(id, print, start, bits): which of the windows from ``start`` on also begin earlier in the corpus.

    Rows stream by anchor and corpus order. Between batches only the first occurrences of the current
    anchor's distinct windows are held, however often the anchor occurs.
    """

    def run(batches: Batches) -> Batches:
        held = (None, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for whole in batches:
            for batch in bounded(whole, "hashes"):
                anchor, ids, prints, start = (batch[c].to_numpy() for c in ("anchor", "id", "print", "start"))
                parts = batch["hashes"].to_pylist()
                counts = np.array([len(p) // 8 for p in parts])
                hashes = np.frombuffer(b"".join(parts), np.uint64)
                row = np.repeat(np.arange(len(parts)), counts)
                step = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
                place = start[row].astype(np.int64) + step
                seen, seen_id, seen_place = held[1:] if held[0] == anchor[0] else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
                every = np.concatenate((seen, hashes))
                every_id, every_place = np.concatenate((seen_id, ids[row])), np.concatenate((seen_place, place))
                earlier, index = _earlier(every, every_id, every_place)
                bits = _bits(row, step, earlier[len(seen):], len(parts)) | batch["known"].to_numpy()
                hit = np.flatnonzero(bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[hit]), pa.array(prints[hit]), pa.array(start[hit]), pa.array(bits[hit].astype(np.int32))], names=["id", "print", "start", "bits"]
                )
                last = np.concatenate((np.full(len(seen), held[0] == anchor[-1]), anchor[row] == anchor[-1])) if len(every) else np.zeros(0, bool)
                kept = index[last[index]]
                held = (anchor[-1], every[kept], every_id[kept], every_place[kept])

    ordered = extensions.repartition("anchor").sortWithinPartitions("anchor", "id", "start")
    return map_batches(ordered, run, "id long, print long, start int, bits int")


def remove_repeats(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Columns ``keep`` of every row plus ``_n_words, _n_removed, _kept`` (the kept words, joined by one space).

    Corpus order is by id, then place; a null id comes before all. Rows that repeat an id count as one document: they do not remove each other's words
    at equal places. Null and empty texts have no words. Texts with fewer words than a window stay whole.
    """
    if window - group + 1 > 30:
        raise ValueError("a window holds at most 30 groups")
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # One exchange of the texts serves both joins.
    texts = docs.select(key.alias("id"), F.struct(*[F.col(f"`{k}`") for k in keep]).alias("row"), F.xxhash64(body).alias("print"), body.alias("text"))
    seeds = _seeds(docs.select(key.alias("id"), body.alias("text")), window, group)
    repeats = _repeats(_extensions(texts, _repeated(seeds), window, group))
    marks = repeats.groupBy("id").agg(F.collect_list(F.struct("print", "start", "bits")).alias("marks"))
    rows = texts.join(marks, "id", "left").select("row", "print", "text", "marks")
    schema = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches: Batches) -> Batches:
        reach = np.arange(window - group + 1)
        for whole in batches:
            for batch in bounded(whole, "text"):
                n_words, n_removed, kept = [], [], []
                for r, (own, data) in enumerate(zip(batch["print"].to_pylist(), batch["text"].to_pylist())):
                    words = data.encode().split()
                    n_words.append(len(words))
                    marked = batch["marks"][r]
                    gone = 0
                    if marked.is_valid and len(marked.values):
                        prints, start, bits = (np.asarray(marked.values.field(c)) for c in ("print", "start", "bits"))
                        mine = prints == own
                        at = (start[mine, None] + reach)[(bits[mine, None] >> reach) & 1 == 1]
                        edge = np.zeros(len(words) + window + 1, np.int64)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + window, -1)
                        stay = np.cumsum(edge)[: len(words)] == 0
                        gone = len(words) - int(stay.sum())
                        words = compress(words, stay.tolist())
                    n_removed.append(gone)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [batch["row"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["row", "n_words", "n_removed", "kept"],
                )

    out = map_batches(rows, run, schema)
    return out.select(*[F.col(f"row.`{k}`").alias(k) for k in keep], F.col("n_words").alias("_n_words"), F.col("n_removed").alias("_n_removed"), F.col("kept").alias("_kept"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op7."""
    return remove_repeats(docs, ["doc_id"]).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2("_kept", 256).alias("kept_sha256")
    )
