"""Exact Jaccard join of documents on word shingles, and the groups it links.

1. A document is the set of hashes of its shingles. Equal sets become one class, so exact copies cost one row.
2. Two sets as similar as asked share one of the first few hashes of each (prefix filter, in hash order). Classes are filed
   under those. Members of a bucket are first paired with its least member, which joins most of what is similar. Small buckets also
   give the pairs for which the hash can be the first that both share, as enough hashes follow in either.
3. Pairs pass a bound on their overlap from hashed bitmaps, at first folded to 128 bytes, then to one or two bits a hash, then
   whole, and last an exact intersection of sorted hashes.
4. Of large buckets, members that are still in different components are compared in size-banded tiles of
   bounded size by their bitmaps folded once, where the hash can be the first that both share. Pairs inside one component
   are never listed, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import fits_broadcast, lookup_join
from ..session import materialize
from .components import components
from .names import apart
from .words import text_slices
from .workers import Batches, bounded, map_batches

WORDS = 5
PERCENT = 80
SMALL_BUCKET = 24
TILE = 1024
BROADCAST_IDS = 500_000
ROUGH_WORDS = 16  # of 64 bits, to which bitmaps are folded before they travel with pairs
BAND = 1.26  # sizes of linked sets differ by less than one band and a bit
SLICE = 1 << 20


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased. A text with fewer words is one shingle; none gives none."""
    for low, high, split in text_slices(texts, lower=True, limit=SLICE):
        hashes = split.hashes()
        counts = np.diff(split.first)
        shingles = split.windows(hashes, words)
        short = split.spans(hashes, split.first[:-1], np.minimum(counts, words))
        for r in range(high - low):
            n = counts[r]
            if n >= words:
                own = np.sort(shingles[split.first[r]:split.first[r + 1] - words + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            else:
                yield short[r:r + 1] if n else short[:0]


def bitmap(hashes: np.ndarray) -> bytes:
    """One bit per hash, in a power of two of two to four bits per hash. Halves can be or-ed to a smaller map."""
    bits = max(64, 2 << int(len(hashes)).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(hashes & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def fold(map_: np.ndarray, words: int) -> np.ndarray:
    while len(map_) > words:
        map_ = map_[: len(map_) // 2] | map_[len(map_) // 2:]
    return map_


def least_overlap(a, b, percent: int = PERCENT):
    """Overlap at which 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n // 100) + 1


def small(ids: DataFrame) -> DataFrame:
    """A written column of ids, to be broadcast if it has no more than ``BROADCAST_IDS`` rows, so that the texts need not move for it."""
    return F.broadcast(ids) if fits_broadcast(ids, BROADCAST_IDS) else ids


def digest_of(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def set_table(docs: DataFrame, doc_id: str, text: str, percent: int, words: int) -> DataFrame:
    """(doc_id, n, digest, prefix, bits, half, rough) of every row; ``half`` are the bits folded once, ``rough`` to 128 bytes. Sets without shingles have a null digest."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "text"):
                n, digest, prefix, bits, half, rough = [], [], [], [], [], []
                for own in shingle_sets(batch["text"], words):
                    n.append(len(own))
                    digest.append(digest_of(own))
                    prefix.append(own[: prefix_length(len(own), percent)].view(np.int64) if len(own) else own.view(np.int64))
                    bits.append(bitmap(own) if len(own) else None)
                    map_ = np.frombuffer(bits[-1] or b"", np.uint64)
                    half.append(fold(map_, max(ROUGH_WORDS, len(map_) // 2)).tobytes() if len(own) else None)
                    rough.append(fold(map_, ROUGH_WORDS).tobytes() if len(own) else None)
                offsets = np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(n, pa.int32()), pa.array(digest, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefix))), *(pa.array(x, pa.binary()) for x in (bits, half, rough))],
                    names=["doc_id", "n", "digest", "prefix", "bits", "half", "rough"],
                )

    return map_batches(rows, run, "doc_id long, n int, digest binary, prefix array<long>, bits binary, half binary, rough binary")


def texts_of(docs: DataFrame, varied: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """``docs`` (doc_id, text) with the node of its class as the id of each row whose id has different sets. Rows that stand for no class go."""
    rows = docs.withColumn("text", F.coalesce("text", F.lit(""))).join(small(varied), "doc_id", "left_semi")

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "text"):
                digests = pa.array([digest_of(own) for own in shingle_sets(batch["text"], words)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], digests], names=["doc_id", "text", "digest"])

    own = map_batches(rows.select("doc_id", "text"), run, "doc_id long, text string, digest binary")
    own = own.join(classes.select("digest", F.col("rep").alias("doc_id"), "node"), ["digest", "doc_id"])
    own = materialize(own.select(F.col("node").alias("doc_id"), "text"), "variants")
    return docs.join(small(varied), "doc_id", "left_anti").select("doc_id", "text").unionByName(own)


def _fits(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar enough."""
    return 100 * np.minimum(n, m).astype(np.int64) >= percent * np.maximum(n, m).astype(np.int64)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return low[new], high[new]


def _first_shared(n: np.ndarray, i: np.ndarray, m: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether a hash at places i and j of sets of sizes n and m can be the first they share, if they are similar enough.

    Hashes are in order, so what both share lies from there on. Similar sets pass it at the first hash they share.
    """
    return _fits(n, m, percent) & (np.minimum(n - i, m - j) >= least_overlap(n, m, percent))


def bucket_pairs(index: DataFrame, percent: int, small: int = SMALL_BUCKET) -> DataFrame:
    """(large, x, y, n, at): pairs x < y of classes in small buckets, or (token, class, its size, the token's place) of large ones. ``index``: token, rep, n, at, by token.

    ``at`` is the token's place in the class's set.
    """

    def run(batches: Batches) -> Batches:
        token, rep, n, place = (np.zeros(0, np.int64) for _ in range(4))
        large = None  # token of a bucket already found large

        def out(kind: bool, x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, at: np.ndarray | None = None) -> pa.RecordBatch:
            none = np.zeros(len(x), np.int64)
            columns = [np.full(len(x), kind), x, y, none if n is None else n, none if at is None else at]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["large", "x", "y", "n", "at"])

        def work(token, rep, n, place, last: bool):
            """Rows of complete buckets; returns what is emitted and where the unfinished bucket begins."""
            nonlocal large
            end = len(token) if last else int(np.searchsorted(token, token[-1], "left"))
            if not last and len(token) - end > small:
                end, large_after = len(token), token[-1]
            else:
                large_after = None
            t, r, m, at = token[:end], rep[:end], n[:end], place[:end]
            start = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if end else np.zeros(0, np.int64)
            size = np.repeat(np.diff(np.append(start, end)), np.diff(np.append(start, end)))
            big = (size > small) | (t == large if large is not None else False)
            emitted = [out(True, t[big], r[big], m[big], at[big])]
            a, b = [], []
            head = np.concatenate(([True], t[1:] != t[:-1])) if end else np.zeros(0, bool)
            for d in range(1, small):
                first = head[:-d] & _fits(m[d:], m[:-d], percent) | _first_shared(m[d:], at[d:], m[:-d], at[:-d], percent)
                hit = np.flatnonzero((t[d:] == t[:-d]) & ~big[d:] & first & (r[d:] != r[:-d]))
                if not len(hit) and not (t[d:] == t[:-d]).any():
                    break
                a.append(r[hit])
                b.append(r[hit + d])
            if a:
                emitted.append(out(False, *_distinct(np.concatenate(a), np.concatenate(b))))
            if large_after is not None:
                large = large_after
            return emitted, end

        for batch in batches:
            token, rep, n, place = (np.concatenate((x, batch[c].to_numpy().astype(np.int64))) for x, c in ((token, "token"), (rep, "rep"), (n, "n"), (place, "at")))
            if len(token):
                emitted, end = work(token, rep, n, place, False)
                yield from emitted
                token, rep, n, place = token[end:], rep[end:], n[end:], place[end:]
        if len(token):
            yield from work(token, rep, n, place, True)[0]

    return map_batches(index, run, "large boolean, x long, y long, n long, at long")


def likely(pairs: DataFrame, classes: DataFrame, percent: int, *levels: str) -> DataFrame:
    """Distinct pairs (a, b) whose overlap, bounded by their bitmaps, may suffice. ``levels`` are columns of bitmaps, folded ones first: larger ones move only for pairs that pass the smaller."""
    pairs = pairs.distinct()
    for bits in levels:
        pairs = _bounded(materialize(pairs, "likely"), classes, percent, bits)
    return pairs


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int, bits: str) -> DataFrame:
    side = lambda k: classes.select(F.col("rep").alias(k), F.col("n").alias(f"n_{k}"), F.col(bits).alias(f"bits_{k}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            n, m = batch["n_a"].to_numpy().astype(np.int64), batch["n_b"].to_numpy().astype(np.int64)
            keep = _fits(n, m, percent)
            need = least_overlap(n, m, percent)
            for i in np.flatnonzero(keep):
                x, y = (np.frombuffer(batch[c][i].as_py(), np.uint64) for c in ("bits_a", "bits_b"))
                words = min(len(x), len(y))
                x, y = fold(x, words), fold(y, words)
                most = min(n[i] - np.bitwise_count(x & ~y).sum(dtype=np.int64), m[i] - np.bitwise_count(y & ~x).sum(dtype=np.int64))
                keep[i] = most >= need[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return map_batches(rows, run, "a long, b long")


def linked(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int, words: int) -> DataFrame:
    """The pairs whose sets are similar enough, by exact intersection. Only documents of candidate pairs are read again."""
    ids = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "candidates")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).join(small(ids), "id", "left_semi")
    side = lambda k: texts.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")

    def sets(batch: pa.RecordBatch, k: str) -> list[np.ndarray]:
        ids = batch[k].to_numpy()
        new = np.concatenate(([True], ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, bool)
        own = list(shingle_sets(batch[f"text_{k}"].filter(pa.array(new)), words))
        return [own[i] for i in np.cumsum(new) - 1]

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "text_b"):
                keep = []
                for x, y in zip(sets(batch, "a"), sets(batch, "b")):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(rows, run, "a long, b long").distinct()


def _tiles(large: DataFrame, labels: DataFrame, tile_rows: int) -> DataFrame:
    """Members of large buckets, once for each tile of pairs they take part in.

    Tile (low, i, j) holds the pairs of part i of band ``low`` with part j of the same band (if i <= j) and of the next band.
    ``before`` is the token of the member's previous large bucket: two members that agree on it share an earlier hash, and meet
    there. Tiles are left out in which all members agree on it, or are of one component.
    """
    members = large.select(F.col("x").alias("token"), F.col("y").alias("rep"), "n", F.col("at").alias("place"))
    members = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    members = members.withColumn("before", F.lag("token").over(Window.partitionBy("rep").orderBy("place")))
    members = members.withColumn("band", F.floor(F.log("n") / F.log(F.lit(BAND))).cast("int"))
    members = materialize(members, "members")
    seen = F.struct(
        F.count(F.lit(1)).alias("c"), F.min("label").alias("l"), F.max("label").alias("h"),
        F.count("before").alias("b"), F.min("before").alias("p"), F.max("before").alias("q"),
    )
    bands = members.groupBy("token", "band").agg(seen.alias("own"))
    of_token, own, up = Window.partitionBy("token"), F.col("own"), F.col("up")
    no_rows = F.lit(0).cast("long")
    alone = F.struct(no_rows.alias("c"), own["l"].alias("l"), own["h"].alias("h"), no_rows.alias("b"), own["p"].alias("p"), own["q"].alias("q"))
    bands = bands.withColumn("tiles", F.ceil(F.max("own.c").over(of_token) / tile_rows).cast("int"))
    bands = bands.withColumn("up", F.coalesce(F.max("own").over(of_token.orderBy("band").rangeBetween(1, 1)), alone))
    agree = (own["b"] + up["b"] == own["c"] + up["c"]) & (F.least(own["p"], up["p"]) == F.greatest(own["q"], up["q"]))
    bands = bands.withColumn("open", (F.least(own["l"], up["l"]) < F.greatest(own["h"], up["h"])) & ~F.coalesce(agree, F.lit(False)))
    bands = bands.withColumn("below", F.coalesce(F.max("open").over(of_token.orderBy("band").rangeBetween(-1, -1)), F.lit(False)))
    open_ = materialize(bands.filter(F.col("open") | F.col("below")).select("token", "band", "tiles", "open", "below"), "open")
    rows = members.join(open_, ["token", "band"])
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    tile, every = F.col("tile"), F.sequence(F.lit(0), F.col("tiles") - 1)

    def place(low: Column, i: Column, j: Column) -> Column:
        return F.struct(low.alias("low"), i.alias("i"), j.alias("j"))

    places = F.concat(
        F.transform(F.filter(every, lambda s: F.col("open")), lambda s: place(F.col("band"), tile, s)),
        F.transform(F.filter(every, lambda s: F.col("open") & (s < tile)), lambda s: place(F.col("band"), s, tile)),
        F.transform(F.filter(every, lambda s: F.col("below")), lambda s: place(F.col("band") - 1, s, tile)),
    )
    return rows.withColumn("at", F.explode(places)).select("token", "rep", "n", "place", "label", "before", "band", "tile", "at.*")


def tile_pairs(tiles: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components within a tile that the token and their bitmaps, folded once, leave possible."""
    rows = tiles.join(classes.select("rep", F.col("half").alias("bits")), "rep")
    key = ["token", "low", "i", "j"]
    rows = rows.repartition(*key).sortWithinPartitions(*key)

    def compare(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        low, one, two = (t[c][0].as_py() for c in ("low", "i", "j"))
        rep, n, place, label, band, tile = (t[c].to_numpy() for c in ("rep", "n", "place", "label", "band", "tile"))
        before, none_before = pc.fill_null(t["before"], 0).to_numpy(), pc.is_null(t["before"]).to_numpy()
        left = np.flatnonzero((band == low) & (tile == one))
        same = np.flatnonzero((band == low) & (tile == two)) if one < two else np.zeros(0, np.int64)
        right = np.concatenate((same, np.flatnonzero((band == low + 1) & (tile == two))))
        none = np.zeros(0, np.int64)
        if not len(left):
            return none, none
        maps = [np.frombuffer(x, np.uint64) for x in t["bits"].to_pylist()]
        words = min(map(len, maps))
        maps = np.stack([fold(m, words) for m in maps])
        n = n.astype(np.int64)
        a, b = [none], [none]
        for at, i in enumerate(left):
            others = np.concatenate((left[at + 1:], right)) if one == two else right
            later = (before[others] == before[i]) & ~none_before[others] & ~none_before[i]  # the token is not the first they share
            others = others[(label[others] != label[i]) & ~later & _first_shared(n[others], place[others], n[i], place[i], percent)]
            if len(others):
                more = np.bitwise_count(maps[i] & ~maps[others]).sum(axis=1, dtype=np.int64)
                less = np.bitwise_count(maps[others] & ~maps[i]).sum(axis=1, dtype=np.int64)
                others = others[np.minimum(n[i] - more, n[others] - less) >= least_overlap(n[i], n[others], percent)]
                a.append(np.full(len(others), rep[i]))
                b.append(rep[others])
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Batches) -> Batches:
        kept: list[pa.Table] = []

        def groups(done: bool):
            nonlocal kept
            if not kept:
                return
            whole = pa.concat_tables(kept).combine_chunks()
            code = [whole[c].to_numpy() for c in key]
            new = np.ones(len(whole), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in code], axis=0)
            cuts = np.append(np.flatnonzero(new), len(whole))
            for low, high in zip(cuts[:-1], cuts[1:] if done else cuts[1:-1]):
                if high - low > 1:
                    a, b = _distinct(*compare(whole.slice(low, high - low)))
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            kept = [] if done else [whole.slice(cuts[-2])]

        for batch in batches:
            if len(batch):
                kept.append(pa.Table.from_batches([batch]))
                yield from groups(False)
        yield from groups(True)

    return map_batches(rows, run, "a long, b long")


def group(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS,
    small_bucket: int = SMALL_BUCKET, tile_rows: int = TILE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Null and empty texts, and texts without words, have no shingle and are linked with nothing. Rows that repeat an id are
    one node: what one of them is linked with, all are. A null id keeps its set, takes part in no link and has a null component.
    """
    sets = materialize(set_table(docs, doc_id, text, percent, words), "sets")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = sets.filter(F.col("doc_id").isNotNull())
    named = known.filter(F.col("digest").isNotNull())
    code = F.xxhash64("digest")
    repeated = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.min(code).alias("l"), F.max(code).alias("h")).filter("c > 1")
    repeated = materialize(repeated.select("doc_id", (F.col("l") < F.col("h")).alias("varied")), "repeated")
    varied = repeated.filter("varied").select("doc_id")
    one_set = varied.isEmpty()
    # A class is named by its least id, or by a hash of its own if rows of that id have other sets too.
    reps = named.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    if one_set:
        reps = materialize(reps, "classes")
        classes = named.join(reps.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"], "left_semi").withColumnRenamed("doc_id", "rep")
        edges = None
    else:
        several = varied.select(F.col("doc_id").alias("rep"), F.lit(True).alias("several"))
        reps = reps.join(small(several), "rep", "left").select("digest", "rep", F.when(F.col("several"), code).otherwise(F.col("rep")).alias("node"))
        reps = materialize(reps, "classes")
        classes = named.join(reps.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"]).drop("doc_id").withColumnRenamed("node", "rep")
        texts = texts_of(texts, varied, reps, words)
        # The sets of one id are linked, by the id.
        held = materialize(named.join(small(varied), "doc_id", "left_semi").join(reps.select("digest", "node"), "digest").select("doc_id", "node").distinct(), "held")
        hubs = materialize(held.groupBy("doc_id").agg(F.min("node").alias("a")), "hubs")
        edges = materialize(held.join(small(hubs), "doc_id").filter("a <> node").select("a", F.col("node").alias("b")).distinct(), "links")
    if not repeated.isEmpty():
        classes = classes.dropDuplicates(["rep", "digest"])
    classes = materialize(classes.select("rep", "n", "prefix", "bits", "half", "rough"), "sets")
    index = classes.select(F.posexplode("prefix").alias("at", "token"), "rep", "n")
    index = index.repartition("token").sortWithinPartitions("token", "rep")
    found = materialize(bucket_pairs(index, percent, small_bucket), "buckets")
    large = found.filter("large")
    least = large.groupBy("x").agg(F.min(F.struct("y", "n")).alias("least"))
    least = materialize(least.select("x", F.col("least.y").alias("a"), F.col("least.n").alias("m")), "least")
    fits = F.lit(100) * F.least("n", "m") >= F.lit(percent) * F.greatest("n", "m")
    stars = lookup_join(large, least, ["x"], ["y"], counted=large).filter((F.col("y") != F.col("a")) & fits).select("a", F.col("y").alias("b"))
    pairs = found.filter("not large").select(F.col("x").alias("a"), F.col("y").alias("b")).union(stars)
    links = materialize(linked(materialize(likely(pairs, classes, percent, "rough", "half", "bits"), "likely"), texts, "doc_id", "text", percent, words), "links")
    links = links if edges is None else links.union(edges)
    labels = components(links)
    if not large.isEmpty():
        more = likely(tile_pairs(_tiles(large, labels, tile_rows), classes, percent), classes, percent, "bits")
        more = materialize(linked(materialize(more, "likely"), texts, "doc_id", "text", percent, words), "links")
        if not more.isEmpty():
            labels = components(links.union(more))
    # A row's class gives its label.
    if one_set:
        of_class = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("label", "rep").alias("component_id"))
    else:
        of_class = materialize(reps.join(labels, "node", "left").select("digest", "rep", F.coalesce("label", "node").alias("label")), "labels")
        of_class = of_class.join(of_class.groupBy("label").agg(F.min("rep").alias("component_id")), "label").select("digest", "component_id")
    out = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "digest").join(of_class, "digest", "left")
    if not one_set:
        # Rows without shingles share the label of their id's other rows.
        out = materialize(out, "labels")
        of_id = out.filter("component_id is not null").join(small(varied), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("of_id"))
        out = out.join(small(materialize(of_id, "labels")), "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "of_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op8."""
    return group(docs)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` without those linked to a document of smaller id. Rows that repeat an id count once; columns unchanged, whatever their names."""
    return apart(docs, lambda d, **names: _keep_one(d, **names, **limits), doc_id=doc_id, text=text)


def _keep_one(docs: DataFrame, doc_id: str, **names) -> DataFrame:
    grouped = materialize(group(docs, doc_id, **names), "groups")
    gone = materialize(grouped.filter("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(small(gone), F.col(f"`{doc_id}`") == F.col("_gone"), "left_anti")
    twice = grouped.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if twice.isEmpty():
        return kept
    known = F.col(f"`{doc_id}`").isNotNull()
    return kept.filter(~known).unionByName(kept.filter(known).dropDuplicates([doc_id]))
