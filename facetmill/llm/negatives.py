"""Hard negatives for contrastive training: rows of another label that score just below an anchor's positives.

1. Rows are dealt into shards of a bounded number of vector components. An anchor's positives are searched in the shards of its
   own label only, negatives in all shards, as a stated query set against all rows, in blocks.
2. A shard stores the mean and the deviation of each segment of its vectors, in levels of 1, 4, 16, ... segments. Over a
   segment of n components a product is n times the means' product, plus or minus the product of the deviations. The sums
   over all segments bound the score from both sides.
3. Per level, rows whose bounds lie outside the wanted band of scores, or below the kth best lower bound inside it, drop out.
   The rest is refined by the next level; what is left is scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import fits_broadcast
from ..session import materialize
from .workers import Batches, map_batches

SCALE = 256
ANCHOR_STEP, MOVED_STEP, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
LEAST_PERCENT, MOST_PERCENT = 80, 100
SHARD_VALUES = 4_000_000
BLOCK = 16
_MOST = (1 << 63) - 1

Band = tuple[int, int]


def segment_bounds(length: int) -> list[np.ndarray]:
    """First components of the segments of each level; every level cuts the segments of the one before."""
    levels, n = [], 1
    while n == 1 or 4 * n <= length:
        levels.append(np.arange(n) * length // n)
        n *= 4
    return levels


def summaries(rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation (length of what the mean leaves) of each segment of each row, scaled so that products need no weights."""
    n = np.diff(np.append(starts, rows.shape[1]))
    mean = np.add.reduceat(rows, starts, axis=1) / n
    left = rows - np.repeat(mean, n, axis=1)
    return mean * np.sqrt(n), np.sqrt(np.add.reduceat(left * left, starts, axis=1))


class Shelf:
    """Vectors of one length with their segment summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.copies, self.rows = ids, labels, copies, rows
        self.starts = segment_bounds(rows.shape[1])
        self.levels = [summaries(rows, s) for s in self.starts]
        self.norms = np.sqrt((rows * rows).sum(axis=1))
        self.largest = float(np.abs(rows).max(initial=0))

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact products as 64-bit integers; what lies beyond them counts as the nearest."""
        if self.largest * float(np.abs(query).max()) * len(query) < 2.0**53:
            return (self.rows[at] @ query).astype(np.int64)
        q = [int(x) for x in query]
        products = (sum(int(x) * y for x, y in zip(row, q)) for row in self.rows[at])
        return np.array([max(-_MOST - 1, min(_MOST, p)) for p in products], np.int64)

    def search(self, queries: np.ndarray, ids: np.ndarray, labels: np.ndarray | None, bands: list[list[Band]], k: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Per query and band the (rows, scores) of its k best in the band; of equal scores the smaller ids.

        No row with the query's id is taken, and none of its label if ``labels`` are given.
        """
        with np.errstate(over="ignore", invalid="ignore"):
            own = [summaries(queries, s) for s in self.starts]
            norms = np.sqrt((queries * queries).sum(axis=1))
            middle, spread = self.levels[0][0] @ own[0][0].T, self.levels[0][1] @ own[0][1].T
            out = []
            for q in range(len(queries)):
                at = np.flatnonzero((self.ids != ids[q]) & (True if labels is None else self.labels != labels[q]))
                m, s = middle[at, q], spread[at, q]
                for level in range(len(self.levels)):
                    if level:
                        m, s = self.levels[level][0][at] @ own[level][0][q], self.levels[level][1][at] @ own[level][1][q]
                    s = s + 1e-7 * norms[q] * self.norms[at] + 1e-3  # sums are rounded
                    low, high = m - s, m + s
                    low[~np.isfinite(low)], high[~np.isfinite(high)] = -np.inf, np.inf
                    at = at[self._possible(low, high, bands[q], k)]
                found = self.scores(at, queries[q])
                out.append([self._best(at, found, band, k) for band in bands[q]])
        return out

    @staticmethod
    def _possible(low: np.ndarray, high: np.ndarray, bands: list[Band], k: int) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for least, most in bands:
            least, most = (-np.inf if least <= -_MOST else float(least)), (np.inf if most >= _MOST else float(most))
            inside = low[(low >= least) & (high <= most)]
            if len(inside) >= k:
                least = max(least, float(np.partition(inside, len(inside) - k)[len(inside) - k]))
            keep |= (high >= least) & (low <= most)
        return keep

    def _best(self, at: np.ndarray, scores: np.ndarray, band: Band, k: int) -> tuple[np.ndarray, np.ndarray]:
        inside = (scores >= band[0]) & (scores <= band[1])
        at, scores = at[inside], scores[inside]
        if len(at) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            at, scores = at[scores >= kth], scores[scores >= kth]
        order = np.lexsort((self.ids[at], -scores))[:k]
        order = np.repeat(order, np.minimum(self.copies[at[order]], k))[:k]
        return at[order], scores[order]


def band_below(score: int) -> Band:
    """The scores that make a row of another label a hard negative beside a positive of this score."""
    return -(-LEAST_PERCENT * score // MOST_PERCENT), score


def _vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length -> (row numbers, matrix) of a list column; components rounded down."""
    if not len(column):
        return {}
    ends = np.asarray(column.offsets)
    values = np.floor(column.values.to_numpy(zero_copy_only=False))
    lengths = np.diff(ends)
    out = {}
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out[int(n)] = at, values[ends[at][:, None] + np.arange(n)]
    return out


def _probe(shelf: DataFrame, asked: DataFrame, k: int, other_labels: bool) -> DataFrame:
    """(anchor_id, bound, vec_id, score): the k best of each shard in each band of the queries sent to it.

    ``shelf``: grp, part, id, label, copies, v. ``asked``: grp, part, id, label, v, bounds; without bounds every score is wanted.
    """
    columns = ["grp", "part", "query", "id", "label", "copies", "v", "bounds"]
    rows = shelf.withColumns({"query": F.lit(False), "bounds": F.lit(None).cast("array<long>")}).select(columns)
    rows = rows.unionByName(asked.withColumns({"query": F.lit(True), "copies": F.lit(1).cast("long")}).select(columns))
    rows = rows.repartition("grp", "part").sortWithinPartitions("grp", "part", "query")

    def build(pieces: list[pa.RecordBatch]) -> dict[int, Shelf]:
        parts: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for piece in pieces:
            for n, (at, matrix) in _vectors(piece["v"]).items():
                parts.setdefault(n, []).append((*(piece[c].to_numpy()[at] for c in ("id", "label", "copies")), matrix))
        return {n: Shelf(*(np.concatenate([p[i] for p in part]) for i in range(4))) for n, part in parts.items()}

    def run(batches: Batches) -> Batches:
        place, pieces, shelves = None, [], None
        for batch in batches:
            grp, part = batch["grp"].to_numpy(), batch["part"].to_numpy()
            query = batch["query"].to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.concatenate(([True], (grp[1:] != grp[:-1]) | (part[1:] != part[:-1]) | (query[1:] != query[:-1]))))
            for low, high in zip(cut, np.append(cut[1:], len(batch))) if len(batch) else ():
                if (grp[low], part[low]) != place:
                    place, pieces, shelves = (grp[low], part[low]), [], None
                piece = batch.slice(low, high - low)
                if not query[low]:
                    pieces.append(piece)
                    continue
                if shelves is None:
                    shelves, pieces = build(pieces), []
                out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
                ids, labels, bounds = piece["id"].to_numpy(), piece["label"].to_numpy(), piece["bounds"].to_pylist()
                for n, (at, matrix) in _vectors(piece["v"]).items():
                    if n not in shelves:
                        continue
                    for i in range(0, len(at), BLOCK):
                        some = at[i:i + BLOCK]
                        wanted = [bounds[r] or [_MOST] for r in some]
                        bands = [[band_below(b) for b in w] if other_labels else [(-_MOST - 1, _MOST)] for w in wanted]
                        found = shelves[n].search(matrix[i:i + BLOCK], ids[some], labels[some] if other_labels else None, bands, k)
                        for r, w, per_band in zip(some, wanted, found):
                            out += [(ids[r], b, shelves[n].ids[x], s) for b, (x, s) in zip(w, per_band) if len(x)]
                if out:
                    sizes = [len(x) for _, _, x, _ in out]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(np.array([o[i] for o in out], np.int64), sizes)) for i in (0, 1)]
                        + [pa.array(np.concatenate([o[i] for o in out])) for i in (2, 3)],
                        names=["anchor_id", "bound", "vec_id", "score"],
                    )

    return map_batches(rows, run, "anchor_id long, bound long, vec_id long, score long")


def _usable(vectors: DataFrame, label: Column, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(id, label, v, copies) of the rows that take part; equal rows are one."""
    v = F.col(f"`{vector}`")
    times = F.transform(v, lambda x: F.lit(float(scale)) * x.cast("double"))
    sound = F.forall(times, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), label.cast("long").alias("label"), times.alias("v"), sound.alias("sound"))
    return rows.filter("id is not null and label is not null and sound and size(v) > 0").groupBy("id", "label", "v").agg(F.count(F.lit(1)).alias("copies"))


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding",
    scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, shard_values: int = SHARD_VALUES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id``, ``label`` an expression over ``vectors``. A score is the product of
    two vectors of one length, whose components are scaled and rounded down; beyond 64 bits it counts as the nearest
    64-bit integer. Rows with a null id or label, a null or empty vector, or a null or non-finite component
    (after scaling) take no part. Rows that repeat an id are all candidates of other ids; as an anchor such an id counts once,
    with its least label and vector. Equal rows count as often as they occur. Ties go to the smaller id. Other columns are not read.
    """
    rows = materialize(_usable(vectors, label, vec_id, vector, scale), "vectors")
    anchors = rows.filter(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.label", "a.v")
    anchors = materialize(anchors, "anchors")
    sizes = rows.groupBy("label").agg(F.sum(F.size("v")).alias("values"))
    sizes = materialize(sizes.select("label", F.col("values"), F.ceil(F.col("values") / shard_values).cast("int").alias("parts")), "labels")
    labels = F.broadcast(sizes.select("label", "parts")) if fits_broadcast(sizes) else sizes.select("label", "parts")
    code = F.xxhash64("id", "v")

    home = rows.join(labels, "label").withColumns({"grp": F.col("label"), "part": F.pmod(code, F.col("parts")).cast("int")})
    asked = anchors.join(labels, "label").withColumns({"grp": F.col("label"), "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "bounds": F.lit(None).cast("array<long>")})
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    liked = _probe(home, asked, positives, False).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    liked = materialize(liked.select("anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    total = sizes.groupBy().agg(F.sum("values")).first()[0] or 0
    shards = max(1, -(-total // shard_values))
    # Below zero the band is empty.
    bounds = liked.filter("positive_score >= 0").groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("bounds"))
    every = rows.withColumns({"grp": F.lit(0).cast("long"), "part": F.pmod(code, F.lit(shards)).cast("int")})
    asked = anchors.join(bounds, "id").withColumns({"grp": F.lit(0).cast("long"), "part": F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))})
    best = Window.partitionBy("anchor_id", "bound").orderBy(F.desc("score"), "vec_id")
    hard = _probe(every, asked, negatives, True).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    hard = hard.select("anchor_id", F.col("bound").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return liked.join(hard, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def noisy_label() -> Column:
    """The label of query op11: of ids divisible by 7 it is moved to the next of ten."""
    label = F.col("label").cast("long")
    moved = F.when(label < 0, (label + 1) % LABELS).otherwise((label % LABELS + 1) % LABELS)
    return F.when(F.col("vec_id") % MOVED_STEP == 0, moved).otherwise(label)


def digest(vectors: DataFrame) -> DataFrame:
    """The columns of query op11."""
    return mine(vectors, F.col("id") % ANCHOR_STEP == 0, noisy_label())
