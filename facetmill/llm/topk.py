"""Exact search for the largest inner products: a ball tree per shard, searched by branch and bound.

Shards have a bounded number of rows, so their number follows the table. A shard's tree is built where the shard is
read; queries stream past it in batches. Each query first searches its own shard; its kth score there goes along to
all other shards as the score to beat. Nodes are visited by their upper bound, q.c + |q| r, until it falls below
the kth score.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .workers import Batches, map_batches

K = 10
SCALE = 1024
QUERY_STEP = 100
SHARD_ROWS = 20_000
LEAF_ROWS = 128
_LEAST = -(1 << 63)


class BallTree:
    """Rows reordered so that every node is a slice of them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.center, self.radius, self.span, self.kids = [], [], [], []
        order = np.arange(len(ids))
        real = rows.astype(np.float64)
        todo = [(0, len(ids), -1)]
        while todo:
            low, high, parent = todo.pop()
            part = real[order[low:high]]
            node, center = len(self.span), part.mean(axis=0)
            self.center.append(center)
            self.radius.append(np.sqrt(((part - center) ** 2).sum(axis=1).max()))
            self.span.append((low, high))
            self.kids.append([])
            if parent >= 0:
                self.kids[parent].append(node)
            if high - low > LEAF_ROWS:
                # Along the line from the point farthest from the centre to the one farthest from that.
                one = part[((part - center) ** 2).sum(axis=1).argmax()]
                other = part[((part - one) ** 2).sum(axis=1).argmax()]
                half = (high - low) // 2
                order[low:high] = order[low:high][np.argpartition(part @ (other - one), half)]
                todo += [(low, low + half, node), (low + half, high, node)]
        self.center, self.radius = np.array(self.center), np.array(self.radius)
        self.ids, self.rows = ids[order], rows[order]
        # Products of integers below 2**26 add up exactly in floating point, which is faster.
        self.largest = int(np.abs(rows).max(initial=0))
        self.real = self.rows.astype(np.float64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of every query's product with any row of every node, rounded up."""
        q = queries.astype(np.float64)
        bound = q @ self.center.T + np.sqrt((q**2).sum(axis=1))[:, None] * self.radius
        return bound + np.abs(bound) * 1e-9 + 1e-3

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows with a score of ``least`` or more; of equal scores the smaller ids."""
        exact = max(self.largest, int(np.abs(query).max(initial=0))) < 1 << 22 and len(query) <= 1 << 9
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        heap = [(-bound[0], 0)]
        while heap:
            above, node = heapq.heappop(heap)
            if -above < least:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    if bound[kid] >= least:
                        heapq.heappush(heap, (-bound[kid], kid))
                continue
            low, high = self.span[node]
            found = (self.real[low:high] @ query.astype(np.float64)).astype(np.int64) if exact else self.rows[low:high] @ query
            good = (found >= least) & (self.ids[low:high] != own)
            if good.any():
                ids, scores = np.concatenate((ids, self.ids[low:high][good])), np.concatenate((scores, found[good]))
                if len(ids) >= k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    least = max(least, int(scores[-1]))
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null if the vector, or a component, is null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & F.coalesce(sound, F.lit(False)), F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint")))


def _probe(rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each shard for the queries sent to it. ``rows``: shard, query, id, v, least."""
    rows = rows.repartition("shard").sortWithinPartitions("shard", "query")

    def run(batches: Batches) -> Batches:
        shard, ids, vectors, trees = None, [], [], None

        def build() -> dict[int, BallTree]:
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_length.setdefault(len(v), []).append(i)
            all_ids = np.array(ids, np.int64)
            return {n: BallTree(all_ids[at], np.stack([vectors[i] for i in at])) for n, at in by_length.items() if n}

        for batch in batches:
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            column = {c: batch[c].to_numpy(zero_copy_only=False) for c in ("shard", "query", "id", "least")}
            values = [np.asarray(x.values, np.int64) for x in batch["v"]]
            i = 0
            while i < len(batch):
                if column["shard"][i] != shard:
                    shard, ids, vectors, trees = column["shard"][i], [], [], None
                if not column["query"][i]:
                    ids.append(column["id"][i])
                    vectors.append(values[i])
                    i += 1
                    continue
                trees = build() if trees is None else trees
                tree, j = trees.get(len(values[i])), i
                while j < len(batch) and column["shard"][j] == shard and len(values[j]) == len(values[i]):
                    j += 1
                if tree is not None:
                    bounds = tree.bounds(np.stack(values[i:j]))
                    for r in range(i, j):
                        out.append((column["id"][r], *tree.search(values[r], column["id"][r], bounds[r - i], k, int(column["least"][r]))))
                i = j
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _ in out], [len(x) for _, x, _ in out]).astype(np.int64)),
                     pa.array(np.concatenate([x for _, x, _ in out])), pa.array(np.concatenate([s for _, _, s in out]))],
                    names=["query_id", "vec_id", "score"],
                )

    return map_batches(rows, run, "query_id long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k best other rows.

    ``is_query`` is a condition on ``vec_id``. Vectors that are null or hold a null or non-finite component, and rows without an id, take no
    part. Products are taken between vectors of one length. Rows that repeat an id are all
    candidates of other queries; as a query such an id counts once, with its least vector. Scores are 64-bit integers.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), whole_numbers(F.col(f"`{vector}`")).alias("v")).filter("id is not null and v is not null")
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    asked = vectors.select(F.col(f"`{vec_id}`")).filter(is_query)
    queries = rows.join(asked.select(F.col(f"`{vec_id}`").cast("long").alias("id")).distinct(), "id", "left_semi")
    queries = queries.groupBy("id").agg(F.min(F.struct("v", "shard")).alias("q")).select("id", "q.v", F.col("q.shard").alias("home"))

    def sent(q: DataFrame) -> DataFrame:
        shelf = rows.select("shard", F.lit(False).alias("query"), "id", "v", F.lit(_LEAST).alias("least"))
        return shelf.unionByName(q.select("shard", F.lit(True).alias("query"), "id", "v", "least"))

    first = _probe(sent(queries.select(F.col("home").alias("shard"), "id", "v", F.lit(_LEAST).alias("least"))), k)
    if shards > 1:
        first = materialize(first, "nearest")
        enough = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s"))
        least = enough.select(F.col("query_id").alias("id"), F.when(F.col("c") >= k, F.col("s")).otherwise(_LEAST).alias("least"))
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
        rest = queries.join(least, "id", "left").select(F.explode(others).alias("shard"), "id", "v", F.coalesce("least", F.lit(_LEAST)).alias("least"))
        first = first.union(_probe(sent(rest), k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    """The columns of query op3."""
    return search(vectors, F.col("vec_id") % QUERY_STEP == 0)
