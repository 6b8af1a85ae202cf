"""Python workers: where they find this package, and Arrow batches of bounded size for them."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BATCH_BYTES = 4 << 20
#: Bytes of a batch on its way to Python: Spark's own limit lets an executor hold several copies of 10,000 long texts for each task.
ARROW_LIMIT, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"

Batches = Iterator[pa.RecordBatch]


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema) -> DataFrame:
    """``df.mapInArrow`` for functions of this package.

    Workers look for the package where the driver found it, besides the places they know (``--py-files``, an
    installed package), so that a program that only extended its own ``sys.path`` runs too. Batches are bounded in bytes for
    the whole session, unless it sets a limit itself.
    """
    conf = df.sparkSession.conf
    if ARROW_LIMIT not in conf.getAll:
        conf.set(ARROW_LIMIT, ARROW_BYTES)
    env = df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, known), _ROOT])
    return df.mapInArrow(fn, schema)


def bounded(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Batches:
    """The rows of a batch in runs whose ``column`` holds at most ``limit`` bytes, or in single longer rows."""
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0)
    sizes = np.cumsum(np.asarray(lengths.to_numpy(zero_copy_only=False), np.int64))
    low = 0
    while low < len(batch):
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.slice(low, high - low)
        low = high
