"""File-arrival ingest, duplicate suppression and late data as streams."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import utc_from_epoch
from ..operators.upsert import merge_columns, merge_touched, reprocess_late
from ..session import materialize


def arriving_json(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.jsonl", files_per_batch: int | None = None
) -> DataFrame:
    """Rows of newly arrived files; files with another suffix are ignored."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def append_stream(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived, each file once, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def suppress_copies(
    stream: DataFrame,
    key: Sequence[str],
    epoch: str = "time_stamp",
    delay: str = "7 days",
    salts: int = 1,
) -> DataFrame:
    """Drop re-delivered events that arrive within ``delay`` of the first copy.

    State is forgotten once the watermark has passed, so it does not grow with the
    stream. With ``salts`` above 1, for streams in which one event arrives in
    millions of copies, a first pass removes copies within random shares; it holds
    every key a second time.
    """
    if salts <= 1:
        timed = stream.withColumn("utc_timestamp", utc_from_epoch(epoch)).withWatermark("utc_timestamp", delay)
        return timed.dropDuplicatesWithinWatermark(list(key))
    return (
        stream.withColumn("utc_timestamp", utc_from_epoch(epoch))
        .withWatermark("utc_timestamp", delay)
        .withColumn("_salt", F.floor(F.rand() * salts).cast("int"))
        .dropDuplicatesWithinWatermark([*key, "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(list(key))
    )


def each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Run ``handle(batch, number)`` on all that has arrived, then stop."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_upsert(
    read_target: Callable[[], DataFrame],
    write_target: Callable[[DataFrame, int], None],
    keys: Sequence[str],
    measures: Sequence[str],
    date_column: str,
    days: int = 7,
    touched_only: bool = False,
    as_of: datetime.date | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch handler that upserts rows inside the late window (T2 with M7).

    With ``touched_only`` the handler passes on the touched days alone, for a
    ``write_target`` that overwrites date folders; otherwise the whole table.

    ``read_target`` gives the table as of the last finished batch,
    ``write_target`` stores the new version. Handling a batch twice gives the
    same table, which is what a restart after a lost driver does. Of several rows with one
    key in a batch the greatest counts, by date and then by all columns: a
    redelivered row must not stop the stream. A batch's changes are computed once.
    """

    def handle(batch: DataFrame, number: int) -> None:
        target = read_target()
        rest = [c for c in batch.columns if c not in keys and c != date_column]
        newest = F.max(F.struct(date_column, *rest)).alias("_row")
        latest = batch.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(batch.columns)
        changes = materialize(reprocess_late(latest, target, keys, measures, date_column, days, as_of), "late_batch")
        if touched_only:
            merged = merge_touched(target, changes, keys, measures, date_column)
        else:
            merged = merge_columns(target, changes, keys, measures)
        write_target(merged, number)

    return handle
