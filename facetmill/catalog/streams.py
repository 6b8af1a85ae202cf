"""Streams over files, run until everything that has arrived is processed."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..plans import testdata as td
from ..session import materialize, new_folder
from ..sources import writers
from ..streaming import ingest
from .registry import query

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("time_stamp", T.LongType()),
    ]
)


def _landed(spark, folder):
    """All events as JSON files in a new folder, beside CSV files that must be ignored."""
    path = new_folder(spark, "landing")
    events = td.table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time_stamp"),
    )
    writers.write_json_lines(events, path)
    events.write.mode("append").csv(path)
    return path


@query("SELECT event_id, user_id, event_type, CAST(value AS DOUBLE) AS value FROM events")
def stream_file_ingest(spark, folder):
    """Each arriving file is appended once."""
    landing, out, mark = _landed(spark, folder), new_folder(spark, "ingested"), new_folder(spark, "mark")
    for _ in range(2):  # the second run finds nothing new
        ingest.append_stream(
            ingest.arriving_json(spark, landing, EVENT, glob="*.json"), out, mark
        ).awaitTermination()
    return spark.read.schema(EVENT).parquet(out).drop("time_stamp")


@query("SELECT DISTINCT event_id, user_id, event_type FROM events")
def stream_dedup(spark, folder):
    """The same files delivered twice."""
    landing, out, mark = _landed(spark, folder), new_folder(spark, "deduped"), new_folder(spark, "mark")
    writers.write_json_lines(
        spark.read.schema(EVENT).option("pathGlobFilter", "*.json").json(landing), landing
    )
    stream = ingest.arriving_json(spark, landing, EVENT, glob="*.json")
    unique = ingest.suppress_copies(stream, ["event_id"]).select("event_id", "user_id", "event_type")
    ingest.append_stream(unique, out, mark).awaitTermination()
    return spark.read.parquet(out)


@query("""WITH last AS (SELECT max(CAST(ts AS DATE)) - 7 AS floor FROM events WHERE event_type <> 'purchase')
  SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
    CASE WHEN CAST(ts AS DATE) >= floor THEN value + 1 ELSE value END AS value FROM events CROSS JOIN last
  WHERE event_type <> 'purchase' OR CAST(ts AS DATE) >= floor""")
def stream_late_upsert(spark, folder):
    """T2 with M7: rows within seven days of the target's newest one are merged into the touched day folders; all files arrive twice."""
    landing, mark = _landed(spark, folder), new_folder(spark, "mark")
    path = new_folder(spark, "target")

    def shaped(df):
        return df.select("event_id", F.to_date(F.timestamp_seconds("time_stamp")).alias("day"), "value")

    known = spark.read.schema(EVENT).option("pathGlobFilter", "*.json").json(landing)
    writers.write_partitioned(shaped(known.where("event_type <> 'purchase'")), path, "day")
    writers.write_json_lines(known, landing)

    def read():
        return spark.read.parquet(path).select("event_id", "day", "value")

    def write(df, number):
        writers.write_partitioned(materialize(df, "touched"), path, "day")

    stream = shaped(
        ingest.arriving_json(spark, landing, EVENT, glob="*.json").withColumn("value", F.col("value") + 1)
    )
    handler = ingest.late_upsert(read, write, ["event_id"], ["value"], "day", touched_only=True)
    ingest.each_batch(stream, handler, mark).awaitTermination()
    return read()
