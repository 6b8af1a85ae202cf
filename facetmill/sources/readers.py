"""Typed scans of the landing files. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str = "*.jsonl"
) -> DataFrame:
    """Newline JSON under a folder; files with another name are ignored.

    Files written by Spark itself end in ``.json``: read them with ``glob="*.json"``.
    """
    return spark.read.schema(schema).option("pathGlobFilter", glob).json(path)


def read_events(spark: SparkSession, path: str | list[str], glob: str = "*.jsonl") -> DataFrame:
    """Normalised event log, 34 columns."""
    return read_json_lines(spark, path, schemas.EVENTS, glob)


def read_raw_events(
    spark: SparkSession, path: str | list[str], glob: str = "*.jsonl"
) -> DataFrame:
    """Event log before normalisation: polymorphic fields stay JSON text.

    Feed it to :func:`facetmill.operators.normalize.normalize_events`.
    """
    return read_json_lines(spark, path, schemas.RAW_EVENTS, glob)


def read_products(
    spark: SparkSession, path: str | list[str], glob: str = "*.jsonl", loaded: str | None = None
) -> DataFrame:
    """Product attributes, 27 columns.

    The required key is checked by ``operators.quality.not_null``; a JSON
    reader cannot enforce it. ``loaded`` names one more column with the time of the file a row came in: of
    several crawls of a product the latest one counts (J10).
    """
    rows = read_json_lines(spark, path, schemas.PRODUCTS, glob)
    return rows.withColumn(loaded, F.col("_metadata.file_modification_time")) if loaded else rows


def _read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .csv(path)
    )


def read_ip_locations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """IP locations from CSV (S3). The text ``NA`` stays text."""
    return _read_csv(spark, path, schemas.IP_LOCATIONS)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A reference table kept as CSV (S4): countries, currencies or exchange rates.

    A byte-order mark before the header is dropped by the reader.
    """
    return _read_csv(spark, path, schema)


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both ends included.

    ``end`` is a parameter, so that a run can be repeated on another day.
    """
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(0, 1, 1, 1).select(F.explode(days).alias("full_date"))
