"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUN_FOLDER = "spark.facetmill.run.folder"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app: str = "facetmill", master: str | None = None, input_gb: float | None = None, **conf: str
) -> SparkSession:
    """A session with adaptive execution on, UTC time and the UI off.

    ``input_gb``: size of the largest input. Shuffles start with a partition per
    128 MB of it; adaptive execution can merge small ones, but does not cut large ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Parquet unfolds to several times its file size; join choices should know.
        .config("spark.sql.sources.fileCompressionFactor", "4.0")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        # Call sites are captured per column expression otherwise, which slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if input_gb:
        builder = builder.config("spark.sql.shuffle.partitions", str(max(200, round(8 * input_gb))))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is set only where none is named and Spark runs inside
    one process (tests, local runs). On a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="facetmill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the query that wrote them ends, for the whole session, unless it says otherwise itself.

    Steps that are written are not computed again, so what was shuffled for them has no reader. Spark would keep it until the
    driver's garbage is collected, which may be never, and a long build would need the disk for all its shuffles at once.
    """
    if spark.conf.get(SHUFFLE_CLEANUP, None) is None:
        spark.conf.set(SHUFFLE_CLEANUP, "true")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder of the run, or else the shared folder. The caller's job creates it."""
    drop_shuffles(spark)
    return f"{spark.conf.get(RUN_FOLDER, None) or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """What is materialized inside the block is removed at its end. Results must be written elsewhere by then.

    It holds for the whole session, threads included; a block inside another one adds nothing.
    """
    outer = spark.conf.get(RUN_FOLDER, None)
    if outer:
        yield outer
        return
    folder = new_folder(spark, "run")
    spark.conf.set(RUN_FOLDER, folder)
    try:
        yield folder
    finally:
        spark.conf.unset(RUN_FOLDER)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """Like :func:`materialize`, in buckets of ``key``: joins and groupings by ``key`` then need no shuffle of this table.

    There are as many buckets as a shuffle has partitions; rows that come dealt by the same hash give one file each.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("compression", "zstd").option("path", new_folder(spark, label)).bucketBy(parts, key).saveAsTable(name)
    out = spark.table(name).select("*")
    # Only the name goes: the files are outside of the warehouse, and ``out`` knows them.
    spark.sql(f"DROP TABLE {name}")
    return out


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several consumers need the same expensive result. It cuts the
    lineage, so a lost executor never recomputes what came before, and gives
    the planner exact file sizes for its join choice.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
