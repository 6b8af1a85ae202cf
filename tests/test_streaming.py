import json

from pyspark.sql import types as T

from facetmill.streaming import ingest

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("time_stamp", T.LongType()), T.StructField("v", T.LongType())]
)


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_each_file_is_appended_once_and_other_suffixes_are_ignored(spark, tmp_path):
    landing, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        ingest.append_stream(ingest.arriving_json(spark, str(landing), SCHEMA), out, mark).awaitTermination()
        return sorted(r.id for r in spark.read.schema(SCHEMA).parquet(out).collect())

    land(landing, "a.jsonl", {"id": 1})
    land(landing, "b.txt", {"id": 9})
    assert run() == [1]
    land(landing, "c.jsonl", {"id": 2}, {"id": 3})
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]


def test_copies_are_dropped_within_and_across_batches(spark, tmp_path):
    landing, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        stream = ingest.suppress_copies(ingest.arriving_json(spark, str(landing), SCHEMA), ["id"])
        ingest.append_stream(stream.select("id", "v"), out, mark).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    land(landing, "a.jsonl", *[{"id": 1, "time_stamp": 1_600_000_000 + i, "v": 0} for i in range(200)])
    assert run() == [1]
    land(landing, "b.jsonl", {"id": 1, "time_stamp": 1_600_000_500}, {"id": 2, "time_stamp": 1_600_000_600})
    assert run() == [1, 2]


def test_late_upsert_is_the_same_after_a_repeated_batch(spark, tmp_path):
    versions = {-1: str(tmp_path / "v")}
    target = spark.sql("select 1L id, date'2020-01-20' day, 0L v union all select 2L, date'2020-01-01', 0L")
    target.write.parquet(versions[-1])

    def read():
        return spark.read.parquet(versions[max(versions)])

    def write(df, number):
        path = str(tmp_path / f"v{len(versions)}")
        df.write.parquet(path)
        versions[number] = path

    handle = ingest.late_upsert(read, write, ["id"], ["v"], "day")
    batch = spark.sql(
        "select 1L id, date'2020-01-20' day, 5L v union all select 2L, date'2020-01-01', 5L union all select 3L, date'2020-01-15', 5L"
    )
    handle(batch, 0)
    first = sorted(tuple(r) for r in read().select("id", "v").collect())
    handle(batch, 1)
    assert first == sorted(tuple(r) for r in read().select("id", "v").collect()) == [(1, 5), (2, 0), (3, 5)]


def test_late_upsert_of_touched_days_leaves_other_folders(spark, tmp_path):
    from facetmill.session import materialize
    from facetmill.sources import writers

    path = str(tmp_path / "table")
    target = spark.sql("select 1L id, date'2020-01-20' day, 0L v union all select 2L, date'2020-01-19', 0L")
    writers.write_partitioned(target, path, "day")
    handle = ingest.late_upsert(
        lambda: spark.read.parquet(path).select("id", "day", "v"),
        lambda df, number: writers.write_partitioned(materialize(df, "touched"), path, "day"),
        ["id"], ["v"], "day", touched_only=True,
    )
    batch = spark.sql("select 1L id, date'2020-01-20' day, 5L v union all select 3L, date'2020-01-18', 6L")
    handle(batch, 0)
    handle(batch, 0)
    got = sorted((r.id, str(r.day), r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2020-01-20", 5), (2, "2020-01-19", 0), (3, "2020-01-18", 6)]
