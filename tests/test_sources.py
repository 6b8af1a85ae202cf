import json
import os

import pytest

from facetmill import schemas, session
from facetmill.sources import readers, writers


def files(path, suffix):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(suffix)]


def test_json_lines_are_capped_per_file(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_json_lines(spark.range(2500).coalesce(1), path, records_per_file=1000)
    assert len(files(path, ".json")) == 3
    assert spark.read.schema("id bigint").json(path).count() == 2500


def test_json_lines_can_be_compressed(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_json_lines(spark.range(2500).coalesce(1), path, records_per_file=1000, compression="gzip")
    assert len(files(path, ".json.gz")) == 3
    assert spark.read.schema("id bigint").json(path).count() == 2500


def test_json_reader_skips_other_suffixes_and_keeps_field_with_space(spark, tmp_path):
    line = {"_id": "1", "option": [{"category id": "5"}], "cart_products": [{"product_id": "1", "amount": 2}], "extra": 1}
    (tmp_path / "a.jsonl").write_text(json.dumps(line) + "\n")
    (tmp_path / "b.json").write_text(json.dumps(line) + "\n")
    [row] = readers.read_events(spark, str(tmp_path)).collect()
    assert row.option[0]["category id"] == "5" and row.cart_products[0].amount == 2


def test_seed_with_byte_order_mark_quotes_and_text_na(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes(
        "﻿country_code_iso2,country_name,currency_code,currency_name,phone_code,country_group\n"
        'CD,"Congo, The Democratic Republic of the",CDF,Congolese Franc,243,Africa\n'
        "NA,Namibia,NAD,Namibia Dollar,264,Africa\n".encode()
    )
    got = {r.country_code_iso2: r for r in readers.read_seed(spark, str(tmp_path / "c.csv"), schemas.COUNTRIES).collect()}
    assert got["CD"].country_name == "Congo, The Democratic Republic of the"
    assert got["NA"].currency_code == "NAD"


def test_csv_drops_helper_column_if_present(spark, tmp_path):
    df = spark.createDataFrame([("1.1.1.1", "NA", True)], "ip_address string, country_code string, Mapped boolean")
    for i, source in enumerate([df, df.drop("Mapped")]):
        writers.write_csv(source, str(tmp_path / str(i)))
        assert spark.read.option("header", True).csv(str(tmp_path / str(i))).columns == ["ip_address", "country_code"]


def test_dated_snapshot_folders(spark, tmp_path):
    path = str(tmp_path / "snap")
    writers.write_snapshot(spark.range(3), path, "2024-01-01")
    writers.write_snapshot(spark.range(2), path, "2024-01-02")
    assert sorted(os.listdir(path))[-2:] == ["load_date=2024-01-01", "load_date=2024-01-02"]
    assert files(path, ".snappy.parquet") and spark.read.parquet(path).count() == 5


def test_partition_overwrite_touches_given_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.sql("select id, date_add(date'2020-01-01', cast(id % 3 as int)) d from range(30)")
    writers.write_partitioned(base, path, "d", ["id"])
    writers.write_partitioned(spark.sql("select 99L id, date'2020-01-02' d"), path, "d")
    got = {str(r.d): r.n for r in spark.read.parquet(path).groupBy("d").agg({"id": "count"}).withColumnRenamed("count(id)", "n").collect()}
    assert got == {"2020-01-01": 10, "2020-01-02": 1, "2020-01-03": 10}


def test_clustered_files_cover_disjoint_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_clustered(spark.range(10000).selectExpr("(id * 7919) % 10007 k", "id"), path, ["k"])
    spans = sorted(
        (r[0], r[1]) for r in spark.read.parquet(path).selectExpr("k", "_metadata.file_name f").groupBy("f").agg({"k": "min"}).join(
            spark.read.parquet(path).selectExpr("k", "_metadata.file_name f").groupBy("f").agg({"k": "max"}), "f"
        ).select("min(k)", "max(k)").collect()
    )
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    with pytest.raises(ValueError):
        writers.write_clustered(spark.range(1), path, [])


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_table(spark.range(5), path)
    writers.append_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 10
    writers.replace_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_work_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert session.new_folder(spark, "x").startswith(named)
    df = session.materialize(spark.range(3), "x")
    assert df.count() == 3 and df.inputFiles()[0].replace("file://", "").startswith(named)
