import random

import pytest
from pyspark.sql import functions as F, types as T

from facetmill.operators import quality
from facetmill.plans import checks, contracts


def test_each_violation_is_reported_once(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 1), (2, None, 1), (None, "b", 2), (None, "b", 3)], "k int, s string, n int"
    )
    assert rows(quality.null_counts(df, ["k", "s", "n"])) == [("k", 2), ("n", 0), ("s", 1)]
    assert quality.not_null(df, "s").count() == 1
    assert rows(quality.duplicates(df, "k")) == [(1, 2)], "NULL is no duplicate of NULL in a single column"
    assert rows(quality.duplicates(df, "k", "s", "n")) == [(1, "a", 1, 2)]
    report = quality.run_checks(df, ["k"], ["n"], [["k", "s"]])
    assert rows(report) == [("not_null:k", 2), ("unique:k,s", 2), ("unique:n", 1)]


def test_declared_types(spark, rows):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    wrong = quality.type_mismatches(df, {"k": T.LongType(), "s": T.StringType(), "gone": T.DateType()})
    assert rows(wrong) == [("gone", "date", None), ("k", "bigint", "int")]


def test_all_checks_of_a_table_share_one_scan(spark, rows):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 2, 3, 40 + i]), rng.choice([None, "", "a", f"b{i}"]), rng.choice([None, 7, i])) for i in range(400)]
    df = spark.createDataFrame(data, "k int, s string, n int").repartition(5)
    report = quality.run_checks(df, ["k", "s"], ["k", "s"], [["k", "s"], ["s", "n", "k"]])
    assert report._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    want = [(f"not_null:{c}", df.where(F.col(c).isNull()).count()) for c in ("k", "s")]
    want += [("unique:" + ",".join(k), quality.duplicates(df, *k).count()) for k in (["k"], ["s"], ["k", "s"], ["s", "n", "k"])]
    assert rows(report) == sorted(want, key=repr)
    assert {r.violations for r in quality.run_checks(df.limit(0), ["k"], ["s"]).collect()} == {0}
    assert quality.run_checks(df).count() == 0


def test_checks_are_counted_by_the_write(spark):
    declared = {"t": checks.Checks(["k", "s"], ["k"], [["k", "s"]])}
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (2, None)], "k int, s string")
    report = checks.Report(checks=declared)
    assert report.materialize("t", df).count() == 4 and report.materialize("undeclared", df).count() == 4
    assert sorted(map(tuple, report.to_df(spark).collect())) == [("t", "not_null:k", 1), ("t", "not_null:s", 1), ("t", "unique:k", 1), ("t", "unique:k,s", 0)]
    report = checks.Report(checks=declared)
    report.materialize("t", df.limit(0))
    assert [n for *_, n in report.rows] == [0] * 4
    with pytest.raises(checks.ViolatedError, match="unique:k"):
        checks.Report(True, declared).check("t", df)
    with pytest.raises(checks.ViolatedError, match="not_null:s"):
        checks.Report(True, declared).materialize("t", df)
    checks.Report(True, declared).materialize("t", df.where("s = 'a'"))


def test_outputs_must_have_the_columns_they_declare(spark):
    df = spark.createDataFrame([(1, "1", "DE", "Germany")], "store_key bigint, store_id string, country_code string, country_name string")
    full = df.selectExpr("*", "current_timestamp() AS created_at", "'a' AS created_by", "current_timestamp() AS updated_at", "'a' AS updated_by")
    assert contracts.promised("dim_store", full.select(*reversed(full.columns))).columns == full.columns
    assert contracts.promised("undeclared", df) is df
    for wrong, said in ((df, "created_at is missing"), (full.withColumn("store_key", F.lit("1")), "store_key is string, declared bigint"), (full.withColumn("more", F.lit(1)), "more is int")):
        with pytest.raises(contracts.ContractError, match=said):
            contracts.promised("dim_store", wrong)
    assert [r.column_name for r in contracts.mismatches("dim_store", full.drop("store_id")).collect()] == ["store_id"]
    assert set(contracts.CONTRACTS) <= set(checks.CHECKS)
    assert all(contracts.columns(name) == {f.name: f.dataType.simpleString() for f in contracts.declared(name)} for name in contracts.CONTRACTS)
    for name, c in checks.CHECKS.items():
        if name in contracts.CONTRACTS:
            assert set(c.not_null) | set(c.unique) | {x for k in c.combinations for x in k} <= set(contracts.declared(name).names)
