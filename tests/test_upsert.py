import datetime as dt

import pytest
from pyspark.sql import functions as F

from facetmill.operators import upsert

T0 = dt.datetime(2000, 1, 1)


def table(spark, data):
    return spark.createDataFrame(
        [(k, a, b, T0, "old", T0, "old") for k, a, b in data],
        "k int, a string, b string, created_at timestamp, created_by string, updated_at timestamp, updated_by string",
    )


def fresh(spark, data):
    return spark.createDataFrame(data, "k int, a string, b string")


def test_changed_or_new(spark):
    old = table(spark, [(1, "x", None), (2, "x", "y"), (3, "x", "y"), (5, None, "y")])
    new = fresh(spark, [(1, "x", None), (2, "X", "y"), (4, "n", "n"), (5, "v", "y")])
    got = {r.k: r for r in upsert.changed_or_new(new, old, ["k"], ["a"], keep=["b"]).collect()}
    assert sorted(got) == [2, 4, 5], "NULL to value is a change (X12), equal NULLs are none"
    assert got[2].created_by == "old" and got[2].updated_by != "old" and got[4].created_by != "old"


def test_kept_columns_stay(spark):
    old, new = table(spark, [(1, "x", "keep")]), fresh(spark, [(1, "z", "drop")])
    [row] = upsert.changed_or_new(new, old, ["k"], ["a"], keep=["b"]).collect()
    assert (row.a, row.b) == ("z", "keep")


def test_merge_changes_listed_columns_only(spark, rows):
    old = fresh(spark, [(1, "a1", "b1"), (2, "a2", "b2"), (3, None, "b3")])
    new = fresh(spark, [(1, None, "B1"), (3, "A3", "B3"), (4, "A4", "B4")])
    got = rows(upsert.merge_columns(old, new, ["k"], ["a"]))
    assert got == [(1, None, "b1"), (2, "a2", "b2"), (3, "A3", "b3"), (4, "A4", "B4")]


def test_merge_is_idempotent_and_refuses_double_keys(spark, rows):
    old, new = fresh(spark, [(1, "a", "b")]), fresh(spark, [(1, "c", "d"), (2, "e", "f")])
    once = upsert.merge_columns(old, new, ["k"], ["a", "b"])
    assert rows(upsert.merge_columns(once, new, ["k"], ["a", "b"])) == rows(once)
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.merge_columns(old, new.unionByName(new), ["k"], ["a"])


def test_carried_audit(spark):
    old = table(spark, [(1, "x", None), (2, "x", "y")])
    got = {r.k: r for r in upsert.with_carried_audit(fresh(spark, [(1, "x", None), (2, "x", None), (3, "n", "n")]), old, ["k"], ["a", "b"]).collect()}
    assert (got[1].updated_by, got[1].created_by) == ("old", "old")
    assert got[2].updated_by != "old" and got[2].created_by == "old" and got[3].created_by != "old"
    always = upsert.with_carried_audit(fresh(spark, [(1, "x", None)]), old, ["k"]).first()
    assert always.created_by == "old" and always.updated_by != "old"


def dated(spark, data):
    return spark.createDataFrame(
        [(k, dt.date(2020, 1, d), v, o) for k, d, v, o in data], "k int, day date, v int, other string"
    )


def test_late_window_uses_the_date_column_d1(spark):
    target = dated(spark, [(1, 20, 0, "t"), (2, 17, 0, "t"), (3, 10, 0, "t")])
    staged = dated(spark, [(1, 20, 1, "s"), (2, 17, 2, "s"), (3, 10, 3, "s"), (4, 13, 4, "s"), (5, 12, 5, "s"), (6, 25, 6, "s")])
    got = {r.k: (r.v, r.other) for r in upsert.reprocess_late(staged, target, ["k"], ["v"], "day").collect()}
    assert got == {1: (1, "t"), 2: (2, "t"), 4: (4, "s"), 6: (6, "s")}
    assert upsert.reprocess_late(staged, target.limit(0), ["k"], ["v"], "day").count() == 6


def test_high_water_mark(spark):
    source, target = dated(spark, [(1, 1, 0, "")] + [(2, 5, 0, "")]), dated(spark, [(9, 1, 0, "")])
    assert [r.k for r in upsert.newer_than_target(source, target, "day").collect()] == [2]


def test_no_update_without_difference(spark):
    old = table(spark, [(i, "x", "y") for i in range(20)])
    assert upsert.changed_or_new(old.select("k", "a", "b"), old, ["k"], ["a", "b"]).count() == 0
    assert old.where(F.col("updated_by") != "old").count() == 0


def test_a_small_window_does_not_move_the_rows_that_replace_it(spark, rows):
    old = table(spark, [(1, "g", "x"), (2, "g", "y"), (3, "h", "z"), (4, None, "z")])
    new = fresh(spark, [(1, "g", "X"), (5, "i", "new"), (6, None, "null")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = upsert.replace_groups(new, old, "a", ["k"])
        joins = got._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.k, r.a, r.b, r.created_by == "old") for r in got.where("a is not null").collect()) == [
            (1, "g", "X", True), (3, "h", "z", True), (5, "i", "new", False)
        ]
        assert {r.k for r in got.where("a is null").collect()} == {4, 6}, "rows without a group replace none"
        assert "SortMergeJoin [k" not in joins and "BroadcastHashJoin [k" in joins
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
