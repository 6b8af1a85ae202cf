"""Rows that no job may fail on, and upserts that correct what is there."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from facetmill.functions import dates, money
from facetmill.operators import rates, upsert
from facetmill.plans import dims, facts, staging
from facetmill.streaming import ingest


def test_oversized_numbers_give_null(spark):
    df = spark.createDataFrame([(99_999_999_999, "999999999999.00"), (10**18, "1"), (3, "2.5"), (None, "1")], "q bigint, p string")
    price = F.col("p").cast("decimal(18,6)")
    got = df.select(money.times("q", price).alias("a"), money.in_dollars(money.times("q", price), F.lit("2").cast("decimal(18,9)")).alias("d")).collect()
    assert [None if r.a is None else float(r.a) for r in got] == [None, None, 7.5, None]
    assert [None if r.d is None else float(r.d) for r in got] == [None, None, 3.75, None]
    huge = spark.range(1).select(money.in_dollars(F.lit("9" * 30).cast("decimal(38,0)"), F.lit("0.000000001").cast("decimal(18,9)")).alias("d"))
    assert huge.first().d is None


def test_epochs_in_microseconds_give_null(spark):
    df = spark.createDataFrame([(1_580_515_200_000_000,), (-(10**18),), (0,), (None,)], "t bigint")
    assert [r[0] is None for r in df.select(dates.utc_from_epoch("t")).collect()] == [True, True, False, True]


def test_unusable_amounts_are_reported(spark):
    item = [("p", 10**18, "999999999999.00", "EUR"), ("p", 2, "3.00", "EUR")]
    events = spark.createDataFrame(
        [("checkout_success", str(i), "2020-01-01 10:00:00", "1", "ip", "u", "", [x]) for i, x in enumerate(item)],
        "collection string, order_id string, local_time string, store_id string, ip string, user_id_db string, email_address string, "
        "cart_products array<struct<product_id string, amount bigint, price string, currency string>>",
    )
    assert [(r.order_id, r.reason) for r in staging.rejected_lines(events).collect()] == [("0", "amount")]


def test_a_day_that_does_not_exist_harms_no_rate(spark):
    known = spark.createDataFrame([("EUR", "USD", 20190101, 1.0), ("EUR", "USD", 20190107, 2.0), ("EUR", "USD", 20191399, 9.0)],
                                  "from_currency_code string, to_currency_code string, date_key bigint, exchange_rate double")
    days = [dt.date(2019, 1, d) for d in range(1, 9) if d != 4]
    calendar = spark.createDataFrame([(d,) for d in days], "full_date date")
    got = rates.dense_rates(known, calendar, spark.createDataFrame([("EUR",)], "currency_code string")).collect()
    assert {r.full_date: r.exchange_rate for r in got} == {d: 1.0 if d.day < 7 else 2.0 for d in days if d.day <= 7}
    assert [r.date_key for r in rates.rejected_rates(known).collect()] == [20191399]


def sales(spark, data):
    rows = spark.createDataFrame([(o, dt.date.fromisoformat(d), p) for o, d, p in data], "order_id string, local_order_date date, price double")
    return rows.withColumns({
        "sales_key": F.xxhash64("order_id", "price"), "order_date_key": F.lit(0), "scd_customer_key": F.lit(0), "product_key": F.lit(0),
        **{c: F.lit("2000-01-01").cast("timestamp") for c in ("created_at", "updated_at")}, **{c: F.lit("old") for c in ("created_by", "updated_by")},
    })


AS_OF = dt.date(2020, 1, 20)


def test_a_future_date_does_not_close_the_window(spark):
    target = sales(spark, [("1", "2020-01-10", 1.0), ("2", "2099-01-01", 1.0)])
    rows = sales(spark, [("3", "2020-01-09", 5.0), ("4", "2020-01-01", 5.0), ("5", "2020-01-30", 5.0)]).drop("created_at", "created_by", "updated_at", "updated_by")
    assert sorted(r.order_id for r in facts.late_sales(rows, target, as_of=AS_OF).collect()) == ["3", "5"]
    assert [r.order_id for r in facts.late_rejects(rows, target, as_of=AS_OF).collect()] == ["4"]


@pytest.mark.parametrize("moved", [False, True])
def test_corrected_orders_replace_their_lines(spark, tmp_path, moved):
    path = str(tmp_path / "fact")
    facts.write_sales(sales(spark, [("1", "2020-01-10", 10.0), ("2", "2020-01-11", 4.0), ("3", "2019-12-01", 7.0)]), path)
    day = "2020-01-12" if moved else "2020-01-10"
    rows = sales(spark, [("1", day, 9.0), ("9", "2019-11-30", 1.0)]).drop("created_at", "created_by", "updated_at", "updated_by")
    rejects = facts.upsert_sales(rows, path, as_of=AS_OF)
    got = sorted((r.order_id, str(r.local_order_date), r.price) for r in spark.read.parquet(path).collect())
    assert got == sorted([("1", day, 9.0), ("2", "2020-01-11", 4.0), ("3", "2019-12-01", 7.0)])
    assert [r.order_id for r in rejects.collect()] == ["9"]


def test_the_target_scan_names_the_touched_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts.write_sales(sales(spark, [("1", "2020-01-10", 10.0), ("2", "2020-01-11", 4.0)]), path)
    target = spark.read.parquet(path)
    changes = sales(spark, [("1", "2020-01-10", 9.0)])
    merged = upsert.merge_touched(target, changes, ["order_id"], ["price"], "local_order_date")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    filters = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert any("local_order_date" in f and ("2020-01-10" in f or "18271" in f) for f in filters)
    assert {str(r.local_order_date) for r in merged.collect()} == {"2020-01-10"}


def test_a_late_event_leaves_one_current_version(spark):
    def staged(data):
        rows = spark.createDataFrame([(u, e, f"2020-01-{d:02d} 00:00:00", 1_577_836_800 + 86_400 * d) for u, e, d in data],
                                     "user_id_db string, email_address string, local_time string, time_stamp bigint")
        return staging.stg_user_email_by_local_datetime(rows)

    first = [("u", "a", 5), ("u", "b", 9), ("v", "x", 1)]
    target = dims.dim_customer_scd(staged(first))
    scd = dims.dim_customer_scd(staged(first[:2] + [("u", "b", 7)]), target=target)
    mine = sorted((r.start_local_datetime.day, r.email_address, r.is_current) for r in scd.where("user_id_db = 'u'").collect())
    assert mine == [(5, "a", False), (7, "b", True)]
    assert scd.where("user_id_db = 'v'").count() == 1 and scd.where("user_id_db = '-1'").count() == 1


def test_a_key_twice_in_a_batch_does_not_stop_the_stream(spark, tmp_path):
    state = {"v": str(tmp_path / "v0")}
    spark.sql("select 1L id, date'2020-01-10' day, 0L v").write.parquet(state["v"])

    def write(df, number):
        path = str(tmp_path / f"v{number + 1}")
        df.write.parquet(path)
        state["v"] = path

    handle = ingest.late_upsert(lambda: spark.read.parquet(state["v"]), write, ["id"], ["v"], "day", as_of=AS_OF)
    handle(spark.sql("select 1L id, date'2020-01-10' day, 5L v union all select 1L, date'2020-01-10', 7L union all select 2L, date'2020-01-10', 1L"), 0)
    assert sorted((r.id, r.v) for r in spark.read.parquet(state["v"]).collect()) == [(1, 7), (2, 1)]
