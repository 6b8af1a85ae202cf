import datetime as dt
from decimal import Decimal

from facetmill.operators import rates
from facetmill.plans import dims, facts, staging


def calendar(spark, start="2020-01-01", end="2020-01-05"):
    return staging.stg_generate_date(spark, end, start)


def rate_table(spark, data):
    return spark.createDataFrame(
        [(k, c, "USD", Decimal(str(r)) if r is not None else None) for k, c, r in data],
        "date_key bigint, from_currency_code string, to_currency_code string, exchange_rate decimal(38,9)",
    )


def currency_dim(spark, *codes):
    return dims.dim_currency(spark.createDataFrame([(c, c, None) for c in codes], "currency_code string, currency_name string, raw_symbol string"))


def test_gaps_are_filled_and_leading_days_absent(spark):
    table = rate_table(spark, [(20200102, "A", 2), (20200104, "A", 4), (20200105, "B", 9), (20200103, "X", 1)])
    known = currency_dim(spark, "A", "B")
    got = {
        (r.from_currency_code, r.date_key): float(r.exchange_rate)
        for r in rates.dense_rates(table, calendar(spark, end="2020-01-31"), known).collect()
    }
    assert got == {("A", 20200102): 2, ("A", 20200103): 2, ("A", 20200104): 4, ("A", 20200105): 4, ("B", 20200105): 9}


def test_rates_outside_the_calendar_are_not_carried_in(spark):
    table = rate_table(spark, [(20191231, "A", 1), (20200103, "A", 3), (20200203, "A", 5)])
    got = rates.dense_rates(table, calendar(spark), currency_dim(spark, "A")).collect()
    assert sorted((r.date_key, int(r.exchange_rate)) for r in got) == [(20200103, 3), (20200104, 3), (20200105, 3)]


def test_null_and_double_rates(spark):
    table = rate_table(spark, [(20200101, "A", 1), (20200101, "A", 7), (20200102, "A", None)])
    got = rates.dense_rates(table, calendar(spark), currency_dim(spark, "A")).collect()
    assert sorted((r.date_key, int(r.exchange_rate)) for r in got) == [(20200101, 7), (20200102, 7)]


def test_rate_fact_has_a_date_and_unique_keys_d13(spark):
    table = rate_table(spark, [(20200101, "A", 1), (20200103, "A", 2)])
    fact = facts.fact_snapshot_exchange_rate(calendar(spark), currency_dim(spark, "A", "USD"), table)
    got = fact.collect()
    assert dict(fact.dtypes)["full_date"] == "date" and got[0].full_date.year == 2020
    assert len({r.exchange_rate_key for r in got}) == len(got) == 3


def test_rate_fact_upsert_changes_rates_only(spark):
    known = currency_dim(spark, "A")
    old = facts.fact_snapshot_exchange_rate(calendar(spark), known, rate_table(spark, [(20200101, "A", 1), (20200102, "A", 2)]))
    new = facts.fact_snapshot_exchange_rate(
        calendar(spark), known, rate_table(spark, [(20200101, "A", 1), (20200102, "A", 5), (20200103, "A", 6)]), target=old
    )
    assert sorted((r.date_key, int(r.exchange_rate)) for r in new.collect()) == [
        (20200101, 1), (20200102, 5), (20200103, 6)
    ]


def test_conversion_rules_d16(spark):
    daily = spark.createDataFrame(
        [(20200101, "USD", Decimal(1)), (20200101, "EUR", Decimal("0.5")), (20200101, "VND", Decimal(20000))],
        "date_key bigint, from_currency_code string, exchange_rate decimal(38,9)",
    )
    lines = [
        (1, "68", "VND", Decimal("10"), 2), (2, "1", "LTL", Decimal("10"), 2), (3, "1", "VND", None, 2),
        (4, "1", "CHF", Decimal("10"), 2), (5, "1", "VND", Decimal("30000"), None), (6, "1", None, Decimal("1"), 1),
    ]
    df = spark.createDataFrame(
        [(i, s, c, 20200101, q, p) for i, s, c, p, q in lines],
        "id int, store_id string, country_currency string, order_date_key bigint, product_qty bigint, unit_price decimal(18,6)",
    )
    for spread in (None, ["id"]):
        got = {r.id: r for r in rates.convert_lines(df, daily, spread).collect()}
        assert got[1].currency_code == "USD" and got[1].usd_amount == 20
        assert got[2].currency_code == "EUR" and got[2].usd_unit_price == 20 and got[2].usd_amount == 40
        assert got[3].local_unit_price == 0 and got[3].usd_amount == 0
        assert got[4].usd_amount is None and got[4].local_amount == 20
        assert got[5].usd_unit_price == Decimal("1.5") and got[5].usd_amount is None
        assert got[6].currency_code is None and got[6].usd_amount is None


def test_spine_has_both_ends(spark):
    got = [r.full_date for r in calendar(spark, "2020-02-28", "2020-03-01").collect()]
    assert sorted(got) == [dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2020, 3, 1)]
