"""The whole chain on hand-written retail files."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from facetmill import schemas, sources
from facetmill.functions.urls import StoreUrlRules
from facetmill.operators import normalize, quality
from facetmill.operators.intervals import version_at
from facetmill.plans import checks, dims, facts, lists, mart, pipeline, staging
from facetmill.session import RUN_FOLDER, materialize


def event(**fields):
    base = {
        "_id": "e", "time_stamp": 1577934245, "ip": "1.0.0.7", "user_id_db": "u1", "store_id": "1",
        "local_time": "2020-01-02 03:04:05", "current_url": "https://www.shop.de/x", "email_address": "",
        "collection": "view_product_detail", "option": "", "cart_products": None,
    }
    return base | fields


def item(pid, amount, price, **more):
    return {"product_id": pid, "amount": amount, "price": price, "currency": "€ "} | more


CART = [item("p1", 2, "1.234,50"), item("p1", 1, "1.234,50", option={"option_label": "x"}), item("p1", 1, "99,00"), item("p2", 1, "")]
LOG = [
    event(_id="1", local_time="2020-01-01 10:00:00", time_stamp=1577872800),
    event(_id="2", local_time="2020-01-02 03:00:00", time_stamp=1577934000, email_address="a@x.de"),
    event(_id="3", collection="checkout_success", order_id="100.0", cart_products=CART, email_address="a@x.de"),
    event(_id="4", collection="checkout_success", order_id="100.0", cart_products=CART, email_address="a@x.de"),
    event(_id="5", collection="checkout_success", order_id="101", cart_products=[], email_address="a@x.de"),
    event(_id="6", collection="checkout_success", order_id="102", cart_products="none"),
    event(_id="7", collection="checkout_success", order_id="bad", cart_products=[item("p9", 1, "5")]),
    event(_id="8", collection="checkout_success", order_id="103", user_id_db="", ip="9.9.9.9", store_id="77",
          current_url="https://other.example/", cart_products=[item("p3", 1, "10"), item(None, 1, "12٫50")]),
    event(_id="9", collection="checkout_success", order_id="104", user_id_db="u2", store_id="68", local_time="2020-01-09 00:00:00",
          current_url="http://shop.local/stus/a", cart_products=[item("p1", 3, "20")]),
    event(_id="10", local_time="2020-01-05 00:00:00", time_stamp=1578182400, email_address="b@x.de"),
]


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for name in ("events", "products"):
        (folder / name).mkdir()
    (folder / "events" / "part_1.jsonl").write_text("".join(json.dumps(e, ensure_ascii=False) + "\n" for e in LOG))
    (folder / "products" / "p.jsonl").write_text(
        json.dumps({"product_id": "p1", "name": "Ring", "sku": "R", "price": 10, "category": "5", "category_name": "Rings", "gender": "false"}) + "\n"
    )
    (folder / "rates.csv").write_text("date_key,from_currency_code,to_currency_code,exchange_rate\n20200101,EUR,USD,0.5\n20200101,USD,USD,1\n20200104,EUR,USD,0.8\n20200131,EUR,USD,1\n")
    (folder / "countries.csv").write_text(
        "country_code_iso2,country_name,currency_code,currency_name,phone_code,country_group\nDE,Germany,EUR,Euro,49,Europe\nUS,United States,USD,Dollar,1,America\n"
    )
    (folder / "currencies.csv").write_text("currency_code,currency_name,raw_symbol\nEUR,Euro,€\nUSD,Dollar,$\n")
    events = normalize.normalize_events(sources.read_raw_events(spark, str(folder / "events")))
    ranges = spark.createDataFrame([(0x01000000, 0x010000FF, "DE", "Germany", "Hesse", "Frankfurt")], schemas.IP_RANGES)
    return pipeline.Sources(
        events=events,
        visits=events,
        products=sources.read_products(spark, str(folder / "products")),
        ip_locations=lists.ip_location_table(events, ranges),
        countries=sources.read_seed(spark, str(folder / "countries.csv"), schemas.COUNTRIES),
        currencies=sources.read_seed(spark, str(folder / "currencies.csv"), schemas.CURRENCIES),
        rates=sources.read_seed(spark, str(folder / "rates.csv"), schemas.RATES),
        calendar=staging.stg_generate_date(spark, "2020-12-31"),
        url_rules=StoreUrlRules(),
    )


@pytest.fixture(scope="module")
def built(src):
    return pipeline.build_mart(src)


def test_staged_lines(built):
    lines = built["stg_sales_order_detail"].collect()
    assert sorted((r.order_id or "", r.product_id or "", r.product_qty) for r in lines) == [
        ("", "p9", 1), ("100", "p1", 1), ("100", "p1", 1), ("100", "p1", 2), ("100", "p2", 1),
        ("103", "", 1), ("103", "p3", 1), ("104", "p1", 3),
    ], "copies fold, empty carts vanish"
    assert {r.currency for r in lines} == {"€"}


def test_fact_rows(built):
    fact = built["fact_sales_order_detail"]
    got = {(r.order_id, float(r.local_unit_price)): r for r in fact.collect()}
    assert sorted(got) == [("100", 0.0), ("100", 99.0), ("100", 1234.5), ("103", 0.0), ("103", 10.0), ("104", 20.0)]
    assert got["100", 1234.5].product_qty == 3, "same product and price summed (A1)"
    assert float(got["100", 1234.5].usd_amount) == 3 * 1234.5 / 0.5
    assert quality.duplicates(fact, "sales_key").count() == 0, "two prices, two keys (D2)"
    assert quality.not_null(fact, *facts.FACT_COLUMNS[:12]).count() == 0
    guest = got["103", 10.0]
    assert (guest.scd_customer_key, guest.customer_key, guest.store_key, guest.location_key, guest.currency_key) == (-1,) * 5
    assert guest.usd_amount is None, "no rate without a store currency (D16, D19)"
    assert float(got["104", 20.0].usd_amount) == 60.0, "store 68 sells in dollars"


def test_mart_rows(built):
    mart = built["mart_sales_report"]
    assert len(mart.columns) == 27 and mart.count() == built["fact_sales_order_detail"].count()
    row = mart.where("order_id = '100' and quantity_sold = 3").first()
    assert (row.customer_email, row.customer_city, row.store_country) == ("a@x.de", "Frankfurt", "Germany")
    assert (row.product_name, row.product_category, row.product_gender) == ("Ring", "Rings", "Uncategorized")
    assert (row.month_name, row.is_weekend, row.currency_code) == ("January", False, "EUR")
    guest = mart.where("order_id = '103' and product_id = 'p3'").first()
    assert (guest.customer_id, guest.store_id, guest.product_name) == ("-1", "-1", "Unknown")


def test_products_of_rejected_lines_are_still_products(built):
    assert built["dim_product"].where("product_id = 'p9'").count() == 1


def test_rejects_are_reported_with_reason_d4(src):
    got = {r.reason: r.order_id for r in staging.rejected_lines(src.events).collect()}
    assert got == {"order_id": "bad", "price": "103"}


def test_row_number_column_is_optional(src):
    numbered = staging.stg_sales_order_detail(src.events, with_row_number=True)
    assert sorted(r.row_num for r in numbered.collect()) == list(range(1, 9))
    assert numbered.orderBy(F.desc("row_num")).first().order_id == "104"


def test_fact_upsert_touches_the_last_week_only(spark, src, built):
    fact = built["fact_sales_order_detail"]
    rows = fact.select(*facts.FACT_COLUMNS).withColumn("usd_amount", F.lit(7).cast("decimal(38,9)"))
    merged = {r.sales_key: r for r in facts.fact_sales_order_detail(rows, target=fact).collect()}
    assert len(merged) == fact.count()
    by_order = {r.order_id: float(r.usd_amount) for r in merged.values() if r.product_qty == 3}
    assert by_order["104"] == 7 and by_order["100"] == 7
    early = rows.where("order_id = '100'").withColumn("local_order_date", F.lit("2020-01-01").cast("date"))
    assert facts.late_sales(early, fact).count() == 0


def test_partitioned_fact_upsert_rewrites_touched_days_only(spark, built, tmp_path):
    path = str(tmp_path / "fact")
    fact = built["fact_sales_order_detail"]
    old_day = F.when(F.col("order_id") == "103", F.lit("2019-12-01").cast("date")).otherwise(F.col("local_order_date"))
    facts.write_sales(fact.withColumn("local_order_date", old_day), path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("*.parquet")}
    rows = fact.select(*facts.FACT_COLUMNS).where("order_id = '104'")
    new = rows.withColumns({"sales_key": F.lit(5).cast("bigint"), "order_id": F.lit("105")})
    facts.upsert_sales(rows.withColumn("usd_amount", F.lit(9).cast("decimal(38,9)")).unionByName(new), path)
    stored = spark.read.parquet(path)
    assert stored.count() == fact.count() + 1
    assert {float(r.usd_amount) for r in stored.where("local_order_date = '2020-01-09'").collect()} == {9.0, 60.0}
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("*.parquet")}
    kept = {f for f in before if "2020-01-09" not in str(f)}
    assert kept and all(after.get(f) == before[f] for f in kept)


def test_customer_upsert_closes_versions(spark, src, built):
    target = built["dim_customer_scd"]
    more = spark.createDataFrame(
        [("u1", "c@x.de", "2020-02-01 00:00:00", 1580515200)], "user_id_db string, email_address string, local_time string, time_stamp bigint"
    )
    visits = src.visits.select(*more.columns).unionByName(more)
    scd = dims.dim_customer_scd(staging.stg_user_email_by_local_datetime(visits), target=target)
    mine = scd.where("user_id_db = 'u1'").orderBy("start_local_datetime").collect()
    assert [r.email_address for r in mine] == ["Unknown", "a@x.de", "b@x.de", "c@x.de"]
    assert [r.is_current for r in mine] == [False, False, False, True]
    assert mine[2].end_local_datetime == mine[3].start_local_datetime
    current = dims.dim_customer_current(
        staging.stg_user_email_by_local_datetime(visits), target=built["dim_customer_current"]
    )
    assert current.where("user_id_db = 'u1'").first().email_address == "c@x.de"


def test_product_list_takes_the_earliest_page(spark, rows):
    events = spark.createDataFrame(
        [
            ("3", 30, "view_product_detail", "p", None, "late", "r"), ("1", 10, "add_to_cart_action", None, "p", "early", "r"),
            ("2", 5, "checkout_success", "p", None, "other type", "r"), ("4", 1, "view_product_detail", None, None, "no id", "r"),
            ("5", 9, "product_view_all_recommend_clicked", "q", "p", "cur", "ref"),
        ],
        "_id string, time_stamp bigint, collection string, product_id string, viewing_product_id string, current_url string, referrer_url string",
    )
    got = rows(lists.product_id_list(events, "https://shop.example/id/"))
    assert got == [("p", "early", "https://shop.example/id/p"), ("q", "ref", "https://shop.example/id/q")]


def test_rate_list_is_sorted_and_limited_to_listed_codes(spark):
    body = '{"rates": [{"date": "2019-01-02", "rate": 2}, {"date": "2019-01-01", "rate": 1}]}'
    payloads = spark.createDataFrame([("EUR", body), ("CHF", body), ("X", body)], "currency_code string, payload string")
    codes = spark.createDataFrame([("EUR",), ("CHF ",), (None,)], "currency_code string")
    got = [(r.from_currency_code, r.date_key) for r in lists.exchange_rate_table(payloads, codes).collect()]
    assert got == [("CHF", 20190101), ("CHF", 20190102), ("EUR", 20190101), ("EUR", 20190102)]


def test_landed_events_are_read_from_the_table_only(spark, src, tmp_path):
    path = str(tmp_path / "events")
    landed = pipeline.land_events(src.events, path)
    assert landed.count() == src.events.count()
    lines = staging.stg_sales_order_detail(landed)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan json" not in plan and "from_json" not in plan
    assert sorted(map(str, lines.collect())) == sorted(map(str, staging.stg_sales_order_detail(src.events).collect()))
    folders = {f.parent.parent.name for f in (tmp_path / "events").rglob("*.parquet")}
    assert folders == {"collection=view_product_detail", "collection=checkout_success"}


def test_a_violated_check_stops_the_build(src):
    report = checks.Report()
    built = pipeline.build_mart(src, report=report)
    assert {name for name, *_ in report.rows} == set(checks.CHECKS)
    # The two lines of the guest's order have no rate.
    assert [r for r in report.rows if r[2]] == [("mart_sales_report", "not_null:unit_price", 2), ("mart_sales_report", "not_null:sales_amount", 2)]
    with pytest.raises(checks.ViolatedError, match="mart_sales_report.*unit_price"):
        pipeline.build_mart(src, strict=True)
    good = dataclasses.replace(src, events=src.events.where("order_id is null or order_id <> '103'"))
    assert pipeline.build_mart(good, strict=True)["mart_sales_report"].count() == built["mart_sales_report"].count() - 2
    bad = dataclasses.replace(good, currencies=src.currencies.unionByName(src.currencies.limit(1)))
    with pytest.raises(checks.ViolatedError, match="currencies_with_raw_symbol"):
        pipeline.build_mart(bad, strict=True)
    assert pipeline.build_mart(bad)["dim_currency"].count() == 4, "without strict nothing is looked for"


def moved(df):
    """How often the plan shuffles rows."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_copies_and_lines_of_an_order_move_once(src):
    assert moved(facts.summed_lines(staging.stg_sales_order_detail(src.events))) == 1


def test_lookups_of_buyers_and_places_do_not_move_lines_one_by_one(spark, built, src, monkeypatch):
    known = built["dim_customer_scd"].where(F.col("scd_customer_key") != -1)
    seen = []
    monkeypatch.setattr(facts, "version_at", lambda heads, *rest: seen.append(heads.columns) or version_at(heads, *rest))
    args = (
        built["dim_store"], src.countries, facts.daily_rates(built["fact_snapshot_exchange_rate"], built["dim_currency"]),
        built["stg_ip_location_mapping"], known, built["dim_customer_current"], built["dim_currency"],
    )
    rows = facts.sales_rows(built["order_lines"], *args)
    want = built["fact_sales_order_detail"].select(*facts.FACT_COLUMNS)
    assert seen == [["user_id_db", "local_datetime", "ip_address"]]
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, want.collect()))


def test_large_dimensions_are_joined_before_small_ones_widen_the_rows(spark, built, monkeypatch):
    order = []
    monkeypatch.setattr(mart, "fits_memory", lambda side: not {"product_key", "scd_customer_key"} & set(side.columns))
    monkeypatch.setattr(mart, "spread_left_join", lambda left, side, on, *a, **k: order.append((on, "country_name" in left.columns)) or left.join(side, on, "left"))
    flat = mart.mart_sales_report(
        built["fact_sales_order_detail"], built["dim_date"], built["dim_product"], built["dim_store"], built["dim_location"], built["dim_customer_scd"], built["dim_currency"]
    )
    assert order == [(["scd_customer_key"], False), (["product_key"], False)]
    assert sorted(map(repr, flat.collect())) == sorted(map(repr, built["mart_sales_report"].collect()))


def test_kept_lines_are_looked_up_where_they_are(spark, src):
    """The lines meet what was found for their heads without a shuffle of their own."""
    lines = facts.kept_lines(staging.stg_sales_order_detail(src.events))
    assert sorted(map(repr, lines.drop("_head").collect())) == sorted(
        map(repr, facts.folded_lines(staging.stg_sales_order_detail(src.events)).select(*facts.LINE_COLUMNS, "product_qty").collect())
    )
    heads = spark.createDataFrame([], lines.select("_head").schema).withColumn("n", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert moved(lines.select("_head").distinct()) == 0
        assert moved(lines.join(heads.repartition(3), "_head", "left")) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_later_run_stages_the_open_week_only_and_keeps_all_products(src):
    moved_on = F.when(F.col("order_id") == "104", "2020-01-19 00:00:00").otherwise(F.col("local_time"))
    src = dataclasses.replace(src, events=src.events.withColumn("local_time", moved_on))
    first = pipeline.build_mart(src)
    known = {**first, "dim_product": first["dim_product"].where("product_id <> 'p3'")}
    again = pipeline.build_core(src, known)
    assert [str(r[0]) for r in again["order_lines"].select("local_order_date").distinct().collect()] == ["2020-01-19"]
    sold = {r[0] for r in again["dim_product"].select("product_id").collect()}
    assert sold == {"-1", "p1", "p2", "p3", "p9"}, "products of closed days count too"
    keys = lambda t: sorted(r[0] for r in t["fact_sales_order_detail"].select("sales_key").collect())
    assert keys(again) == keys(first)


def test_what_a_run_reads_twice_is_written_first(spark, built, src, tmp_path, monkeypatch):
    """Ranging and merging read their rows twice: the resolved sales and the rows to merge are written once before."""
    written = []
    monkeypatch.setattr(pipeline, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    tables = {name: built[name] for name in (*pipeline.DATE_FOLDERS, *pipeline.SORTED_BY)}
    pipeline.write_core(tables, str(tmp_path / "core"))
    assert written == ["fact_sales_order_detail"]
    core = pipeline.read_core(spark, str(tmp_path / "core"))
    for name, df in tables.items():
        assert sorted(map(repr, core[name].select(df.columns).collect())) == sorted(map(repr, df.collect()))
    merged = {
        "changed_stores": dims.dim_store(staging.stg_store_url_info(src.visits, src.url_rules), src.countries, src.url_rules.local_host, core["dim_store"]),
        "changed_products": dims.dim_product(staging.stg_product(src.products), staging.sold_products(src.events), core["dim_product"]),
        "changed_customers": dims.dim_customer_current(built["stg_user_email"], core["dim_customer_current"]),
        "changed_rates": facts.fact_snapshot_exchange_rate(core["dim_date"], core["dim_currency"], src.rates, core["fact_snapshot_exchange_rate"]),
    }
    for label, df in merged.items():
        assert any(f"/{label}-" in f for f in df.inputFiles()), label


def test_the_first_load_leaves_only_what_is_kept(spark, src, monkeypatch):
    from facetmill.catalog import warehouse as queries

    seen, flat = {}, {"mart_sales_report": spark.range(1)}
    in_run = lambda: spark.conf.get(RUN_FOLDER, None)
    monkeypatch.setattr(queries.td, "sources", lambda *a: src)
    monkeypatch.setattr(queries.pipeline, "build_core", lambda s: seen.update(visits=s.visits.inputFiles()))
    monkeypatch.setattr(queries.pipeline, "write_core", lambda tables, folder: seen.update(first=in_run(), kept=folder))
    monkeypatch.setattr(queries.pipeline, "read_core", lambda *a: {})
    monkeypatch.setattr(queries.pipeline, "build_mart", lambda s, known: seen.update(second=in_run()) or flat)
    assert queries.mart_incremental(spark, "-").count() == 1
    assert seen["first"] and not seen["kept"].startswith(seen["first"]) and seen["second"] is None
    assert seen["visits"] and all("/visits-" in f for f in seen["visits"])
