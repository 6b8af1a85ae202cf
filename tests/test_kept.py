"""Tables of folders, landing, and runs that read what is new."""

import dataclasses
import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from facetmill import schemas
from facetmill.functions.urls import StoreUrlRules
from facetmill.operators import upsert
from facetmill.plans import facts, lists, pipeline, staging
from facetmill.plans import warehouse as kept
from facetmill.plans.checks import ViolatedError
from facetmill.session import RUN_FOLDER, SHUFFLE_CLEANUP, materialize, run_folder
from facetmill.sources import files
from facetmill.sources.folders import FolderTable

SCHEMA = "id int, day date, v string"


def days(spark, *rows):
    return spark.createDataFrame([(i, None if d is None else dt.date(2020, 1, d), v) for i, d, v in rows], SCHEMA)


def stored(table, *args, **kwargs):
    return sorted((r.id, r.day and r.day.day, r.v) for r in table.read(*args, **kwargs).collect())


def test_readers_see_what_is_committed(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), ["day"], ["id"])
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(days(spark, (1, 1, "a"), (2, 2, "a"), (3, None, "a"))) == 1
    old = table.read()
    # A run that stops between its write and the switch leaves the old table.
    load = table.write(days(spark, (1, 1, "never")))
    assert stored(table) == [(1, 1, "a"), (2, 2, "a"), (3, None, "a")]
    # Day 1 is replaced, day 2 loses all its rows, the row of no day stays.
    table.replace(days(spark, (1, 1, "b"), (4, 4, "b")), lambda f: f.values["day"] in ("2020-01-01", "2020-01-02"), {"who": "me"})
    assert stored(table) == [(1, 1, "b"), (3, None, "a"), (4, 4, "b")]
    assert stored(table, version=1) == [(1, 1, "a"), (2, 2, "a"), (3, None, "a")] and old.count() == 3
    assert table.note() == {"who": "me"} and table.versions() == [1, 2]
    table.append(days(spark, (5, 1, "c")))
    assert stored(table, lambda f: f.values["day"] == "2020-01-01") == [(1, 1, "b"), (5, 1, "c")]
    assert {f.split("day=")[1][:10] for f in table.read(lambda f: f.values["day"] == "2020-01-01").inputFiles()} == {"2020-01-01"}
    assert load in table.expire(keep=1) and table.versions() == [3]
    assert len(stored(table)) == 4
    table.compact()
    assert len({f.load for f in table.head().folders}) == 1 and len(stored(table)) == 4


def test_of_two_writers_one_wins(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"))
    table.replace(days(spark, (1, 1, "a")))
    table.replace(days(spark, (1, 1, "b")), after=1)
    with pytest.raises(files.TakenError):
        table.replace(days(spark, (1, 1, "c")), after=1)
    with pytest.raises(files.TakenError):
        files.create_whole(spark, str(tmp_path / "t/_commits/000000000002.json"), "{}")
    assert stored(table) == [(1, 1, "b")]
    with pytest.raises(ValueError):
        table.append(days(spark, (1, 1, "b")).drop("v"))
    table.replace(days(spark).limit(0))
    assert stored(table) == [] and table.read().columns == ["id", "day", "v"]


def test_append_goes_behind_what_came_between(spark, tmp_path, monkeypatch):
    table, other = (FolderTable(spark, str(tmp_path / "t"), ["day"]) for _ in range(2))
    table.append(days(spark, (1, 1, "a")))
    real, calls = FolderTable.head, []

    def late(self, number=None):
        head = real(self, number)
        if self is table and not calls:
            calls.append(1)
            other.append(days(spark, (2, 2, "b")))
        return head

    monkeypatch.setattr(FolderTable, "head", late)
    table.append(days(spark, (3, 3, "c")))
    assert stored(other) == [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]


def test_odd_partition_values(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), ["kind"])
    kinds = ["a/b", "c=d", "e f", "ü%", "x:y", None]
    table.append(spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "id int, kind string"))
    assert {r.id: r.kind for r in table.read().collect()} == dict(enumerate(kinds))
    assert [r.id for r in table.read(lambda f: f.values["kind"] == "a/b").collect()] == [0]


def test_a_run_removes_what_it_materialized(spark):
    with run_folder(spark) as folder, run_folder(spark) as inner:
        assert inner == folder
        (path,) = {f.rsplit("/", 1)[0] for f in materialize(spark.range(3).coalesce(1), "x").inputFiles()}
        assert folder.split(":")[-1] in path and files.names(spark, folder)
    assert not files.names(spark, folder) and spark.conf.get(RUN_FOLDER, None) is None


# -- the warehouse -------------------------------------------------------------------

CART = "array<struct<product_id string, amount bigint, price string, currency string>>"
LOG = (
    "_id string, time_stamp bigint, ip string, user_id_db string, store_id string, local_time string, email_address string, "
    f"collection string, current_url string, order_id string, cart_products {CART}"
)


def seen(i, user, day, email="", kind="view_product_detail", order=None, cart=None):
    at = dt.datetime(2020, 1, 1) + dt.timedelta(day - 1)
    url = "https://www.shop.de/x"
    return (f"{i}", int(at.timestamp()), "1.0.0.7", user, "1", None if day > 300 else str(at), email, kind, url, order, cart)


def bought(i, user, day, order, *items, email=""):
    return seen(i, user, day, email, staging.CHECKOUT, order, [(p, 1, f"{price}", "€") for p, price in items])


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


@pytest.fixture(scope="module")
def ref(spark):
    ranges = spark.createDataFrame([(0x01000000, 0x010000FF, "DE", "Germany", "Hesse", "Frankfurt")], schemas.IP_RANGES)
    return kept.References(
        products=spark.createDataFrame([(json.dumps({"product_id": "p1", "name": "Ring", "price": 10}),)], "j string")
        .select(F.from_json("j", schemas.PRODUCTS).alias("p")).select("p.*"),
        ip_locations=lists.ip_location_table(log(spark, seen(1, "u", 1)), ranges),
        countries=spark.createDataFrame([("DE", "Germany", "EUR", "Euro", "49", "Europe")], schemas.COUNTRIES),
        currencies=spark.createDataFrame([("EUR", "Euro", "€"), ("USD", "Dollar", "$")], schemas.CURRENCIES),
        rates=spark.createDataFrame([(20200101, "EUR", "USD", 0.5)], "date_key bigint, from_currency_code string, to_currency_code string, exchange_rate double")
        .withColumn("exchange_rate", F.col("exchange_rate").cast("decimal(38,9)")),
        calendar=staging.stg_generate_date(spark, "2020-03-31", "2020-01-01"),
        url_rules=StoreUrlRules(),
    )


FIRST = [seen(i, f"u{i}", 1 + i % 20, f"{i}@x.de") for i in range(30)] + [
    bought(100, "u1", 2, "1", ("p1", 5)), bought(101, "u2", 20, "2", ("p1", 5), ("p2", 6)), bought(102, "u3", 25, "3", ("p1", 7)), bought(103, "u3", 400, "9", ("p1", 7)),
]
SECOND = [
    seen(200, "u1", 26, "new@x.de"), bought(201, "u2", 20, "2", ("p2", 6), ("p3", 1)), bought(202, "u9", 27, "4", ("p1", 8)),
    bought(203, "u4", 3, "5", ("p1", 1)), bought(204, "u4", 401, "6", ("p1", 1)),
]
AS_OF = dt.date(2020, 2, 1)


@pytest.fixture(scope="module")
def house(spark, ref, tmp_path_factory):
    house = kept.Warehouse(spark, str(tmp_path_factory.mktemp("house")), user_buckets=64)
    house.update(ref)
    assert house.events.head() is None
    house.land(log(spark, *FIRST))
    house.update(ref, AS_OF)
    return house


def fact_rows(df):
    return sorted((r.order_id, r.product_key, str(r.local_order_date), float(r.local_unit_price), r.scd_customer_key, r.usd_amount) for r in df.collect())


def test_first_run_equals_a_build_from_nothing(spark, ref, house):
    events = log(spark, *FIRST)
    built = pipeline.build_mart(pipeline.Sources(events=events, visits=events, **{f.name: getattr(ref, f.name) for f in dataclasses.fields(ref)}))
    assert fact_rows(house.read("fact_sales_order_detail")) == fact_rows(built["fact_sales_order_detail"])
    for name in ("dim_customer_scd", "dim_customer_current", "dim_product", "dim_store"):
        key = built[name].columns[0]
        assert sorted(r[key] for r in house.read(name).collect()) == sorted(r[key] for r in built[name].collect())
    assert house.mart().count() == built["mart_sales_report"].count() > 0


def test_second_run_reads_what_is_new(spark, ref, house, monkeypatch):
    before = {name: {f.path for f in t.head().folders} for name, t in house.tables.items()}
    house.land(log(spark, *SECOND))
    opened = {}
    real = FolderTable.read

    def read(self, *args, **kwargs):
        rows = real(self, *args, **kwargs)
        opened.setdefault(self.path.rsplit("/", 1)[1], set()).update(rows.inputFiles())
        return rows

    # The run dies before its last step, and is run again.
    with monkeypatch.context() as m:
        m.setattr(kept.Warehouse, "update_sales", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            house.update(ref, AS_OF)
    fact_before = fact_rows(house.read("fact_sales_order_detail"))
    monkeypatch.setattr(FolderTable, "read", read)
    states = []
    real_runs = staging.user_email_runs
    monkeypatch.setattr(staging, "user_email_runs", lambda s: states.append(s) or real_runs(s))
    house.update(ref, AS_OF)
    assert not states, "customers were done by the first try"
    assert fact_before != fact_rows(house.read("fact_sales_order_detail"))
    # The newest sale until the day of the run is of day 25: folders of the open days, and of the new load, but no other.
    new_load = (set(house.loads()) - {f.load for f in house.events.head(1).folders}).pop()
    for name in opened["events"]:
        day = name.split("landed_from=")[1].split("/")[0]
        assert new_load in name or day >= "2020-01-18", name
    fact = {f.path for f in house.tables["fact_sales_order_detail"].head().folders}
    kept_days = {f for f in before["fact_sales_order_detail"] if f in fact}
    assert {f.split("sold_from=")[1] for f in kept_days} == {"2020-01-02", "__HIVE_DEFAULT_PARTITION__"}
    # Order 2 came again without p1: its day is open, so all its lines are known.
    got = {(r.order_id, float(r.local_unit_price)) for r in house.read("fact_sales_order_detail").collect()}
    assert got == {("1", 5), ("2", 5), ("2", 6), ("2", 1), ("3", 7), ("4", 8), ("9", 7)}
    assert sorted(r.order_id for r in house.late.read().collect()) == ["5", "6"]


def test_histories_of_other_users_are_not_read(spark, ref, house, monkeypatch):
    untouched = {f.path for f in house.tables["dim_customer_scd"].head().folders}
    house.land(log(spark, seen(300, "u5", 28, "five@x.de"), seen(301, "brand new", 28, "n@x.de")))
    read, real = [], staging.user_email_runs
    monkeypatch.setattr(staging, "user_email_runs", lambda s: read.append(s) or real(s))
    house.update_customers()
    (states,) = read
    buckets = {r[0] for r in log(spark, seen(0, "u5", 1), seen(0, "brand new", 1)).select(house._bucket()).collect()}
    assert {int(f.split("user_bucket=")[1].split("/")[0]) for f in states.inputFiles()} == buckets
    assert {r.user_id_db for r in states.collect()} == {"u5", "brand new"}
    after = {f.path for f in house.tables["dim_customer_scd"].head().folders}
    assert {int(f.split("user_bucket=")[1]) for f in untouched ^ after} == buckets
    scd = house.read("dim_customer_scd")
    assert scd.where("user_id_db = 'u5' and is_current").first().email_address == "five@x.de"
    assert scd.where("user_id_db = '-1'").count() == 1 and scd.groupBy("scd_customer_key").count().where("count > 1").count() == 0
    house.update_customers()
    assert len(read) == 1, "nothing new, nothing read"


def test_files_are_landed_once(spark, tmp_path, monkeypatch):
    house = kept.Warehouse(spark, str(tmp_path / "house"))
    landing = tmp_path / "landing"
    landing.mkdir()
    schema = "_id string, collection string, local_time string"

    def put(name, *ids):
        (landing / name).write_text("".join(json.dumps({"_id": i, "collection": "a", "local_time": "2020-01-02 00:00:00"}) + "\n" for i in ids))

    def land(**more):
        return house.land_files(str(landing), lambda paths: spark.read.schema(schema).json(paths), **more)

    assert land() == 0 and house.events.head() is None
    put("1.jsonl", "a", "b")
    put("2.jsonl", "c")
    put("3.csv", "x")
    assert land(most=1) == 1 and land() == 1 and land() == 0
    put("4.jsonl", "d")
    # The run dies between its write and the switch.
    with monkeypatch.context() as m:
        m.setattr(FolderTable, "switch", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land()
    assert sorted(r[0] for r in house.events.read().select("_id").collect()) == ["a", "b", "c"]
    assert land() == 1 and land() == 0
    assert sorted(r[0] for r in house.events.read().select("_id").collect()) == ["a", "b", "c", "d"]
    monkeypatch.setattr(kept, "LEDGERS", 1)
    house.compact_ledger()
    assert len(house.events.note()["ledgers"]) == 1 and house.landed_files().count() == 3 and land() == 0


def test_partial_orders_are_merged_by_line(spark):
    def lines(*rows):
        return spark.createDataFrame(list(rows), "order_id string, product_key int, sales_key int, order_lines int")

    now = F.lit("2000-01-01").cast("timestamp")
    stamps = {"created_at": now, "created_by": F.lit("old"), "updated_at": now, "updated_by": F.lit("old")}
    old = lines(("a", 1, 1, 0), ("a", 2, 2, 0), ("b", 1, 3, 0), ("b", 2, 4, 0), ("c", 1, 5, 0), ("d", 1, 6, 0)).drop("order_lines").withColumns(stamps)
    new = lines(("a", 2, 20, 1), ("b", 2, 40, 3), ("b", 3, 41, 3), ("c", 1, 5, None), ("e", 1, 7, None))
    got = upsert.reconcile_groups(new, old, "order_id", ["sales_key"], ["product_key"], "order_lines")
    assert sorted((r.order_id, r.sales_key, r.created_by == "old") for r in got.collect()) == [
        ("a", 20, False), ("b", 3, True), ("b", 40, False), ("b", 41, False), ("c", 5, True), ("d", 6, True), ("e", 7, False),
    ]
    lost = facts.shrinking_orders(new, old)
    assert sorted(map(tuple, lost.collect())) == [("a", 1), ("b", 1)]


def test_rows_that_violate_a_check_are_not_published(spark, ref, tmp_path):
    house = kept.Warehouse(spark, str(tmp_path / "house"), user_buckets=4, strict=True)
    house.land(log(spark, *FIRST))
    house.update(ref, AS_OF)
    before = house.tables["dim_currency"].versions()
    twice = dataclasses.replace(ref, currencies=ref.currencies.unionByName(ref.currencies))
    with pytest.raises(ViolatedError, match="dim_currency"):
        house.update_money(twice)
    assert house.tables["dim_currency"].versions() == before and house.read("dim_currency").count() == 3
    house.update_money(ref)
    assert len(house.tables["dim_currency"].versions()) == len(before) + 1


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        found = blocks.getAllBlocks().iterator()
        names = set()
        while found.hasNext():
            names.add(found.next().toString())
        return {n for n in names if n.startswith("shuffle_")}

    before = held()
    out = materialize(spark.range(1000).withColumn("k", F.col("id") % 7).repartition(5, "k"), "dealt")
    deadline = time.time() + 20
    while held() - before and time.time() < deadline:
        time.sleep(0.1)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true" and not held() - before
    counts = out.groupBy("k").count()
    assert sorted(counts.collect()) == sorted(counts.collect()), "a second read of one plan shuffles again"
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        materialize(spark.range(3), "other")
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false", "what the session says stays"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def test_a_run_deals_checkouts_once(spark, ref, tmp_path, monkeypatch):
    """Products are taken from carts as they are; only the sales compare copies of checkouts, and write their lines in buckets."""
    house = kept.Warehouse(spark, str(tmp_path / "house"), user_buckets=4)
    house.land(log(spark, *FIRST))
    staged, heads = [], []
    whole = staging.stg_sales_order_detail
    monkeypatch.setattr(staging, "stg_sales_order_detail", lambda events, *a: staged.append(1) or whole(events, *a))
    rows_of = facts.sales_rows
    monkeypatch.setattr(facts, "sales_rows", lambda lines, *a: heads.append("_head" in lines.columns) or rows_of(lines, *a))
    house.update(ref)
    assert len(staged) == 1 and heads == [True]
    names = [f.name for f in (tmp_path / "house").rglob("*.parquet")]
    assert names and all(".zstd." in n for n in names)
