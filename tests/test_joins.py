import ipaddress
import random

from pyspark.sql import functions as F

from facetmill import schemas
from facetmill.operators import distincts, joins, rates
from facetmill.session import materialize


def test_resume_targets(spark, rows):
    def ids(*xs):
        return spark.createDataFrame([(x,) for x in xs], "id int")

    got = joins.resume_targets(ids(1, 2, 3, 4, 5), ids(1, 2), ids(2, 3, 9), "id")
    assert rows(got) == [(3,), (4,), (5,), (9,)]


def ranges(spark, data):
    return spark.createDataFrame(
        [(a, b, f"C{a}", f"N{a}", f"R{a}", city) for a, b, city in data], schemas.IP_RANGES
    )


def test_address_lookup_edges(spark):
    table = ranges(spark, [(0x01000000, 0x0100FFFF, "x"), (0x01010000, 0x7FFFFFFF, "wide"), (0xC0A80000, 0xC0A80001, "")])
    ips = ["1.0.0.0", "1.0.255.255", "1.1.0.0", "100.2.3.4", "128.0.0.0", "0.255.255.255", "192.168.0.1",
           "192.168.0.2", "1.2.3", "256.1.1.1", "::1", "01.0.0.0", "text"]
    df = spark.createDataFrame([(i,) for i in ips], "ip_address string")
    got = {r.ip_address: r for r in joins.locate_addresses(df, table).collect()}
    assert {i: got[i].country_name for i in ips} == {
        "1.0.0.0": "N16777216", "1.0.255.255": "N16777216", "1.1.0.0": "N16842752", "100.2.3.4": "N16842752",
        "128.0.0.0": "Unknown", "0.255.255.255": "Unknown", "192.168.0.1": "N3232235520", "192.168.0.2": "Unknown",
        "1.2.3": "Unknown", "256.1.1.1": "Unknown", "::1": "Unknown", "01.0.0.0": "Unknown", "text": "Unknown",
    }
    assert got["192.168.0.1"].city == "Unknown", "an empty field is unknown"
    rate = joins.location_hit_rate(joins.locate_addresses(df, table)).first()
    assert (rate.total, rate.found, rate.missed) == (13, 5, 8)
    empty = joins.location_hit_rate(joins.locate_addresses(df.limit(0), table)).first()
    assert empty.total == 0 and empty.found_pct is None


def test_address_lookup_matches_brute_force_with_a_crowded_block(spark):
    rnd = random.Random(1)
    bounds = sorted(rnd.sample(range(0x0A000000, 0x0A010000), 400) + rnd.sample(range(0, 2**32), 60))
    data = [(a, b - rnd.choice([1, 1, 5]), f"c{i}") for i, (a, b) in enumerate(zip(bounds[::2], bounds[1::2])) if b - a > 6]
    numbers = [rnd.randrange(0x0A000000, 0x0A010000) for _ in range(600)] + [rnd.randrange(2**32) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in set(numbers)], "n bigint").withColumn("ip_address", joins.ipv4_text("n"))
    got = {r.n: r.city for r in joins.locate_addresses(df, ranges(spark, data)).collect()}
    assert got == {n: next((c for a, b, c in data if a <= n <= b), "Unknown") for n in set(numbers)}


def test_lookup_join_gives_the_same_rows_by_broadcast_and_by_spreading(spark, rows):
    rnd = random.Random(2)
    left = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else rnd.choice([None, "a", "b", "zz"])) for i in range(900)], "id int, k string"
    )
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("b", 3), ("unused", 4)], "k string, v int")
    plain = rows(left.join(right, "k", "left").select("id", "k", "v"))
    small = joins.lookup_join(left, right, ["k"], ["id"])
    spread = joins.lookup_join(left, right, ["k"], ["id"], max_bytes=0, hot_rows=100)
    assert rows(small.select("id", "k", "v")) == plain == rows(spread.select("id", "k", "v"))
    counted = joins.spread_left_join(left, right, ["k"], ["id"], 100, counted=left.select("k"))
    assert rows(counted.select("id", "k", "v")) == plain


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_are_chosen_by_bytes(spark, rows):
    limit = joins.broadcast_limit(spark)
    assert limit == 4 * 2**30 // 16, "the tests' driver has 4 GB, and no executor has less"
    assert [joins._megabytes(m) for m in ("512", "512m", "1g", "2GB", "1024k", "1t")] == [512, 512, 1024, 2048, 1, 2**20]
    # A million rates of 150 currencies are 88 MB: more than 200,000 rows, and still no reason to move the sales.
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.floor(F.col("id") / 150).cast("int"))
    daily = materialize(spark.range(1_000_000).select(
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("date_key"), F.concat(F.lit("C"), F.col("id") % 150).alias("from_currency_code"),
        F.lit(2).cast("decimal(38,9)").alias("exchange_rate"),
    ), "daily")
    lines = spark.createDataFrame(
        [("o", "1", "C7", 20000102, 3, 5.0), ("o", "68", "C7", 20000102, 1, None), ("p", "2", None, 20000102, 1, 1.0)],
        "order_id string, store_id string, country_currency string, order_date_key bigint, product_qty bigint, unit_price double",
    ).withColumn("unit_price", F.col("unit_price").cast("decimal(18,6)"))
    converted = rates.convert_lines(lines, daily, ["order_id"])
    assert "BroadcastHashJoin" in _plan(converted) and "SortMergeJoin" not in _plan(converted)
    assert sorted((r.order_id, r.currency_code, r.usd_amount and float(r.usd_amount)) for r in converted.collect()) == [("o", "C7", 7.5), ("o", "USD", None), ("p", None, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the planner's own choice aside
    spread = joins.lookup_join(daily.select("date_key"), daily.groupBy("date_key").agg(F.count("*").alias("n")), ["date_key"], ["date_key"], max_bytes=1000, counted=daily)
    assert "SortMergeJoin" in _plan(spread) or "ShuffledHashJoin" in _plan(spread)
    assert "_part" not in spread.columns and spread.count() == 1_000_000
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_texts_count_for_what_they_hold(spark):
    df = spark.createDataFrame([(1, "x" * 1000, [1, 2]), (2, None, None)], "k int, s string, a array<int>")
    assert joins.fits_memory(df, 2000) and not joins.fits_memory(df, 1000)
    assert joins.fits_memory(df.select("k"), 112) and not joins.fits_memory(df.select("k"), 111) and joins.fits_memory(df.limit(0), 0)


def test_hot_key_is_split_over_salts(spark):
    left = spark.createDataFrame([(i, "hot" if i < 500 else str(i)) for i in range(1000)], "id int, k string")
    assert [r.k for r in joins.hot_keys(left, ["k"], 100).collect()] == ["hot"]
    salt = F.pmod(F.xxhash64("id"), F.lit(8))
    assert left.where("k = 'hot'").groupBy(salt).count().count() == 8


def test_representatives_and_samples(spark, rows):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 5, None), ("b", 6, "x")], "k string, t int, v string")
    assert rows(distincts.earliest_value(df, "k", "v", ["t"], "v")) == [("a", "first"), ("b", None)]
    many = spark.range(1000).withColumnRenamed("id", "k")
    one, two = (distincts.sample_rows(many, 50, ["k"], seed=s) for s in (1, 1))
    assert rows(one) == rows(two) and one.distinct().count() == 50
    assert rows(one) != rows(distincts.sample_rows(many, 50, ["k"], seed=2))


def test_blank_keys_are_no_addresses(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("",), (None,)], "ip string")
    assert rows(distincts.distinct_non_blank(df, "ip")) == [("a",)]


def test_sample_of_a_large_table_equals_the_full_ranking(spark, rows):
    many = spark.range(50_000).withColumnRenamed("id", "k")
    rank = F.md5(F.concat_ws("|", F.lit("4"), F.col("k").cast("string")))
    assert rows(distincts.sample_rows(many, 40, ["k"], seed=4)) == rows(many.orderBy(rank, "k").limit(40))
    assert distincts.sample_rows(many.limit(30), 40, ["k"]).count() == 30


def test_address_keys_follow_the_addresses(spark):
    rnd = random.Random(8)
    texts = ["::", "::1", "1::", "::ffff:1.2.3.4", "1.2.3.4", "2001:DB8::", "2001:db8:0:0:0:0:0:0", "fe80::1:2:3:4:5:6", "::1.2.3.4", "64:ff9b::255.255.255.255", "0:0:0:0:1::"]
    for _ in range(200):
        a = ipaddress.IPv6Address(rnd.getrandbits(128) >> rnd.choice([0, 0, 64, 96, 112]) & ~(rnd.getrandbits(128) if rnd.random() < 0.3 else 0))
        texts += [str(a), a.exploded, str(ipaddress.IPv4Address(rnd.getrandbits(32)))]
    bad = ["", None, ":", ":::", "1:2", "1::2::3", "g::", "12345::", "1:2:3:4:5:6:7:8:9", "::1%eth0", "1.2.3", "::1.2.3.256", "1:2:3:4:5:6:7:1.2.3.4", "1:2:3:4:5:6:7::8", ":1:2:3:4:5:6:7", "text:"]

    def want(t):
        a = ipaddress.ip_address(t)
        return (a if a.version == 6 else ipaddress.IPv6Address(f"::ffff:{a}")).packed

    got = spark.createDataFrame([(t,) for t in texts + bad], "t string").select("t", joins.address_key("t").alias("k"), joins.key_block(joins.address_key("t")).alias("b")).collect()
    assert {r.t: r.k and bytes(r.k) for r in got} == {t: want(t) for t in texts} | dict.fromkeys(bad)
    ranked = sorted((bytes(r.k), r.b) for r in got if r.k)
    assert [b for _, b in ranked] == sorted(b for _, b in ranked), "blocks are in address order"


def test_ranges_of_both_families(spark):
    place = lambda a, b, c: (a, b, c, c, c, c)
    table = spark.createDataFrame(
        [place("1.0.0.0", "1.255.255.255", "four"), place("2001:db8::", "2001:db8:ffff::", "six"), place("2001:db9::", "2001:dbb::", "wide"), place("::", "::1", "low"), place("x", "y", "bad")],
        "range_from string, range_to string, country_code string, country_name string, region string, city string",
    )
    ips = {"1.2.3.4": "four", "::ffff:1.2.3.4": "four", "2.0.0.0": "Unknown", "2001:DB8:1::5": "six", "2001:dba:1::": "wide", "2001:dbb::1": "Unknown", "::1": "low", "::2": "Unknown", "nope": "Unknown", None: "Unknown"}
    got = joins.locate_any_addresses(spark.createDataFrame([(i,) for i in ips], "ip_address string"), table)
    assert {r.ip_address: r.city for r in got.collect()} == ips and "_key" not in got.columns
