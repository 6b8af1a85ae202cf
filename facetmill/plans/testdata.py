"""The test tables in the shape of the retail inputs.

orders + lineitem + customer -> checkouts and page visits, nation + region ->
stores, countries and currencies, supplier -> address ranges, part ->
products, orders -> exchange rates. Whole tables, no sampling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import date_key
from ..functions.urls import StoreUrlRules
from ..operators.joins import ipv4_text, locate_addresses
from ..session import materialize
from .pipeline import Sources
from .staging import CHECKOUT, stg_generate_date

URL_RULES = StoreUrlRules(shop_hosts=("%www.shop.%", "%www.ring%"), local_host="shop.local", local_prefix="st")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def country_code(nation: Column) -> Column:
    """Two letters per nation."""
    return F.concat(
        F.char(F.lit(65) + F.floor(nation / 5)), F.char(F.lit(65) + F.pmod(nation, F.lit(5)))
    )


def currency_code(nation: Column) -> Column:
    return (
        F.when(nation == 0, "USD")
        .when(nation == 1, "EUR")
        .when(nation == 3, "LTL")
        .otherwise(F.concat(F.lit("C"), F.lpad(nation.cast("string"), 2, "0")))
    )


def orders_of_nations(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the buyer's nation."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    return orders.join(customers, orders.o_custkey == customers.c_custkey).drop("c_custkey")


def orders_with_buyers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the buyer's nation, e-mail, address and local time of day."""
    return with_buyers(orders_of_nations(spark, folder))


def with_buyers(orders: DataFrame, *more: str) -> DataFrame:
    """The texts of :func:`orders_with_buyers` for rows with the columns of :func:`orders_of_nations`."""
    key, buyer = F.col("o_orderkey"), F.col("o_custkey")
    local = F.timestamp_add(
        "SECOND", F.pmod(key, F.lit(86400)).cast("int"), F.col("o_orderdate").cast("timestamp_ntz")
    )
    email = F.when(F.col("o_orderstatus") == "P", "").otherwise(
        F.concat(
            F.lit("c"), buyer.cast("string"), F.lit("."),
            F.substring("o_orderpriority", 1, 1), F.lit("@mail.example"),
        )
    )
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return orders.select(
        *more,
        "o_orderkey",
        "o_orderpriority",
        F.col("c_nationkey").alias("nation"),
        buyer.cast("string").alias("user_id_db"),
        email.alias("email_address"),
        local.cast("string").alias("local_time"),
        (days * 86400 + F.pmod(key, F.lit(86400)) - 3600).alias("time_stamp"),
        (F.col("c_nationkey") + 60).cast("string").alias("store_id"),
        ipv4_text(buyer * 67).alias("ip"),
    )


def page_url() -> Column:
    """Public shop pages, in-house pages (every fifth nation), one odd host, and noise."""
    code = F.lower(country_code(F.col("nation")))
    return (
        F.when(
            F.col("o_orderpriority") == "1-URGENT",
            F.concat(F.lit("https://www.google.example/?q=www.shop."), code),
        )
        .when(F.pmod("nation", F.lit(5)) == 0, F.concat(F.lit("http://shop.local/st"), code, F.lit("/x")))
        .when(F.col("nation") == 7, F.lit("https://www.shop.co.uk/p"))
        .otherwise(F.concat(F.lit("https://www.shop."), code, F.lit("./p/"), F.col("o_orderkey").cast("string")))
    )


def page_views(orders: DataFrame) -> DataFrame:
    """One page view per order of :func:`orders_with_buyers`."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("_id"),
        "time_stamp", "ip", "user_id_db", "store_id", "local_time", "email_address",
        F.lit("view_product_detail").alias("collection"),
        page_url().alias("current_url"),
    )


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """The page views, landed as a table like a raw event log."""
    return materialize(page_views(orders_with_buyers(spark, folder)), "visits")


def price_as_written(value: Column, key: Column) -> Column:
    """One amount in four spellings."""
    american = F.format_number(value, 2)
    style = F.pmod(key, F.lit(4))
    return (
        F.when(style == 0, F.translate(american, ",.", ".,"))
        .when(style == 1, american)
        .when(style == 2, F.translate(american, ",", "'"))
        .otherwise(F.translate(american, ",", ""))
    )


def lines_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return written_lines(table(spark, folder, "lineitem"))


def written_lines(lines: DataFrame, *more: str) -> DataFrame:
    return lines.select(
        *more,
        "l_orderkey",
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("amount"),
        "l_extendedprice",
        price_as_written(F.col("l_extendedprice"), F.col("l_orderkey")).alias("price"),
    )


def checkouts(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    """One checkout event per order line, its quantity split over two cart items.

    Every tenth order was delivered twice. Carts are built per row: no order is
    collected into an array, however many lines it has. ``orders``: :func:`orders_of_nations`, if they are written already.
    """
    # amounts and texts are made of the few columns that move
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    orders = (orders_of_nations(spark, folder) if orders is None else orders).drop("o_totalprice")
    sold = with_buyers(lines.join(orders, lines.l_orderkey == orders.o_orderkey), *lines.columns)
    first = F.ceil(F.col("amount") / 2).cast("bigint")

    def item(quantity: Column) -> Column:
        return F.struct(
            "product_id", quantity.alias("amount"), "price",
            currency_code(F.col("nation")).alias("currency"),
        )

    copies = F.sequence(F.lit(1), F.when(F.pmod("l_orderkey", F.lit(10)) == 0, 2).otherwise(1))
    order_id = F.concat(
        F.col("l_orderkey").cast("string"),
        F.when(F.pmod("l_orderkey", F.lit(2)) == 0, ".0").otherwise(""),
    )
    return (
        written_lines(sold, *[c for c in sold.columns if c not in lines.columns])
        .withColumn("_copy", F.explode(copies))
        .select(
            F.lit(CHECKOUT).alias("collection"),
            order_id.alias("order_id"),
            "local_time", "time_stamp", "store_id", "ip", "user_id_db", "email_address",
            F.array(item(first), item(F.col("amount") - first)).alias("cart_products"),
        )
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Page views and checkouts as one log."""
    sold = checkouts(spark, folder).withColumn("_id", F.concat(F.lit("c"), "order_id", F.lit("-"), F.col("cart_products")[0]["product_id"]))
    return visits(spark, folder).unionByName(sold, allowMissingColumns=True)


def countries(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    nation = F.col("n_nationkey")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        country_code(nation).alias("country_code_iso2"),
        F.col("n_name").alias("country_name"),
        currency_code(nation).alias("currency_code"),
        F.concat("n_name", F.lit(" money")).alias("currency_name"),
        nation.cast("string").alias("phone_code"),
        F.col("r_name").alias("country_group"),
    )


def currencies(spark: SparkSession, folder: str) -> DataFrame:
    return countries(spark, folder).select(
        "currency_code", "currency_name", F.lit(None).cast("string").alias("raw_symbol")
    )


def rates(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    """The greatest order total of a nation and day stands for its rate; sparse on purpose."""
    return (
        (orders_of_nations(spark, folder) if orders is None else orders)
        .groupBy("c_nationkey", F.to_date("o_orderdate").alias("day"))
        .agg(F.max("o_totalprice").alias("rate"))
        .select(
            date_key("day").alias("date_key"),
            currency_code(F.col("c_nationkey")).alias("from_currency_code"),
            F.lit("USD").alias("to_currency_code"),
            F.col("rate").cast("decimal(18,2)").cast("decimal(38,9)").alias("exchange_rate"),
        )
    )


def calendar_bounds(spark: SparkSession, folder: str) -> tuple[str, str]:
    """First and last order day (one row, from one aggregate)."""
    day = F.to_date("o_orderdate")
    row = table(spark, folder, "orders").agg(F.min(day).alias("a"), F.max(day).alias("z")).first()
    return str(row["a"]), str(row["z"])


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    text = key.cast("string")
    price = F.col("p_retailprice").cast("decimal(38,9)")
    return table(spark, folder, "part").select(
        F.concat(F.lit(" "), text).alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("SKU-"), text).alias("sku"),
        F.col("p_size").cast("string").alias("attribute_set_id"),
        F.col("p_type").alias("attribute_set"),
        F.lit("simple").alias("type_id"),
        price.alias("price"),
        price.alias("min_price"),
        F.when(F.col("p_size") > 40, None).otherwise(price).alias("max_price"),
        F.when(F.col("p_size") < 10, "0").otherwise(F.col("p_size").cast("string")).alias("collection_id"),
        F.col("p_brand").alias("collection"),
        F.lit("").alias("product_type_value"),
        F.col("p_type").alias("product_type"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_type"), F.lit(" ")).alias("category_name"),
        F.when(F.col("p_size") % 3 == 0, "false").when(F.col("p_size") % 3 == 1, "women").alias("gender"),
    )


def address_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Each supplier owns 900 addresses, followed by a gap of 100."""
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    start = F.col("s_suppkey") * 1000
    return (
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select(
            start.alias("ip_from"),
            (start + 899).alias("ip_to"),
            country_code(F.col("n_nationkey")).alias("country_code"),
            F.col("n_name").alias("country_name"),
            F.col("r_name").alias("region"),
            F.col("s_name").alias("city"),
        )
    )


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    """One address per customer; some are no IPv4 address."""
    key = F.col("c_custkey")
    ip = (
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("2001:db8::"), key.cast("string")))
        .otherwise(ipv4_text(key * 67))
    )
    return table(spark, folder, "customer").select(ip.alias("ip_address"))


def ipv6_text(number: Column, style: Column) -> Column:
    """An address below 2001:db8::, in three spellings."""
    high, low = F.shiftright(number, 16), number.bitwiseAND(F.lit(0xFFFF))
    return (
        F.when(style == 0, F.concat(F.lit("2001:db8::"), F.lower(F.hex(high)), F.lit(":"), F.lower(F.hex(low))))
        .when(style == 1, F.concat(F.lit("2001:0DB8:0000:0000:0000:0000:"), F.lpad(F.hex(high), 4, "0"), F.lit(":"), F.lpad(F.hex(low), 4, "0")))
        .otherwise(F.concat(F.lit("2001:db8:0:0::"), ipv4_text(number)))
    )


def any_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """One address per customer, of either family; some are none."""
    key = F.col("c_custkey")
    ip = (
        F.when(F.col("c_mktsegment") == "MACHINERY", ipv6_text(key * 67, key % 3))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("2001:db8::1::"), key.cast("string")))
        .otherwise(ipv4_text(key * 67))
    )
    return table(spark, folder, "customer").select("c_custkey", ip.alias("ip_address"))


def any_address_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The suppliers' ranges as text: even suppliers own IPv6, odd ones IPv4."""
    low, high = F.col("ip_from"), F.col("ip_to")
    six = F.floor(low / 1000) % 2 == 0
    return address_ranges(spark, folder).select(
        *[F.when(six, ipv6_text(n, F.lit(0))).otherwise(ipv4_text(n)).alias(name) for n, name in ((low, "range_from"), (high, "range_to"))],
        "country_code", "country_name", "region", "city",
    )


def ip_locations(spark: SparkSession, folder: str) -> DataFrame:
    plain = table(spark, folder, "customer").select(ipv4_text(F.col("c_custkey") * 67).alias("ip_address"))
    return locate_addresses(plain, address_ranges(spark, folder))


def browsing(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream as user histories: the event type is the state, unknown for some types."""
    hidden = F.col("event_type").isin("signup", "error")
    return table(spark, folder, "events").select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("user_id_db"),
        F.when(~hidden, F.col("event_type")).alias("email_address"),
        F.col("ts").cast("timestamp_ntz").alias("local_datetime"),
        F.col("ts").cast("timestamp").alias("utc_timestamp"),
        "event_type", "value", "props",
    )


def references(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> dict:
    """The inputs besides the event log. ``orders``: :func:`orders_of_nations`, if they are written already."""
    first, last = calendar_bounds(spark, folder)
    return {
        "products": products(spark, folder),
        "ip_locations": ip_locations(spark, folder),
        "countries": countries(spark, folder),
        "currencies": currencies(spark, folder),
        "rates": rates(spark, folder, orders),
        "calendar": stg_generate_date(spark, last, first),
        "url_rules": URL_RULES,
    }


def sources(spark: SparkSession, folder: str) -> Sources:
    # the orders are written once, for their page views, checkouts and rates
    orders = materialize(orders_of_nations(spark, folder), "orders")
    return Sources(
        events=checkouts(spark, folder, orders), visits=page_views(with_buyers(orders)), **references(spark, folder, orders)
    )
