"""Staging tables: typed, cleaned and flattened source rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates, keys, prices, text, urls
from ..functions.money import times
from ..operators.intervals import change_intervals
from ..operators.normalize import with_event_types
from ..operators.scans import global_row_number
from ..sources.readers import date_spine

CHECKOUT = "checkout_success"
CALENDAR_START = "2018-01-01"


def checkout_lines(events: DataFrame) -> DataFrame:
    """Cart items of distinct checkouts; an order with no item vanishes.

    Checkouts move once, by :func:`head_key`. Its parts are functions of the columns that are compared, and lines are
    grouped by them, so neither the copies nor the lines of an order move again. As functions they need not move themselves.
    """
    orders = (
        with_event_types(events, [CHECKOUT])
        .select("order_id", "local_time", "store_id", "ip", "user_id_db", "email_address", "cart_products")
        # the hash of the buckets in which lines are kept, see facts.kept_lines
        .repartition(*head_key().values())
        .withColumns(head_key())
        .distinct()
        .withColumn("_order", prices.leading_digits("order_id"))
    )
    return orders.withColumn("item", F.explode("cart_products")).drop("cart_products")


def head_key() -> dict[str, Column]:
    """What the lines of a checkout share in the lookups: buyer, time and address, as they are staged."""

    def filled(c: str) -> Column:
        # text.blank_to_null in a form that the planner knows again behind the shuffle
        return F.when(F.trim(c) != "", F.trim(c))

    return {"_buyer": filled("user_id_db"), "_at": dates.local_datetime("local_time"), "_address": filled("ip")}


def open_events(events: DataFrame, floor: Column) -> DataFrame:
    """Events of the days from ``floor`` on; all of them where it is NULL."""
    return events.where(floor.isNull() | (F.to_date(dates.local_datetime("local_time")) >= floor))


def sold_products(events: DataFrame) -> DataFrame:
    """Products in carts. Copies of a checkout add none, so it is not asked for them."""
    carts = with_event_types(events, [CHECKOUT]).select(F.explode("cart_products").alias("item"))
    return carts.select(text.blank_to_null("item.product_id").alias("product_id")).distinct()


def stg_sales_order_detail(
    events: DataFrame, strict_decimal_comma: bool = False, with_row_number: bool = False
) -> DataFrame:
    """One row per cart item, typed. ``row_num`` is the order of local time, on request."""
    local = F.col("_at")
    lines = checkout_lines(events).select(
        F.col("_order").alias("order_id"),
        local.alias("local_datetime"),
        F.to_date(local).alias("local_order_date"),
        dates.date_key(local).alias("order_date_key"),
        text.blank_to_null("store_id").alias("store_id"),
        F.col("_address").alias("ip_address"),
        F.col("_buyer").alias("user_id_db"),
        text.blank_to_null("email_address").alias("email_address"),
        text.blank_to_null("item.product_id").alias("product_id"),
        text.blank_to_null("item.currency").alias("currency"),
        F.col("item.amount").alias("product_qty"),
        prices.parse_price("item.price", strict_decimal_comma).alias("unit_price"),
    )
    if with_row_number:
        rest = [c for c in lines.columns if c != "local_datetime"]
        lines = global_row_number(lines, ["local_datetime", *rest])
    return lines


def rejected_lines(events: DataFrame, strict_decimal_comma: bool = False) -> DataFrame:
    """Cart items that cannot be used as they are, with the reason.

    A price or a time that cannot be read, an order id without leading digits, or an
    amount too large to be converted. A line with an unreadable price stays in the
    facts with an amount of zero, one with too large an amount with a NULL amount.
    """
    price = prices.parse_price("item.price", strict_decimal_comma)
    bad_time = text.has_text("local_time") & F.col("_at").isNull()
    reason = (
        F.when(F.col("_order").isNull(), "order_id")
        .when(bad_time, "local_time")
        .when(prices.is_price_reject("item.price", strict_decimal_comma), "price")
        .when(F.col("item.amount").isNotNull() & price.isNotNull() & times("item.amount", price).isNull(), "amount")
    )
    return checkout_lines(events).withColumn("reason", reason).where("reason is not null").drop("_order", *head_key())


def user_states(events: DataFrame) -> DataFrame:
    """Which e-mail a user had when: all that events of every type add to the histories."""
    return events.where(text.has_text("user_id_db")).select(
        F.trim("user_id_db").alias("user_id_db"),
        text.blank_to_null("email_address").alias("email_address"),
        dates.local_datetime("local_time").alias("local_datetime"),
        dates.utc_from_epoch("time_stamp").alias("utc_timestamp"),
    )


def user_email_runs(states: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """Runs of one e-mail state per user (M1). ``states``: see :func:`user_states`; ``hot``: users with very many, if known."""
    runs = change_intervals(states, "user_id_db", "email_address", "local_datetime", "utc_timestamp", hot)
    return runs.select(
        "user_id_db",
        "email_address",
        F.col("group_number").alias("group_user_email"),
        F.col("start_at").alias("start_local_datetime"),
        F.col("start_utc").alias("start_utc_timestamp"),
    )


def stg_user_email_by_local_datetime(events: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """Runs of one e-mail state per user, from events of every type (M1)."""
    return user_email_runs(user_states(events), hot)


def stg_store_url_info(events: DataFrame, rules: urls.StoreUrlRules) -> DataFrame:
    """Distinct addresses under which each store was seen."""
    return (
        events.where(text.has_text("store_id") & urls.is_store_url("current_url", rules))
        .select(
            F.trim("store_id").try_cast("bigint").alias("store_id"),
            urls.store_address("current_url", rules).alias("hostname_or_extracted_local_url"),
        )
        .where("store_id is not null and hostname_or_extracted_local_url is not null")
        .distinct()
    )


def stg_generate_date(spark: SparkSession, end: str, start: str = CALENDAR_START) -> DataFrame:
    """Calendar rows from ``start`` to ``end``."""
    return date_spine(spark, start, end).select(*dates.calendar_attributes("full_date"))


def stg_product(products: DataFrame, loaded: str | None = None) -> DataFrame:
    """Renamed and trimmed product attributes; rows without an id are left out.

    ``loaded``: a column that tells when a row was crawled, as ``read_products`` can give it; it is carried along.
    """
    trimmed = {
        "product_id": "product_id", "product_name": "name", "product_sku": "sku",
        "attribute_set_id": "attribute_set_id", "attribute_set_name": "attribute_set",
        "packaging_type": "type_id",
    }
    amounts = {
        "vnd_unit_price": "price", "vnd_min_price": "min_price", "vnd_max_price": "max_price",
    }
    optional = {
        "collection_id": "collection_id", "collection_name": "collection",
        "product_type_id": "product_type_value", "product_type_name": "product_type",
        "category_id": "category", "category_name": "category_name", "gender": "gender",
    }
    return products.where(text.has_text("product_id")).select(
        *[F.trim(src).alias(name) for name, src in trimmed.items()],
        *[F.col(src).cast("decimal(38,9)").alias(name) for name, src in amounts.items()],
        *[text.blank_to_null(src).alias(name) for name, src in optional.items()],
        *([loaded] if loaded else []),
    )


def stg_ip_location_mapping(ip_locations: DataFrame) -> DataFrame:
    """Cleaned location of each address with its location key."""
    code = text.country_code_repair("country_code", "country_name")
    cleaned = ip_locations.select(
        F.trim("ip_address").alias("ip_address"),
        text.sentinel_to_default(code).alias("country_code"),
        *[
            text.sentinel_to_default(text.strip_char(c, "'")).alias(c)
            for c in ("country_name", "region", "city")
        ],
    ).where(F.lower("ip_address") != "unknown")
    place = ("country_code", "region", "city")
    return cleaned.select(
        "ip_address",
        keys.unknown_if_all(keys.surrogate_key(*place), *place).alias("location_key"),
        "country_code", "country_name", "region", "city",
    )
