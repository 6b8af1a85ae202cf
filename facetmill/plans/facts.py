"""Facts: daily exchange rates and sales lines."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import keys
from ..functions.audit import UPDATED, with_audit
from ..operators.intervals import version_at
from ..operators.joins import lookup_join
from ..operators.rates import convert_lines, dense_rates
from ..operators.scans import hot_values
from ..operators.upsert import (
    changed_or_new, in_partitions, late_floor, late_window, left_out, merge_columns, partition_values, reconcile_groups,
    replace_groups, shrinking_groups,
)
from ..session import materialize, materialize_by
from ..sources.writers import write_partitioned

LINE_COLUMNS = [
    "order_id", "local_datetime", "local_order_date", "order_date_key", "store_id", "ip_address",
    "user_id_db", "email_address", "product_id", "currency", "unit_price",
]
#: What decides about the version, the customer and the place of a line.
HEAD = ("user_id_db", "local_datetime", "ip_address")
OPENED, CLOSED = "start_local_datetime", "end_local_datetime"
MEASURES = ["local_unit_price", "usd_unit_price", "local_amount", "usd_amount"]
DAY = "local_order_date"
#: What tells the lines of one order apart, whatever their price.
LINE = ("product_key",)
FACT_COLUMNS = [
    "sales_key", "order_id", "order_date_key", "local_order_date", "local_datetime",
    "scd_customer_key", "customer_key", "location_key", "store_key", "product_key",
    "currency_key", "product_qty", *MEASURES,
]


def rate_rows(calendar: DataFrame, currency_dim: DataFrame, rates: DataFrame) -> DataFrame:
    known = currency_dim.where(F.col("currency_key") != keys.UNKNOWN_KEY).select(
        "currency_code", "currency_key"
    )
    filled = dense_rates(rates, calendar, known)
    return filled.join(
        known.withColumnsRenamed(
            {"currency_code": "from_currency_code", "currency_key": "from_currency_key"}
        ),
        "from_currency_code",
    ).select(
        keys.surrogate_key("date_key", "from_currency_code", "to_currency_code").alias(
            "exchange_rate_key"
        ),
        "date_key",
        "full_date",
        "from_currency_key",
        keys.surrogate_key("to_currency_code").alias("to_currency_key"),
        "exchange_rate",
    )


def fact_snapshot_exchange_rate(
    calendar: DataFrame,
    currency_dim: DataFrame,
    rates: DataFrame,
    target: DataFrame | None = None,
) -> DataFrame:
    """One rate per day and currency (M10). Rates are units per dollar."""
    rows = rate_rows(calendar, currency_dim, rates)
    if target is None:
        return with_audit(rows)
    changes = materialize(changed_or_new(
        rows, target, ["exchange_rate_key"], ["exchange_rate"],
        keep=["date_key", "full_date", "from_currency_key", "to_currency_key"],
    ), "changed_rates")
    return merge_columns(target, changes, ["exchange_rate_key"], ["exchange_rate", *UPDATED])


def daily_rates(rate_fact: DataFrame, currency_dim: DataFrame) -> DataFrame:
    """The rate fact with currency codes instead of keys."""
    codes = currency_dim.select(
        F.col("currency_key").alias("from_currency_key"),
        F.col("currency_code").alias("from_currency_code"),
    )
    return rate_fact.join(codes, "from_currency_key", "left").select(
        "date_key", "from_currency_code", "exchange_rate"
    )


def folded_lines(sales: DataFrame) -> DataFrame:
    """Equal lines folded into one, those without an order id too."""
    return sales.groupBy(*LINE_COLUMNS).agg(F.sum("product_qty").alias("product_qty"))


def summed_lines(sales: DataFrame) -> DataFrame:
    """Equal lines of an order folded into one (A1). Lines without an order id are rejects."""
    return folded_lines(sales.where(F.col("order_id").isNotNull()))


def kept_lines(sales: DataFrame) -> DataFrame:
    """:func:`folded_lines`, written once in buckets of ``_head`` (:data:`HEAD`): lookups per order do not move them."""
    # the head is kept in place of its parts; a struct is a key even where some of its fields are NULL
    rest = [c for c in LINE_COLUMNS if c not in HEAD]
    folded = folded_lines(sales).select(F.struct(*HEAD).alias("_head"), *rest, "product_qty")
    return with_head_parts(materialize_by(folded, "folded_lines", "_head"))


def with_head_parts(lines: DataFrame) -> DataFrame:
    return lines.select(*[F.col(f"_head.{c}").alias(c) if c in HEAD else c for c in LINE_COLUMNS], "product_qty", "_head")


def line_key() -> Column:
    """Key of a fact row: every column the lines are grouped by, NULL as blank."""
    return keys.surrogate_key(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LINE_COLUMNS]
    )


def sales_rows(
    folded: DataFrame,
    store_dim: DataFrame,
    countries: DataFrame,
    daily: DataFrame,
    ip_map: DataFrame,
    scd_dim: DataFrame,
    current_dim: DataFrame,
    currency_dim: DataFrame,
) -> DataFrame:
    """Sales lines with resolved keys and converted amounts.

    The dimension arguments should be materialised tables: each lookup
    measures its side and is broadcast only if small, see ``lookup_join``. So
    should ``folded``, the result of ``summed_lines``: hot keys are counted in
    it. Version, customer and place are looked up once per distinct buyer, time and address, as all lines of an order
    share them. The lines move at most once for all three, without the columns that only their key needs, and not at all if they
    are :func:`kept_lines`. The store is looked up once, for its key and for its currency.
    """
    spread = ["sales_key"]
    # an address loaded twice must not double sales; a known place wins over -1
    places = materialize(ip_map.groupBy("ip_address").agg(F.max("location_key").alias("location_key")), "places")
    if "_head" not in folded.columns:
        folded = folded.withColumn("_head", F.struct(*HEAD))
    heads = materialize(folded.select("_head").distinct().select("_head.*"), "heads")
    hot = hot_values(heads.select("user_id_db").unionAll(scd_dim.select("user_id_db")), "user_id_db")
    found = version_at(heads, scd_dim, "user_id_db", "local_datetime", ["scd_customer_key"], OPENED, CLOSED, None, hot)
    for table, key in ((current_dim.select("user_id_db", "customer_key"), "user_id_db"), (places, "ip_address")):
        found = lookup_join(found, table, [key], list(HEAD), counted=heads)
    found = materialize(found.select(F.struct(*HEAD).alias("_head"), "scd_customer_key", "location_key", "customer_key"), "found")
    # every sold product is in the dimension, and its key is a function of its id
    product = F.when(F.col("product_id").isNotNull(), keys.surrogate_key("product_id")).alias("product_key")
    lines = folded.select(
        "_head", line_key().alias("sales_key"), product, "order_id", "order_date_key", "local_order_date", "store_id", "product_qty", "unit_price"
    )
    lines = lookup_join(lines, found, ["_head"], spread, counted=folded.select("_head"))
    lines = lines.withColumn("local_datetime", F.col("_head.local_datetime")).drop("_head")
    country_money = countries.groupBy(F.col("country_code_iso2").alias("country_code")).agg(
        F.min("currency_code").alias("country_currency")
    )
    stores = store_dim.select("store_id", "store_key", "country_code").join(
        country_money, "country_code", "left"
    ).drop("country_code")
    lines = lookup_join(lines, stores, ["store_id"], spread, counted=folded)
    lines = convert_lines(lines, daily, spread)
    lines = lookup_join(
        lines, currency_dim.select("currency_code", "currency_key"), ["currency_code"], spread
    )
    foreign = [
        "scd_customer_key", "customer_key", "location_key", "store_key", "product_key",
        "currency_key",
    ]
    return (
        lines.withColumns({k: keys.key_or_unknown(k) for k in foreign})
        .select(*FACT_COLUMNS)
    )


def merged_orders(rows: DataFrame, old: DataFrame, declared: str | None = None, line: Sequence[str] = LINE) -> DataFrame:
    """``old`` lines after the orders in ``rows``.

    A line's key holds its price, so a corrected line has another key and orders are replaced as a whole. That asks
    for rows that hold every line of their orders, as those read from the whole log of the open window do. For loads that
    may hold part of an order, ``declared`` names a column with the number of lines the order has: orders that
    are not complete are merged line by line. :func:`shrinking_orders` tells what a replacement would lose.
    """
    if declared is None:
        return replace_groups(rows, old, "order_id", ["sales_key"])
    return reconcile_groups(rows, old, "order_id", ["sales_key"], line, declared)


def shrinking_orders(rows: DataFrame, target: DataFrame, line: Sequence[str] = LINE) -> DataFrame:
    """Orders in ``rows`` that have lines in ``target`` which ``rows`` lack: (order_id, lost_lines)."""
    return shrinking_groups(rows, target, "order_id", line)


def fact_sales_order_detail(
    rows: DataFrame, target: DataFrame | None = None, days: int = 7, as_of: datetime.date | None = None,
    declared: str | None = None, line: Sequence[str] = LINE,
) -> DataFrame:
    """The sales fact; with a target, the table after reprocessing the last seven days (M7).

    Orders that arrive within the open window replace what the window holds of them, see :func:`merged_orders`
    for ``declared`` and ``line``. Rows older than the window are not taken; :func:`late_rejects` returns them.
    For a table kept in date folders use :func:`upsert_sales` instead.
    """
    if target is None:
        return with_audit(rows.drop(declared) if declared else rows)
    floor = open_floor(target, days, as_of)
    open_ = floor.isNull() | (F.col(DAY) >= floor)
    fresh = late_sales(rows, target, days, as_of)
    return target.where(~F.coalesce(open_, F.lit(False))).unionByName(merged_orders(fresh, target.where(open_), declared, line))


def open_floor(target: DataFrame, days: int = 7, as_of: datetime.date | None = None) -> Column:
    """First day of the open window, NULL for an empty target."""
    return late_floor(target, DAY, days, as_of)


def late_sales(rows: DataFrame, target: DataFrame, days: int = 7, as_of: datetime.date | None = None) -> DataFrame:
    """Rows inside the open window."""
    return late_window(rows, target, DAY, days, as_of)


def late_rejects(rows: DataFrame, target: DataFrame, days: int = 7, as_of: datetime.date | None = None) -> DataFrame:
    """Rows that came too late to be taken."""
    return left_out(rows, target, DAY, days, as_of)


def write_sales(fact: DataFrame, path: str) -> None:
    """The fact in date folders, sorted inside for pruning."""
    write_partitioned(fact, path, DAY, ["order_date_key", "order_id", "scd_customer_key", "product_key"])


def touched_days(fresh: DataFrame, target: DataFrame, floor: datetime.date | None) -> list:
    """Days of the arriving rows, and of the window's old lines of the same orders. ``fresh``: a written table."""
    window = target.where(F.col(DAY) >= F.lit(floor)) if floor else target
    old = window.select("order_id", DAY).join(fresh.select("order_id").distinct(), "order_id", "left_semi")
    return partition_values(old.select(DAY).union(fresh.select(DAY)), DAY)


def upsert_sales(
    rows: DataFrame, path: str, days: int = 7, as_of: datetime.date | None = None, declared: str | None = None
) -> DataFrame:
    """Upsert into the fact kept at ``path``, rewriting only the touched date folders (M7, M8).

    ``declared``: see :func:`merged_orders`.

    Returns the rows that came too late. A day that loses all its lines, as their
    order moved to another day, cannot be emptied by overwriting folders; then the
    whole table is written anew.
    """
    spark = rows.sparkSession
    target = spark.read.parquet(path)
    first = spark.range(1).select(late_floor(target, DAY, days, as_of)).first()
    floor = first[0] if first else None
    rejects = materialize(late_rejects(rows, target, days, as_of), "late_rejects")
    fresh = materialize(late_sales(rows, target, days, as_of), "late_sales")
    days_touched = touched_days(fresh, target, floor)
    merged = materialize(merged_orders(fresh, in_partitions(target, DAY, days_touched), declared), "touched_sales")
    if set(days_touched) - set(partition_values(merged, DAY)):
        whole = materialize(fact_sales_order_detail(fresh, target, days, as_of, declared), "whole_sales")
        write_partitioned(whole, path, DAY, ["order_date_key", "order_id"], replace_all=True)
    else:
        write_sales(merged, path)
    return rejects
