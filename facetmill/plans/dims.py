"""Dimensions. With a ``target`` (the table as it is) they return the table after the upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import keys, text
from ..functions.audit import UPDATED, with_audit, without_audit  # noqa: F401
from ..functions.urls import last_segment_tail, top_level_domain
from ..operators.distincts import with_default_member
from ..operators.intervals import (
    customer_current, customer_scd, with_current_member, with_scd_member,
)
from ..operators.upsert import changed_or_new, merge_columns, newer_than_target, with_carried_audit
from ..session import materialize

CURRENCY_MEMBER = {
    "currency_key": keys.UNKNOWN_KEY, "currency_code": "Unknown", "currency_name": "Unknown",
}
LOCATION_MEMBER = {
    "location_key": keys.UNKNOWN_KEY, "country_code": "Unknown", "country_name": "Unknown",
    "region": "Unknown", "city": "Unknown",
}
STORE_MEMBER = {
    "store_key": keys.UNKNOWN_KEY, "store_id": "-1", "country_code": "Unknown",
    "country_name": "Unknown",
}
PRODUCT_NAMES = (
    "product_name", "product_sku", "attribute_set_name", "packaging_type", "collection_name",
    "product_type_name", "category_name", "gender",
)
PRODUCT_IDS = ("attribute_set_id", "collection_id", "product_type_id", "category_id")
PRODUCT_AMOUNTS = ("vnd_unit_price", "vnd_min_price", "vnd_max_price")
PRODUCT_ATTRIBUTES = (
    "product_name", "product_sku", "attribute_set_id", "attribute_set_name", "packaging_type",
    "vnd_unit_price", "vnd_min_price", "vnd_max_price", "collection_id", "collection_name",
    "product_type_id", "product_type_name", "category_id", "category_name", "gender",
)
PRODUCT_MEMBER = (
    {"product_key": keys.UNKNOWN_KEY, "product_id": "-1"}
    | {c: "Unknown" for c in PRODUCT_NAMES}
    | {c: "-1" for c in PRODUCT_IDS}
    | {c: 0 for c in PRODUCT_AMOUNTS}
)

INTERNATIONAL = "INTERNATIONAL"
# Country tails of in-house addresses that win over the public host.
LOCAL_WINS = ("us", "gb")


def dim_date(calendar: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """The calendar; with a target, only its missing newer days, to be appended (M4)."""
    return calendar if target is None else newer_than_target(calendar, target, "full_date")


def dim_currency(currencies: DataFrame) -> DataFrame:
    rows = currencies.select(
        keys.surrogate_key("currency_code").alias("currency_key"), "currency_code", "currency_name"
    )
    return with_audit(with_default_member(rows, CURRENCY_MEMBER))


def dim_location(ip_map: DataFrame) -> DataFrame:
    """One row per location key and a single unknown member."""
    rows = (
        ip_map.where(F.col("location_key") != keys.UNKNOWN_KEY)
        .groupBy("location_key")
        .agg(*[F.min(c).alias(c) for c in ("country_code", "country_name", "region", "city")])
    )
    return with_audit(with_default_member(rows, LOCATION_MEMBER))


def store_countries(url_info: DataFrame, countries: DataFrame, local_host: str) -> DataFrame:
    """One country code per store, from all its addresses.

    Of several candidates the choice is: an in-house address of ``us`` or
    ``gb``, then a public host (codes of the country table first), then
    another in-house address; the least code among equals. All joins of the
    address lists come down to one aggregate per store.
    """
    address = "hostname_or_extracted_local_url"
    is_local = F.col(address).contains(local_host)
    coded = url_info.select(
        "store_id",
        F.when(~is_local, F.upper(top_level_domain(address))).alias("host_code"),
        F.when(
            F.col(address).contains(f"{local_host}/"), last_segment_tail(address)
        ).alias("local_code"),
    ).distinct()
    listed = countries.select(
        F.col("country_code_iso2").alias("host_code"), F.lit(True).alias("listed")
    ).dropDuplicates(["host_code"])
    preferred = F.col("local_code").isin(*LOCAL_WINS)
    return (
        coded.join(listed, "host_code", "left")
        .groupBy("store_id")
        .agg(
            F.upper(
                F.coalesce(
                    F.min(F.when(preferred, F.col("local_code"))),
                    F.min(F.when(F.col("listed"), F.col("host_code"))),
                    F.min("host_code"),
                    F.min("local_code"),
                )
            ).alias("country_code")
        )
    )


def store_rows(url_info: DataFrame, countries: DataFrame, local_host: str) -> DataFrame:
    names = countries.groupBy(F.col("country_code_iso2").alias("country_code")).agg(F.min("country_name").alias("country_name"))
    return store_countries(url_info, countries, local_host).join(names, "country_code", "left").select(
        keys.surrogate_key("store_id").alias("store_key"),
        F.col("store_id").cast("string").alias("store_id"),
        "country_code",
        text.default("country_name", INTERNATIONAL).alias("country_name"),
    )


def dim_store(
    url_info: DataFrame, countries: DataFrame, local_host: str, target: DataFrame | None = None
) -> DataFrame:
    rows = store_rows(url_info, countries, local_host)
    if target is None:
        return with_audit(with_default_member(rows, STORE_MEMBER))
    attributes = ["country_code", "country_name"]
    # a merge reads what it brings twice, as it refuses repeated keys; so do the others below
    audited = materialize(with_carried_audit(rows, target, ["store_key"], attributes), "changed_stores")
    return merge_columns(target, audited, ["store_id"], [*attributes, *UPDATED])


def one_per_product(staged: DataFrame, loaded: str | None = None) -> DataFrame:
    """One row per product: of several crawls the one with the greatest ``loaded``, then the greatest in all columns."""
    rest = [c for c in staged.columns if c not in ("product_id", loaded)]
    newest = F.max(F.struct(*([loaded] if loaded else []), *rest)).alias("_row")
    return staged.groupBy("product_id").agg(newest).select("product_id", *[F.col(f"_row.{c}").alias(c) for c in rest])


def product_rows(staged: DataFrame, sales: DataFrame, loaded: str | None = None) -> DataFrame:
    """Crawled products and products only known from sales, defaults filled in.

    A product crawled several times gives one row. Sales without a product id add nothing; they point to the unknown member.
    """
    cleaned = one_per_product(staged, loaded)
    for group in ("collection", "product_type", "category"):
        none = text.missing_id(f"{group}_id")
        cleaned = cleaned.withColumn(
            f"{group}_name", text.value_if(none, F.lit("Unknown"), F.col(f"{group}_name"))
        ).withColumn(f"{group}_id", text.value_if(none, F.lit("-1"), F.col(f"{group}_id")))
    cleaned = cleaned.withColumn(
        "gender",
        text.value_if(F.col("gender") == "false", F.lit("Uncategorized"), F.col("gender")),
    )
    sold = sales.where(F.col("product_id").isNotNull()).select("product_id").distinct()
    merged = cleaned.join(sold, "product_id", "full")
    defaults = (
        {c: F.lit("Unknown") for c in PRODUCT_NAMES}
        | {c: F.lit("-1") for c in PRODUCT_IDS}
        | {c: F.lit(0).cast("decimal(38,9)") for c in PRODUCT_AMOUNTS}
    )
    return merged.select(
        keys.surrogate_key("product_id").alias("product_key"),
        "product_id",
        *[F.coalesce(F.col(c), defaults[c]).alias(c) for c in PRODUCT_ATTRIBUTES],
    )


def dim_product(staged: DataFrame, sales: DataFrame, target: DataFrame | None = None, loaded: str | None = None) -> DataFrame:
    rows = product_rows(staged, sales, loaded)
    if target is None:
        return with_audit(with_default_member(rows, PRODUCT_MEMBER))
    changes = materialize(
        changed_or_new(rows, target, ["product_id"], PRODUCT_ATTRIBUTES, keep=["product_key"]), "changed_products"
    )
    return merge_columns(target, changes, ["product_id"], [*PRODUCT_ATTRIBUTES, *UPDATED])


def dim_customer_scd(intervals: DataFrame, target: DataFrame | None = None, hot: Sequence | None = None) -> DataFrame:
    """Type-2 customers (M2). ``hot``: users with very many rows, if they are known (``hot_values``).

    With a target, ``intervals`` hold the whole history of every user in them.
    These users' versions are replaced: a late event may move a start, and the
    version it belonged to must not stay. Versions with the same key keep
    ``created_*``; other users' versions stay as they are.
    """
    rows = customer_scd(intervals.withColumnRenamed("group_user_email", "group_number"), hot)
    if target is None:
        return with_scd_member(rows)
    audited = with_carried_audit(rows, target, ["scd_customer_key"]).select(target.columns)
    others = target.join(rows.select("user_id_db").distinct(), "user_id_db", "left_anti")
    return audited.unionByName(others)


def dim_customer_current(intervals: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Type-1 customers (M3)."""
    rows = customer_current(intervals.withColumnRenamed("group_user_email", "group_number"))
    if target is None:
        return with_current_member(rows)
    audited = materialize(with_carried_audit(rows, target, ["user_id_db"]), "changed_customers")
    return merge_columns(
        target, audited, ["user_id_db"],
        ["email_address", "active_date", "has_email_info", *UPDATED],
    )


