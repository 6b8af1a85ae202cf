"""The whole warehouse in dependency order."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import local_datetime
from ..functions.keys import UNKNOWN_KEY
from ..functions.urls import StoreUrlRules
from ..operators.scans import hot_values
from ..session import materialize
from ..sources.writers import write_clustered, write_partitioned
from . import dims, facts, mart, staging
from .checks import Report
from .contracts import promised


#: One type and day of the log is written by up to so many tasks.
LANDING_PARTS = 64


@dataclass(frozen=True)
class Sources:
    """Inputs of a build. ``events`` feeds sales, ``visits`` the histories.

    Both are usually the same event table. ``product_loaded`` names the column of
    ``products`` that tells when a row was crawled; without it the greatest of several crawls counts.
    """

    events: DataFrame
    visits: DataFrame
    products: DataFrame
    ip_locations: DataFrame
    countries: DataFrame
    currencies: DataFrame
    rates: DataFrame
    calendar: DataFrame
    url_rules: StoreUrlRules
    product_loaded: str | None = None


#: How the kept tables are laid out: the date folders of the facts, the sort columns of the dimensions.
DATE_FOLDERS = {"fact_sales_order_detail": "local_order_date", "fact_snapshot_exchange_rate": "full_date"}
SORTED_BY = {
    "dim_product": ["product_id"], "dim_store": ["store_id"], "dim_location": ["country_code", "region", "city"],
    "dim_customer_scd": ["user_id_db", "start_local_datetime"], "dim_customer_current": ["user_id_db"],
    "dim_currency": ["currency_code"], "dim_date": ["full_date"],
}


def land_events(events: DataFrame, path: str) -> DataFrame:
    """Append raw events to the event table at ``path`` and read all of it.

    The log is parsed once, here. Later steps read Parquet with the columns they
    need and, as folders go by event type and day, the types they need. Events
    without a readable local time land in the folder of no day.
    """
    day = F.to_date(local_datetime("local_time"))
    events.withColumn("landed_day", day).repartition("collection", "landed_day", F.pmod(F.xxhash64("_id"), F.lit(LANDING_PARTS))).write.mode(
        "append"
    ).partitionBy("collection", "landed_day").parquet(path)
    return events.sparkSession.read.parquet(path)


def write_core(tables: dict[str, DataFrame], folder: str) -> None:
    """Keep dimensions and facts below ``folder`` in their declared layouts (S12, S13), for the next run."""
    for name, df in tables.items():
        if name in DATE_FOLDERS:
            # ranging reads its rows twice, and the sales are not written yet
            df = materialize(df, name) if name == "fact_sales_order_detail" else df
            write_partitioned(df, f"{folder}/{name}", DATE_FOLDERS[name], replace_all=True)
        elif name in SORTED_BY:
            write_clustered(df, f"{folder}/{name}", SORTED_BY[name])


def read_core(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables that :func:`write_core` kept."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in (*DATE_FOLDERS, *SORTED_BY)}


def side_by_side(spark: SparkSession, *branches: Callable[[], None]) -> None:
    """Run branches that do not depend on each other at once, and wait for all."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(branches)) as pool:
        for done in [pool.submit(inherit(branch)) for branch in branches]:
            done.result()


def build_core(
    src: Sources, existing: dict[str, DataFrame] | None = None, as_of: datetime.date | None = None, report: Report | None = None
) -> dict[str, DataFrame]:
    """Staging, dimensions and facts, each shared table written once.

    With ``existing`` (the tables of the run before, as :func:`read_core` gives
    them) the dimensions and the rate fact are upserted, and of the sales only
    checkouts of the open week before ``as_of`` are staged and resolved again (``order_lines`` holds no others). ``src`` then
    holds the whole event table: histories are rebuilt from all of a user's events, and products from all that was sold.

    Tables read by more than one later step are written to the shared folder:
    nothing is computed twice, a lost executor costs one step at most, and
    lookups see exact sizes. The branches for sales, customers and places do
    not depend on each other; they are submitted side by side, so that the
    tail of one branch does not leave the cluster idle.

    Outputs must have the columns they declare. With a ``report`` the declared checks are counted as tables are
    written, those of the seeds and of staging included; a strict one stops the run at the first violation.
    """
    t: dict[str, DataFrame] = {}
    old = existing or {}
    known = old.get("fact_sales_order_detail")

    def table(name: str, df: DataFrame) -> None:
        t[name] = report.materialize(name, df) if report else materialize(promised(name, df), name)

    def checked(name: str, df: DataFrame) -> DataFrame:
        if report:
            report.check(name, df)
        return df

    def sales() -> None:
        # Lines are folded as they are staged and written once; rejects count among the products sold.
        t["stg_sales_order_detail"] = staged = staging.stg_sales_order_detail(src.events)
        if known is not None:
            staged = staging.stg_sales_order_detail(staging.open_events(src.events, facts.open_floor(known, as_of=as_of)))
        folded = facts.kept_lines(staged)
        t["order_lines"] = folded.where(F.col("order_id").isNotNull())
        table(
            "dim_product",
            dims.dim_product(
                staging.stg_product(src.products, src.product_loaded),
                folded if known is None else staging.sold_products(src.events), old.get("dim_product"), src.product_loaded,
            ),
        )

    def customers() -> None:
        # a user has no more runs of a state than events
        hot = hot_values(staging.user_states(src.visits), "user_id_db")
        table("stg_user_email", staging.stg_user_email_by_local_datetime(src.visits, hot))
        table("dim_customer_scd", dims.dim_customer_scd(t["stg_user_email"], old.get("dim_customer_scd"), hot))
        table("dim_customer_current", dims.dim_customer_current(t["stg_user_email"], old.get("dim_customer_current")))

    def places() -> None:
        table("stg_ip_location_mapping", staging.stg_ip_location_mapping(src.ip_locations))
        table("dim_location", dims.dim_location(t["stg_ip_location_mapping"]))
        pages = checked("stg_store_url_info", staging.stg_store_url_info(src.visits, src.url_rules))
        countries = checked("countries_currencies_full", src.countries)
        table("dim_store", dims.dim_store(pages, countries, src.url_rules.local_host, old.get("dim_store")))

    def money() -> None:
        days = dims.dim_date(checked("stg_generate_date", src.calendar), old.get("dim_date"))
        table("dim_date", old["dim_date"].unionByName(days) if old else days)
        table("dim_currency", dims.dim_currency(checked("currencies_with_raw_symbol", src.currencies)))
        rates = checked("exchange_rates", src.rates)
        table(
            "fact_snapshot_exchange_rate",
            facts.fact_snapshot_exchange_rate(t["dim_date"], t["dim_currency"], rates, old.get("fact_snapshot_exchange_rate")),
        )

    side_by_side(src.events.sparkSession, sales, customers, places, money)

    known_versions = t["dim_customer_scd"].where(F.col("scd_customer_key") != UNKNOWN_KEY)
    t["fact_sales_order_detail"] = facts.fact_sales_order_detail(
        facts.sales_rows(
            t["order_lines"],
            t["dim_store"],
            src.countries,
            facts.daily_rates(t["fact_snapshot_exchange_rate"], t["dim_currency"]),
            t["stg_ip_location_mapping"],
            known_versions,
            t["dim_customer_current"],
            t["dim_currency"],
        ),
        known,
        as_of=as_of,
    )
    return t


def build_mart(
    src: Sources, existing: dict[str, DataFrame] | None = None, as_of: datetime.date | None = None,
    strict: bool = False, report: Report | None = None,
) -> dict[str, DataFrame]:
    """Core tables plus the flat report table. The fact is written first.

    With ``strict`` a violated check stops the run, see :func:`build_core`; with a report of one's own, or ``strict``, the flat
    table is written and checked too.
    """
    report = report or (Report(strict=True) if strict else None)
    t = build_core(src, existing, as_of, report)
    name = "fact_sales_order_detail"
    t[name] = report.materialize(name, t[name]) if report else materialize(promised(name, t[name]), name)
    flat = promised("mart_sales_report", mart.mart_sales_report(
        t["fact_sales_order_detail"], t["dim_date"], t["dim_product"], t["dim_store"],
        t["dim_location"], t["dim_customer_scd"], t["dim_currency"],
    ))
    t["mart_sales_report"] = report.materialize("mart_sales_report", flat) if report else flat
    return t
