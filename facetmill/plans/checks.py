"""The declared checks of every input, staging table and output, and reports of them (Q1 to Q3)."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import observe_nulls, run_checks
from ..session import materialize
from .contracts import promised


@dataclass(frozen=True)
class Checks:
    """Columns without NULLs, unique columns (members "unknown" included) and unique combinations."""

    not_null: list[str]
    unique: list[str] = field(default_factory=list)
    combinations: list[list[str]] = field(default_factory=list)


_DATE = Checks(
    ["date_key", "full_date", "year_num", "quarter_num", "quarter_name", "month_num", "full_month_name", "year_month",
     "day_of_month", "day_of_week", "full_day_name", "is_weekend"],
    ["date_key", "full_date"],
)

# What each seed, staging table and output promises its readers.
CHECKS = {
    "countries_currencies_full": Checks(["country_code_iso2", "country_name", "phone_code", "country_group"], ["country_code_iso2"]),
    "exchange_rates": Checks(["date_key", "from_currency_code", "to_currency_code", "exchange_rate"]),
    "currencies_with_raw_symbol": Checks(["currency_code", "currency_name"], ["currency_code"]),
    "stg_store_url_info": Checks(["store_id", "hostname_or_extracted_local_url"], ["store_id"]),
    "stg_generate_date": _DATE,
    "dim_store": Checks(["store_key", "store_id", "country_code", "country_name"], ["store_key", "store_id"]),
    "dim_currency": Checks(["currency_key", "currency_code", "currency_name"], ["currency_key", "currency_code"]),
    "dim_product": Checks(
        ["product_key", "product_id", "product_name", "product_sku", "attribute_set_id", "attribute_set_name", "packaging_type",
         "collection_id", "collection_name", "product_type_id", "product_type_name", "category_id", "category_name", "gender",
         "vnd_unit_price", "vnd_min_price", "vnd_max_price"],
        ["product_key", "product_id"],
    ),
    "dim_date": _DATE,
    "dim_location": Checks(["location_key", "country_code", "country_name", "region", "city"], ["location_key"]),
    "dim_customer_scd": Checks(["scd_customer_key", "user_id_db", "email_address", "start_local_datetime", "end_local_datetime"], ["scd_customer_key"]),
    "dim_customer_current": Checks(["customer_key", "user_id_db", "email_address"], ["customer_key", "user_id_db"]),
    "fact_snapshot_exchange_rate": Checks(
        ["exchange_rate_key", "date_key", "from_currency_key", "to_currency_key", "exchange_rate"], ["exchange_rate_key"],
        [["date_key", "from_currency_key", "to_currency_key"]],
    ),
    "fact_sales_order_detail": Checks(
        ["sales_key", "order_id", "scd_customer_key", "customer_key", "location_key", "store_key", "product_key", "currency_key"], ["sales_key"]
    ),
    "mart_sales_report": Checks(
        ["order_id", "order_datetime", "product_id", "product_sku", "product_name", "product_category", "product_collection",
         "customer_country", "customer_region", "customer_city", "store_id", "store_country", "customer_id", "customer_email",
         "currency_code", "currency_name", "quantity_sold", "unit_price", "sales_amount"]
    ),
}


class ViolatedError(ValueError):
    """Declared checks do not hold."""


class Report:
    """Violations of the declared checks, counted as tables are written.

    NULLs are counted by the write itself; keys that must be unique by one shuffle over the key columns of what was
    written. With ``strict`` the first table that violates a check stops the run with :class:`ViolatedError`.
    """

    def __init__(self, strict: bool = False, checks: dict[str, Checks] | None = None):
        self.strict, self.checks = strict, CHECKS if checks is None else checks
        self.rows: list[tuple[str, str, int]] = []

    def _add(self, name: str, found: list[tuple[str, int]]) -> None:
        self.rows += [(name, check, n) for check, n in found]
        bad = {check: n for check, n in found if n}
        if bad and self.strict:
            raise ViolatedError(f"{name}: {bad}")

    def check(self, name: str, df: DataFrame) -> None:
        """Check a table that is there."""
        c = self.checks.get(name)
        if c:
            self._add(name, [(r["check_name"], r["violations"]) for r in run_checks(df, c.not_null, c.unique, c.combinations).collect()])

    def written(self, name: str, df: DataFrame, write) -> DataFrame:
        """``write(df)`` with its NULLs counted; ``write`` returns the table as it reads. Columns must be the declared ones."""
        df, c = promised(name, df), self.checks.get(name)
        if not c:
            return write(df)
        df, nulls = observe_nulls(df, c.not_null)
        out = write(df)
        found = nulls.get
        keys = run_checks(out, (), c.unique, c.combinations).collect()
        self._add(name, [(f"not_null:{x}", found.get(x, 0)) for x in c.not_null] + [(r["check_name"], r["violations"]) for r in keys])
        return out

    def materialize(self, name: str, df: DataFrame) -> DataFrame:
        return self.written(name, df, lambda d: materialize(d, name))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """(table_name, check_name, violations) of every check so far."""
        return spark.createDataFrame(self.rows, "table_name string, check_name string, violations bigint")


def check_tables(tables: dict[str, DataFrame], checks: dict[str, Checks] = CHECKS) -> DataFrame:
    """(table_name, check_name, violations) of every declared check on the tables that are there, one scan per table."""
    parts = [
        run_checks(tables[name], c.not_null, c.unique, c.combinations).select(F.lit(name).alias("table_name"), "check_name", "violations")
        for name, c in checks.items() if name in tables
    ]
    return reduce(DataFrame.unionByName, parts)
