"""A kept warehouse that each run brings up to date from what is new.

Everything is a :class:`FolderTable`: the landed log by event type and day (or month), the users' states by bucket of users, the
dimensions and facts. A run reads the loads that a table has not taken yet, the days that are still open, and the buckets of users with new events;
it names no other folder to Spark. Each table's commit notes which loads it has taken, so a run that died half-way
is simply run again: a load is taken once by every table.
"""

from __future__ import annotations

import dataclasses
import datetime
import uuid
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import local_datetime
from ..functions.keys import UNKNOWN_KEY
from ..functions.urls import StoreUrlRules
from ..operators.joins import fits_broadcast
from ..session import materialize, run_folder
from ..sources.folders import Folder, FolderTable, Version, Wanted
from . import dims, facts, mart, staging
from .checks import Report
from .contracts import promised
from .pipeline import LANDING_PARTS, SORTED_BY, side_by_side

USER_BUCKETS = 64
#: Up to so many users are named in the filter itself, which lets the scan skip parts of files.
NAMED_USERS = 1000
#: A run lands up to so many files, the oldest first; the next run goes on.
FILES_PER_RUN = 100_000
LEDGERS = 50


@dataclasses.dataclass(frozen=True)
class References:
    """Inputs that are read whole in every run: small next to the log."""

    products: DataFrame
    ip_locations: DataFrame
    countries: DataFrame
    currencies: DataFrame
    rates: DataFrame
    calendar: DataFrame
    url_rules: StoreUrlRules
    product_loaded: str | None = None


class Warehouse:
    """Tables below ``folder``. ``user_buckets`` and ``period`` are fixed with the first run.

    ``user_buckets``: about the size of the histories by 1 GB. ``period``: what one folder of the log and of the fact
    holds, a "day" or, for logs of little a day, a "month". The open window begins ``late_days`` before the newest sale, with a whole folder.
    ``strict``: new rows of a table are checked after they are written and before readers see them; a violation stops the run.
    """

    def __init__(
        self, spark: SparkSession, folder: str, user_buckets: int = USER_BUCKETS, late_days: int = 7, period: str = "day", strict: bool = False
    ):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.user_buckets, self.late_days, self.period, self.strict = user_buckets, late_days, period, strict

        def table(name: str, by: tuple[str, ...] = (), order: list[str] | None = None) -> FolderTable:
            return FolderTable(spark, f"{self.folder}/{name}", by, SORTED_BY.get(name, []) if order is None else order)

        self.events = table("events", ("collection", "landed_from"))
        self.states = table("user_states", ("user_bucket",), ["user_id_db"])
        self.pages = table("store_pages", order=["store_id"])
        self.late = table("late_sales", order=["order_id"])
        self.tables = {
            "dim_customer_scd": table("dim_customer_scd", ("user_bucket",)),
            "dim_customer_current": table("dim_customer_current", ("user_bucket",)),
            "fact_sales_order_detail": table("fact_sales_order_detail", ("sold_from",), ["order_date_key", "order_id"]),
            "fact_snapshot_exchange_rate": table("fact_snapshot_exchange_rate", order=["date_key"]),
            **{name: table(name) for name in ("dim_product", "dim_store", "dim_location", "dim_currency", "dim_date")},
        }

    # -- landing ---------------------------------------------------------------------

    def land(self, events: DataFrame, ledger: str | None = None) -> str:
        """Append events to the log, as one load that is seen whole or not at all (S7). Returns its id.

        Folders go by event type and local day; events without a readable local time land in the folder of no day.
        """
        rows = events.withColumn("landed_from", self._period(F.to_date(local_datetime("local_time"))))
        part = F.pmod(F.xxhash64("_id"), F.lit(LANDING_PARTS))
        note = {"ledgers": [*self.events.note().get("ledgers", []), ledger]} if ledger else None
        return self.events.append(rows, note, [part])

    def land_files(self, folder: str, read: Callable[[list[str]], DataFrame], glob: str = "*.jsonl", most: int = FILES_PER_RUN) -> int:
        """Land the files below ``folder`` that have not been landed, each exactly once (T1, S7). Returns their number.

        A file is known by its path, size and time: one that was written again counts as new. The ledger of a load is
        named by the same commit that names its rows, so that both are there or neither. ``read`` makes events of paths.
        """
        listing = (
            self.spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
            .select("path", "length", F.col("modificationTime").alias("modified"))
        )
        known = self.landed_files()
        new = listing if known is None else listing.join(known, ["path", "length", "modified"], "left_anti")
        # The list goes to the reader by the driver, which lists the files of any scan.
        found = new.orderBy("modified", "path").limit(most).collect()
        if not found:
            return 0
        path = f"{self.folder}/events/ledger/{uuid.uuid4().hex}"
        self.spark.createDataFrame(found, new.schema).coalesce(1).write.parquet(path)
        self.land(read([r["path"] for r in found]), path)
        return len(found)

    def landed_files(self) -> DataFrame | None:
        """(path, length, modified) of every file landed so far."""
        named = self.events.note().get("ledgers", [])
        return self.spark.read.parquet(*named) if named else None

    def compact_ledger(self) -> None:
        """Many small ledgers become one."""
        head = self.events.head()
        if head and len(head.note.get("ledgers", [])) > LEDGERS:
            path = f"{self.folder}/events/ledger/{uuid.uuid4().hex}"
            self.landed_files().coalesce(1).write.parquet(path)
            self.events.switch([], head.schema, None, {"ledgers": [path]}, head.number)

    # -- what is new -----------------------------------------------------------------

    def loads(self) -> list[str]:
        head = self.events.head()
        return sorted({f.load for f in head.folders}) if head else []

    def fresh(self, *tables: FolderTable) -> set[str]:
        """Loads of the log that one of the tables has not taken."""
        taken = [set(t.note().get("taken", [])) for t in tables]
        return {load for load in self.loads() if any(load not in t for t in taken)}

    def _bucket(self, user: str = "user_id_db") -> Column:
        return F.pmod(F.xxhash64(user), F.lit(self.user_buckets)).cast("int")

    def _of_users(self, table: FolderTable, users: DataFrame) -> DataFrame:
        """The table's rows of ``users``, a written table of unique users with their buckets. Other buckets are not opened."""
        buckets = {str(r[0]) for r in users.select("user_bucket").distinct().collect()}
        rows = table.read(lambda f: f.values["user_bucket"] in buckets).drop("user_bucket")
        names = users.select("user_id_db")
        if fits_broadcast(names, NAMED_USERS):
            return rows.where(F.col("user_id_db").isin([r[0] for r in names.collect()]))
        return rows.join(F.broadcast(names) if fits_broadcast(names) else names, "user_id_db", "left_semi")

    # -- a run -----------------------------------------------------------------------

    def update_customers(self) -> None:
        """Histories of the users with new events, from all their states; other users are neither read nor written (M2, M3)."""
        new = self.fresh(self.states)
        if new:
            states = staging.user_states(self.events.read(lambda f: f.load in new)).distinct()
            self.states.append(states.withColumn("user_bucket", self._bucket()), {"taken": self.loads()})
        targets = [self.tables["dim_customer_scd"], self.tables["dim_customer_current"]]
        new = self.fresh(*targets)
        if not new:
            return
        seen = staging.user_states(self.events.read(lambda f: f.load in new)).select("user_id_db").distinct()
        users = materialize(seen.withColumn("user_bucket", self._bucket()), "touched_users")
        runs = materialize(staging.user_email_runs(self._of_users(self.states, users)), "stg_user_email")
        touched = {str(r[0]) for r in users.select("user_bucket").distinct().collect()}
        taken = {"taken": self.loads()}
        for name, build in (("dim_customer_scd", dims.dim_customer_scd), ("dim_customer_current", dims.dim_customer_current)):
            head = self.tables[name].head()
            known = self.tables[name].read(lambda f: f.values["user_bucket"] in touched, head.number).drop("user_bucket") if head else None
            self._publish(name, build(runs, known), head, {"user_bucket": self._bucket()}, lambda f: f.values["user_bucket"] in touched, taken)

    def update_stores(self, ref: References) -> None:
        new = self.fresh(self.pages)
        if new:
            pages = staging.stg_store_url_info(self.events.read(lambda f: f.load in new), ref.url_rules)
            head = self.pages.head()
            known = pages if head is None else pages.unionByName(self.pages.read(version=head.number)).distinct()
            self.pages.replace(known, None, {"taken": self.loads()}, head.number if head else 0)
        self._replace("dim_store", lambda old: dims.dim_store(self.pages.read(), ref.countries, ref.url_rules.local_host, old))

    def update_products(self, ref: References) -> None:
        table = self.tables["dim_product"]
        new = self.fresh(table)
        checkouts = self.events.read(lambda f: f.load in new and f.values["collection"] == staging.CHECKOUT)
        sold = materialize(staging.sold_products(checkouts), "sold_products")
        staged = staging.stg_product(ref.products, ref.product_loaded)

        def build(old: DataFrame | None) -> DataFrame:
            # A known product that is sold again, but not crawled again, stays as it is.
            unknown = sold if old is None else sold.join(old.select("product_id"), "product_id", "left_anti")
            return dims.dim_product(staged, unknown, old, ref.product_loaded)

        self._replace("dim_product", build, {"taken": self.loads()})

    def update_places(self, ref: References) -> DataFrame:
        places = materialize(staging.stg_ip_location_mapping(ref.ip_locations), "stg_ip_location_mapping")
        self._replace("dim_location", lambda old: dims.dim_location(places))
        return places

    def update_money(self, ref: References) -> None:
        def days(old: DataFrame | None) -> DataFrame:
            more = dims.dim_date(ref.calendar, old)
            return more if old is None else old.unionByName(more)

        self._replace("dim_date", days)
        self._replace("dim_currency", lambda old: dims.dim_currency(ref.currencies))
        self._replace(
            "fact_snapshot_exchange_rate",
            lambda old: facts.fact_snapshot_exchange_rate(self.read("dim_date"), self.read("dim_currency"), ref.rates, old),
        )

    def _replace(self, name: str, build: Callable[[DataFrame | None], DataFrame], note: dict | None = None) -> None:
        head = self.tables[name].head()
        old = self.tables[name].read(version=head.number) if head else None
        self._publish(name, build(old), head, note=note)

    def _publish(
        self, name: str, rows: DataFrame, head: Version | None, folders: dict[str, Column] | None = None, gone: Wanted | None = None, note: dict | None = None
    ) -> None:
        """Write rows of a table, check them, and only then put them in the place of the folders that ``gone`` accepts (all, by default).

        ``folders``: the partition columns, which are not part of what the table declares. Unique keys are checked
        among the new rows; folders that stay are not read for it.
        """
        table = self.tables[name]
        loads, schemas = [], []

        def write(df: DataFrame) -> DataFrame:
            df = df.withColumns(folders or {})
            schemas.append(df.schema)
            loads.append(table.write(df))
            return table.pending(loads[0], df.schema).drop(*(folders or {}))

        if self.strict:
            Report(strict=True).written(name, rows, write)
        else:
            write(promised(name, rows))
        table.switch(loads, schemas[0], gone or (lambda f: True), note, head.number if head else 0)

    def _period(self, day: Column) -> Column:
        return day if self.period == "day" else F.trunc(day, self.period)

    def open_floor(self, as_of: datetime.date | None = None) -> str | None:
        """First day of the folders whose sales are still open; None: all are. Days after ``as_of`` (default: today) do not count.

        The newest sale is looked up in the newest folder of the fact.
        """
        fact = self.tables["fact_sales_order_detail"]
        head, last = fact.head(), as_of or datetime.date.today()
        periods = [d for f in head.folders if (d := f.values["sold_from"]) and d <= str(last)] if head else []
        if not periods:
            return None
        newest = fact.read(lambda f: f.values["sold_from"] == max(periods), head.number)
        day = F.date_sub(F.max(F.when(F.col(facts.DAY) <= F.lit(last), F.col(facts.DAY))), self.late_days)
        return str(newest.agg(self._period(day)).first()[0])

    def open_checkouts(self, floor: str | None) -> DataFrame:
        """Checkouts of the days that are still open, from all loads."""
        return self.events.read(lambda f: f.values["collection"] == staging.CHECKOUT and _is_open(f, "landed_from", floor))

    def late_checkouts(self, floor: str | None, loads: Collection[str]) -> DataFrame:
        """Checkouts of closed days, or of none, that arrived with these loads."""
        return self.events.read(lambda f: f.load in loads and f.values["collection"] == staging.CHECKOUT and not _is_open(f, "landed_from", floor))

    def update_sales(self, ref: References, places: DataFrame, as_of: datetime.date | None = None) -> None:
        """The sales of the open days again, from the log and the dimensions as they are now.

        Only folders of open days are read and replaced. As they hold all events of those days, an order is replaced as a
        whole. Lines that came too late go to the table ``late_sales``.
        """
        fact = self.tables["fact_sales_order_detail"]
        head = fact.head()
        floor = self.open_floor(as_of)
        lines = facts.kept_lines(staging.stg_sales_order_detail(self.open_checkouts(floor))).where(F.col("order_id").isNotNull())
        buyers = lines.where("user_id_db is not null").select("user_id_db").distinct()
        buyers = materialize(buyers.withColumn("user_bucket", self._bucket()), "buyers")
        versions = self._of_users(self.tables["dim_customer_scd"], buyers).where(F.col("scd_customer_key") != UNKNOWN_KEY)
        current = self._of_users(self.tables["dim_customer_current"], buyers)
        currency = self.read("dim_currency")
        # written before it is ranged into folders, which reads it twice
        rows = materialize(facts.sales_rows(
            lines, self.read("dim_store"), ref.countries, materialize(facts.daily_rates(self.read("fact_snapshot_exchange_rate"), currency), "daily_rates"),
            places, versions, materialize(current, "buyers_now"), currency,
        ), "open_sales")
        taken = {"taken": self.loads()}
        is_open = lambda f: _is_open(f, "sold_from", floor)
        if head is None:
            merged = facts.fact_sales_order_detail(rows)
        else:
            merged = facts.merged_orders(rows, fact.read(is_open, head.number).drop("sold_from"))
        self._publish("fact_sales_order_detail", merged, head, {"sold_from": self._period(F.col(facts.DAY))}, is_open, taken)
        new = self.fresh(self.late)
        if head is not None and new:
            late = facts.summed_lines(staging.stg_sales_order_detail(self.late_checkouts(floor, new)))
            self.late.append(late, taken)
        elif head is None:
            self.late.append(lines.drop("_head").limit(0), taken)

    def update(self, ref: References, as_of: datetime.date | None = None) -> None:
        """One run: everything that is new in the log goes into the tables; nothing happens before a first landing.

        What the run materializes is removed at its end.
        """
        if not self.loads():
            return
        with run_folder(self.spark):
            found: list[DataFrame] = []
            side_by_side(
                self.spark, self.update_customers, lambda: self.update_stores(ref), lambda: self.update_products(ref),
                lambda: found.append(self.update_places(ref)), lambda: self.update_money(ref),
            )
            self.update_sales(ref, found[0], as_of)

    def read(self, name: str) -> DataFrame:
        """A kept table, as committed last."""
        return self.tables[name].read().drop("user_bucket", "sold_from")

    def mart(self) -> DataFrame:
        """The flat report over the kept tables."""
        return mart.mart_sales_report(
            self.read("fact_sales_order_detail"), self.read("dim_date"), self.read("dim_product"), self.read("dim_store"),
            self.read("dim_location"), self.read("dim_customer_scd"), self.read("dim_currency"),
        )


def _is_open(folder: Folder, column: str, floor: str | None) -> bool:
    first = folder.values[column]
    return floor is None or (first is not None and first >= floor)
