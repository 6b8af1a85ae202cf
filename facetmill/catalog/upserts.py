"""Upserts between two states of a table that business dates tell apart."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions.audit import AUDIT
from ..operators import joins, upsert
from ..plans import facts
from ..plans import testdata as td
from .registry import query

# The target holds what was known at the start of 1999.
AS_OF = "1999-01-01"
ATTRIBUTES = ["n_orders", "last_order", "segment"]

_STATES = f"""
old AS (SELECT c_custkey, count(*) AS n_orders, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order,
    CAST(NULL AS VARCHAR) AS segment, 'old' AS created_by, 'old' AS updated_by
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < DATE '{AS_OF}' GROUP BY 1),
new AS (SELECT c_custkey, count(*) AS n_orders, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order,
    CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= DATE '1996-01-01' GROUP BY ALL)"""


def _state(spark, folder, condition, segment):
    orders = td.table(spark, folder, "orders").where(condition)
    customers = td.table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.to_date(F.max("o_orderdate")).alias("last_order"),
        F.max(segment).cast("string").alias("segment"),
    )


def _states(spark, folder):
    """The table as it was, with audit columns, and the newly computed rows."""
    old = _state(spark, folder, F.col("o_orderdate") < F.lit(AS_OF).cast("timestamp_ntz"), F.lit(None))
    stamped = old.select(
        "*",
        *[F.lit("2000-01-01").cast("timestamp").alias(c) if c.endswith("at") else F.lit("old").alias(c) for c in AUDIT],
    )
    new = _state(
        spark, folder, F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")),
    )
    return stamped, new


def _who(df):
    """Authors as 'old' or 'new', times left out."""
    return df.drop("created_at", "updated_at").withColumns(
        {c: F.when(F.col(c) == "old", "old").otherwise("new") for c in ("created_by", "updated_by")}
    )


@query(f"""WITH {_STATES} SELECT n.*, coalesce(o.created_by, 'new') AS created_by, 'new' AS updated_by
  FROM new n LEFT JOIN old o ON n.c_custkey = o.c_custkey WHERE o.c_custkey IS NULL OR n.n_orders <> o.n_orders
  OR n.last_order <> o.last_order OR n.segment IS DISTINCT FROM o.segment""")
def upsert_changed_only(spark, folder):
    """Only real changes are written."""
    old, new = _states(spark, folder)
    return _who(upsert.changed_or_new(new, old, ["c_custkey"], ATTRIBUTES))


@query(f"""WITH {_STATES} SELECT n.*, coalesce(o.created_by, 'new') AS created_by,
  CASE WHEN o.c_custkey IS NULL OR n.n_orders <> o.n_orders OR n.last_order <> o.last_order
    OR n.segment IS DISTINCT FROM o.segment THEN 'new' ELSE o.updated_by END AS updated_by
  FROM new n LEFT JOIN old o ON n.c_custkey = o.c_custkey""")
def upsert_carried_audit(spark, folder):
    """All rows, audit columns carried."""
    old, new = _states(spark, folder)
    return _who(upsert.with_carried_audit(new, old, ["c_custkey"], ATTRIBUTES))


@query(f"""WITH {_STATES} SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
  CASE WHEN n.c_custkey IS NOT NULL THEN n.n_orders ELSE o.n_orders END AS n_orders,
  coalesce(o.last_order, n.last_order) AS last_order,
  CASE WHEN n.c_custkey IS NOT NULL THEN n.segment ELSE o.segment END AS segment
  FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey""")
def upsert_partial_columns(spark, folder):
    """M8: matched rows change in two of three columns."""
    old, new = _states(spark, folder)
    return upsert.merge_columns(old.drop(*AUDIT), new, ["c_custkey"], ["n_orders", "segment"])


@query(f"""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
  WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < DATE '{AS_OF}')""")
def incremental_highwater(spark, folder):
    """M4, A4."""
    days = td.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return upsert.newer_than_target(days, days.where(F.col("day") < F.lit(AS_OF).cast("date")), "day")


_LATE = f"""
source AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS total, o_orderpriority AS priority FROM orders),
target AS (SELECT o_orderkey, day, 0 AS total, 'old' AS priority, 'old' AS updated_by FROM source
  WHERE day < DATE '{AS_OF}' AND priority <> '1-URGENT'),
late AS (SELECT * FROM source WHERE day >= (SELECT max(day) - 7 FROM target)),
changes AS (SELECT l.o_orderkey, l.day, l.total, coalesce(t.priority, l.priority) AS priority, 'new' AS updated_by
  FROM late l LEFT JOIN target t ON l.o_orderkey = t.o_orderkey)"""


def _late(spark, folder):
    source = td.table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
    )
    target = source.where(
        (F.col("day") < F.lit(AS_OF).cast("date")) & (F.col("priority") != "1-URGENT")
    ).select(
        "o_orderkey", "day", F.lit(0.0).alias("total"), F.lit("old").alias("priority"),
        F.lit("2000-01-01").cast("timestamp").alias("updated_at"), F.lit("old").alias("updated_by"),
    )
    return source, target


@query(f"""WITH {_LATE} SELECT o_orderkey, CAST(day AS VARCHAR) AS day, CAST(total AS DOUBLE) AS total, priority, updated_by FROM changes""")
def late_lookback_7d(spark, folder):
    """Lines within seven days of the newest known one."""
    source, target = _late(spark, folder)
    late = upsert.reprocess_late(source, target, ["o_orderkey"], ["total"], "day")
    return late.drop("updated_at").withColumn("updated_by", F.when(F.col("updated_by") == "old", "old").otherwise("new"))


@query(f"""WITH {_LATE} SELECT coalesce(t.o_orderkey, c.o_orderkey) AS o_orderkey, CAST(coalesce(t.day, c.day) AS VARCHAR) AS day,
  CAST(coalesce(c.total, t.total) AS DOUBLE) AS total, coalesce(t.priority, c.priority) AS priority
  FROM target t FULL JOIN changes c ON t.o_orderkey = c.o_orderkey""")
def late_merge(spark, folder):
    """M7 with M8: the whole table after the late window was merged."""
    source, target = _late(spark, folder)
    late = upsert.reprocess_late(source, target, ["o_orderkey"], ["total"], "day")
    return upsert.merge_columns(target, late, ["o_orderkey"], ["total"]).drop("updated_at", "updated_by")


@query(f"""WITH {_LATE}, touched AS (SELECT * FROM target WHERE day IN (SELECT day FROM changes))
  SELECT coalesce(t.o_orderkey, c.o_orderkey) AS o_orderkey, CAST(coalesce(t.day, c.day) AS VARCHAR) AS day,
  CAST(coalesce(c.total, t.total) AS DOUBLE) AS total FROM touched t FULL JOIN changes c ON t.o_orderkey = c.o_orderkey""")
def late_merge_touched_days(spark, folder):
    """M7, M8 on the touched date folders only."""
    source, target = _late(spark, folder)
    late = upsert.reprocess_late(source, target, ["o_orderkey"], ["total"], "day")
    return upsert.merge_touched(target, late, ["o_orderkey"], ["total"], "day").select("o_orderkey", "day", "total")


# The fact as of AS_OF: order lines, one of them dated far in the future by its client. Then every line arrives again with a higher price.
_SALES = f"""
line AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS day, l_linenumber, l_extendedprice AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
fact AS (SELECT order_id, CASE WHEN order_id = (SELECT min(order_id) FROM line WHERE day < DATE '1998-01-01') THEN DATE '2099-01-01' ELSE day END AS day,
  l_linenumber, price FROM line WHERE day < DATE '{AS_OF}'),
floor AS (SELECT max(day) - 7 AS floor FROM fact WHERE day <= DATE '{AS_OF}')"""


def _sales(spark, folder):
    orders = td.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("local_order_date"))
    lines = td.table(spark, folder, "lineitem")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("order_id"), "local_order_date", "l_linenumber", F.col("l_extendedprice").alias("price")
    )
    as_of = F.lit(AS_OF).cast("date")
    first = rows.where(F.col("local_order_date") < F.lit("1998-01-01").cast("date")).agg(F.min("order_id")).scalar()
    day = F.when(F.col("order_id") == first, F.lit("2099-01-01").cast("date")).otherwise(F.col("local_order_date"))
    target = rows.where(F.col("local_order_date") < as_of).withColumn("local_order_date", day)

    def keyed(df):
        return df.withColumn("sales_key", F.xxhash64("order_id", "l_linenumber", "price"))

    stamp = [F.lit("2000-01-01").cast("timestamp").alias(c) if c.endswith("at") else F.lit("old").alias(c) for c in AUDIT]
    return keyed(rows.withColumn("price", F.col("price") + 1)), keyed(target).select("*", *stamp)


@query(f"""WITH {_SALES} SELECT order_id, CAST(day AS VARCHAR) AS local_order_date, l_linenumber, CAST(price AS DOUBLE) AS price, 'old' AS created_by
    FROM fact, floor WHERE day < floor OR order_id NOT IN (SELECT order_id FROM line, floor WHERE line.day >= floor)
  UNION ALL SELECT order_id, CAST(day AS VARCHAR), l_linenumber, CAST(price + 1 AS DOUBLE), 'new' FROM line, floor WHERE day >= floor""")
def fact_upsert_corrected(spark, folder):
    """M7, M8: corrected prices replace the lines of the last week; a date in the future does not close the window."""
    rows, target = _sales(spark, folder)
    merged = facts.fact_sales_order_detail(rows, target, as_of=datetime.date.fromisoformat(AS_OF))
    who = F.when(F.col("created_by") == "old", "old").otherwise("new").alias("created_by")
    return merged.select("order_id", "local_order_date", "l_linenumber", "price", who)


@query(f"""WITH {_SALES} SELECT order_id, CAST(day AS VARCHAR) AS local_order_date, l_linenumber FROM line, floor WHERE day < floor""")
def fact_upsert_late(spark, folder):
    """M7: the arriving lines that are too old to be taken."""
    rows, target = _sales(spark, folder)
    return facts.late_rejects(rows, target, as_of=datetime.date.fromisoformat(AS_OF)).select("order_id", "local_order_date", "l_linenumber")


@query("""SELECT l_orderkey, l_linenumber, c_name AS customer, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE o_custkey END AS buyer
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 3) ON c_custkey =
    CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE o_custkey END""")
def spread_lookup_guests(spark, folder):
    """A shuffle lookup with guests (NULL), a hot buyer and buyers that the dimension lacks."""
    orders = td.table(spark, folder, "orders")
    buyer = F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(F.col("o_custkey"))
    lines = td.table(spark, folder, "lineitem").join(orders.select("o_orderkey", buyer.cast("bigint").alias("buyer")), F.col("l_orderkey") == F.col("o_orderkey"))
    known = td.table(spark, folder, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").alias("buyer"), F.col("c_name").alias("customer"))
    spread = joins.lookup_join(lines.select("l_orderkey", "l_linenumber", "buyer"), known, ["buyer"], ["l_orderkey", "l_linenumber"], max_bytes=0, hot_rows=500)
    return spread.select("l_orderkey", "l_linenumber", "customer", "buyer")
