"""Ordered scans, change intervals, versions and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY
from ..operators import intervals, rates, scans
from ..plans import dims, facts, staging
from ..plans import testdata as td
from ..session import materialize
from . import fragments as q
from .registry import query


def _runs(spark, folder):
    return intervals.change_intervals(
        td.browsing(spark, folder), "user_id_db", "email_address", "local_datetime", "utc_timestamp"
    )


@query("""SELECT event_id, last_value(s IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled,
  CAST(min(CASE WHEN s IS NOT NULL THEN event_id END) OVER (PARTITION BY user_id) AS BIGINT) AS first_known
  FROM (SELECT *, CASE WHEN event_type NOT IN ('signup', 'error') THEN event_type END AS s FROM events)""")
def forward_fill(spark, folder):
    """Last known state, and the first event with one."""
    seen = td.browsing(spark, folder)
    first = seen.where("email_address is not null").groupBy("user_id_db").agg(
        F.min("event_id").alias("first_known")
    )
    filled = scans.fill_forward(
        seen, ["user_id_db"], ["local_datetime", "event_id"], "email_address", "filled"
    )
    return filled.join(first, "user_id_db", "left").select("event_id", "filled", "first_known")


@query(f"""SELECT event_id, {q.ts('lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)')} AS next_seen FROM events""")
def next_seen(spark, folder):
    """W7."""
    return scans.next_value(
        td.browsing(spark, folder), ["user_id_db"], ["local_datetime", "event_id"],
        "local_datetime", "next_seen",
    ).select("event_id", "next_seen")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
  row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS row_num
  FROM lineitem""")
def global_row_number(spark, folder):
    """W10."""
    return scans.global_row_number(
        td.table(spark, folder, "lineitem").select(
            "l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
        ),
        ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"],
    ).drop("l_shipdate")


@query("""SELECT event_id, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS row_num FROM events""")
def day_row_number(spark, folder):
    """W10 within the day."""
    seen = td.browsing(spark, folder).withColumn("day", F.to_date("local_datetime"))
    return scans.day_row_number(seen, "day", ["local_datetime", "event_id"]).select("event_id", "row_num")


@query(f"""WITH {q.intervals(q.BROWSING)}
  SELECT k AS user_id_db, s AS email_address, grp AS group_number, {q.ts('start_at')} AS start_at,
    {q.ts('start_utc')} AS start_utc FROM runs""")
def email_change_intervals(spark, folder):
    """M1 with W5, W6, A2 over the event stream."""
    runs = _runs(spark, folder)
    return runs.withColumn("start_utc", F.col("start_utc").cast("timestamp_ntz"))


@query(f"""WITH {q.intervals(q.BROWSING.replace('ts AS t,', "date_trunc('hour', ts) AS t,"))}
  SELECT k AS user_id_db, s AS email_address, grp AS group_number, {q.ts('start_at')} AS start_at,
    {q.ts('start_utc')} AS start_utc FROM runs""")
def email_change_ties(spark, folder):
    """M1 with local times cut to the hour: several states at one time, ranked by UTC time."""
    seen = td.browsing(spark, folder).withColumn("local_datetime", F.date_trunc("hour", "local_datetime").cast("timestamp_ntz"))
    runs = intervals.change_intervals(seen, "user_id_db", "email_address", "local_datetime", "utc_timestamp")
    return runs.withColumn("start_utc", F.col("start_utc").cast("timestamp_ntz"))


@query(f"""WITH {q.BUYERS}, {q.intervals(q.BUYING)}
  SELECT k AS user_id_db, s AS email_address, grp AS group_user_email, {q.ts('start_at')} AS start_local_datetime,
    CAST(epoch(start_utc) AS BIGINT) AS start_epoch FROM runs""")
def stg_user_email(spark, folder):
    """M1 as staging table over raw page views."""
    staged = staging.stg_user_email_by_local_datetime(td.visits(spark, folder))
    return staged.withColumn("start_epoch", F.unix_seconds("start_utc_timestamp")).drop("start_utc_timestamp")


@query(f"""WITH {q.BUYERS}, {q.intervals(q.BUYING)}
  SELECT version_key AS scd_customer_key, k AS user_id_db, coalesce(s, 'Unknown') AS email_address,
    CAST(CAST(start_at AS DATE) AS VARCHAR) AS start_local_date, CAST(CAST(end_at AS DATE) AS VARCHAR) AS end_local_date,
    {q.ts('start_at')} AS start_local_datetime, {q.ts('end_at')} AS end_local_datetime, is_current,
    s IS NOT NULL AS has_email_info FROM versions
  UNION ALL SELECT -1, '-1', 'Unknown', '1900-01-01', '9999-12-31', '1900-01-01 00:00:00.000000',
    '9999-12-31 00:00:00.000000', FALSE, FALSE""")
def dim_customer_scd(spark, folder):
    """M2, W7, F15, O5."""
    staged = staging.stg_user_email_by_local_datetime(td.visits(spark, folder))
    return dims.without_audit(dims.dim_customer_scd(staged))


_SCD_SQL = f"""WITH {q.BUYERS}, {q.intervals(q.BUYING)}
  SELECT version_key AS scd_customer_key, k AS user_id_db, coalesce(s, 'Unknown') AS email_address,
    {q.ts('start_at')} AS start_local_datetime, {q.ts('end_at')} AS end_local_datetime, is_current FROM versions
  UNION ALL SELECT -1, '-1', 'Unknown', '1900-01-01 00:00:00.000000', '9999-12-31 00:00:00.000000', FALSE"""


@query(_SCD_SQL)
def scd_upsert_late(spark, folder):
    """M2: a fifth of the page views arrives late; the upsert gives what a full build gives, one current row per user."""
    visits = td.visits(spark, folder)
    known = visits.where(F.col("_id").cast("bigint") % 5 != 0)
    target = materialize(dims.dim_customer_scd(staging.stg_user_email_by_local_datetime(known)), "target")
    scd = dims.dim_customer_scd(staging.stg_user_email_by_local_datetime(visits), target=target)
    return scd.select("scd_customer_key", "user_id_db", "email_address", "start_local_datetime", "end_local_datetime", "is_current")


@query(f"""WITH {q.BUYERS}, {q.intervals(q.BUYING)},
  last_known AS (SELECT DISTINCT k, last_value(s IGNORE NULLS) OVER (PARTITION BY k ORDER BY start_at, start_utc, grp
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS s,
    first_value(CAST(start_at AS DATE)) OVER (PARTITION BY k ORDER BY start_at) AS active FROM runs)
  SELECT {q.key('k')} AS customer_key, k AS user_id_db, coalesce(s, 'Unknown') AS email_address,
    CAST(active AS VARCHAR) AS active_date, s IS NOT NULL AS has_email_info FROM last_known
  UNION ALL SELECT -1, '-1', 'Unknown', '1900-01-01', FALSE""")
def dim_customer_current(spark, folder):
    """M3, W3, W8, W9."""
    staged = staging.stg_user_email_by_local_datetime(td.visits(spark, folder))
    return dims.without_audit(dims.dim_customer_current(staged))


@query(f"""WITH {q.intervals(q.BROWSING + " WHERE event_type <> 'purchase'")}
  SELECT event_id, CAST(value AS DOUBLE) AS value, s AS state, {q.ts('start_at')} AS since FROM events
  LEFT JOIN versions ON k = CAST(user_id AS VARCHAR) AND ts >= start_at AND ts < end_at
  WHERE event_type = 'purchase'""")
def scd_point_in_time(spark, folder):
    """Purchases against the versions built from all other events."""
    seen = td.browsing(spark, folder)
    others = seen.where("event_type <> 'purchase'")
    runs = intervals.change_intervals(
        others, "user_id_db", "email_address", "local_datetime", "utc_timestamp"
    ).withColumnRenamed("email_address", "state")
    versions = intervals.type2_rows(runs, "user_id_db", "state", "start_at", "start_utc").select(
        "user_id_db", "state", F.col("start_at").alias("since"), F.col("start_at"), F.col("_end").alias("end_at")
    )
    purchases = seen.where("event_type = 'purchase'").select(
        "event_id", "user_id_db", "local_datetime", "value"
    )
    return intervals.version_at(
        purchases, versions, "user_id_db", "local_datetime", ["state", "since"], "start_at", "end_at"
    ).select("event_id", "value", "state", "since")


def _calendar(spark, folder):
    first, last = td.calendar_bounds(spark, folder)
    return staging.stg_generate_date(spark, last, first)


@query(f"""WITH {q.DENSE_RATES}
  SELECT date_key, CAST(day AS VARCHAR) AS full_date, code AS from_currency_code, 'USD' AS to_currency_code,
    CAST(rate AS DOUBLE) AS exchange_rate FROM dense""")
def fx_densify_ffill(spark, folder):
    """M10, J11, J12, W2, A3, P14."""
    return rates.dense_rates(
        td.rates(spark, folder), _calendar(spark, folder), td.currencies(spark, folder)
    )


_GAPS = q.DENSE_RATES.replace(
    q.CALENDAR, q.CALENDAR.replace("calendar AS", "every_day AS") + ", calendar AS (SELECT day FROM every_day WHERE dayofweek(day) <> 0)"
)


@query(f"""WITH {_GAPS}
  SELECT date_key, CAST(day AS VARCHAR) AS full_date, code AS from_currency_code, 'USD' AS to_currency_code,
    CAST(rate AS DOUBLE) AS exchange_rate FROM dense""")
def fx_densify_gaps(spark, folder):
    """A calendar without Sundays, and rates with date keys that name no day."""
    known = td.rates(spark, folder)
    bad = known.withColumn("date_key", F.lit(20191399).cast(known.schema["date_key"].dataType))
    days = _calendar(spark, folder).where(F.dayofweek("full_date") != 1)
    return rates.dense_rates(known.unionByName(bad), days, td.currencies(spark, folder))


@query(f"""WITH {q.DENSE_RATES}
  SELECT {q.key('date_key', 'code', "'USD'")} AS exchange_rate_key, date_key, CAST(day AS VARCHAR) AS full_date,
    {q.key('code')} AS from_currency_key, {q.key("'USD'")} AS to_currency_key, CAST(rate AS DOUBLE) AS exchange_rate
  FROM dense""")
def fact_exchange_rate(spark, folder):
    """The rate fact: M10, F9, P15."""
    return dims.without_audit(
        facts.fact_snapshot_exchange_rate(
            _calendar(spark, folder), dims.dim_currency(td.currencies(spark, folder)), td.rates(spark, folder)
        )
    )


@query(f"""WITH {q.DENSE_RATES}
  SELECT date_key, code AS from_currency_code, CAST(rate AS DOUBLE) AS exchange_rate FROM dense""")
def daily_rates(spark, folder):
    """J13."""
    currency_dim = dims.dim_currency(td.currencies(spark, folder))
    fact = facts.fact_snapshot_exchange_rate(_calendar(spark, folder), currency_dim, td.rates(spark, folder))
    return facts.daily_rates(fact, currency_dim.where(F.col("currency_key") != UNKNOWN_KEY))
