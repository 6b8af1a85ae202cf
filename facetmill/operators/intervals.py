"""Histories of a changing attribute: change intervals, type-2 and type-1 dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.audit import with_audit
from ..functions.dates import OPEN_END, OPEN_START, hour_slice, open_end
from ..functions.keys import UNKNOWN_KEY, surrogate_key
from .distincts import with_default_member
from .scans import BEFORE_HERE, latest_at, next_value, slice_where_hot


def change_intervals(
    events: DataFrame, key: str, state: str, at: str, utc: str, hot: Sequence | None = None
) -> DataFrame:
    """One row per key and run of equal state (M1, with W1 W4 W5 W6 A2 inside).

    A NULL state repeats the last known one; before the first known state it
    is a state of its own, returned as NULL. Columns: the key, the state,
    ``group_number`` (how many changes came before, equal times counted
    together), ``start_at`` and ``start_utc``.

    Rows of equal time are ranked by ``utc``, then by state with NULL first.

    Copies are folded before the shuffle. The history is then read in hour
    slices: a slice knows its own changes, and gets from the per-slice summary
    the state it starts with and the number of changes before it. Where the ``hot`` keys are known, only those are
    sliced, see ``hot_values``; without any there is one window by the key.
    """
    rows = (
        events.where(F.col(key).isNotNull() & F.col(at).isNotNull())
        .select(key, at, state, F.col(utc).alias("_utc"))
        .distinct()
        .withColumn("_slice", slice_where_hot(key, hour_slice(at), hot))
    )
    whole = hot is not None and not hot
    by = [key] if whole else [key, "_slice"]
    order = [F.col(at), F.col("_utc"), F.col(state).asc_nulls_first()]
    inside = Window.partitionBy(*by).orderBy(*order)
    by_time = Window.partitionBy(*by).orderBy(at)
    across = Window.partitionBy(key).orderBy("_slice")

    known = F.col(state).isNotNull()
    last_before = F.last(state, ignorenulls=True).over(inside.rowsBetween(*BEFORE_HERE))
    rows = rows.withColumns(
        {"_known": last_before, "_nth": F.row_number().over(inside)}
    ).withColumns(
        {
            "_opens": known & F.col("_known").isNull(),
            "_changed": F.coalesce(
                known & (F.col(state) != F.col("_known")), F.lit(False)
            ).cast("int"),
        }
    )
    opening = F.when(F.col("_opens"), F.struct(F.col(state).alias("state"), F.col("_nth").alias("nth")))
    # (time, utc) ranks the known rows; on a tie the greater state comes last, as above.
    last_known = F.max(F.when(known, F.struct(at, "_utc", F.col(state).alias("state"))))
    slices = (
        rows.groupBy(key, "_slice")
        .agg(
            F.max(opening).alias("_opening"),
            last_known["state"].alias("_closing"),
            F.sum("_changed").alias("_inner"),
        )
        .withColumn("_carried", F.last("_closing", ignorenulls=True).over(across.rowsBetween(*BEFORE_HERE)))
        .withColumn(
            "_opening_changed",
            F.when(F.col("_opening").isNull(), 0)
            .when(F.col("_carried").isNotNull(), (F.col("_opening.state") != F.col("_carried")).cast("int"))
            # no known state so far: a change only if some row came before
            .when((F.row_number().over(across) > 1) | (F.col("_opening.nth") > 1), 1)
            .otherwise(0),
        )
        .withColumn(
            "_before",
            F.coalesce(
                F.sum(F.col("_inner") + F.col("_opening_changed")).over(across.rowsBetween(*BEFORE_HERE)),
                F.lit(0),
            ),
        )
        .select(key, "_slice", "_carried", "_opening_changed", "_before")
    )
    if whole:
        # nothing is carried in, and the first known state is a change if some row came before
        joined = rows.withColumns(
            {
                "_carried": F.lit(None).cast(rows.schema[state].dataType),
                "_opening_changed": (F.col("_nth") > 1).cast("int"),
                "_before": F.lit(0).cast("bigint"),
            }
        )
    else:
        joined = rows.join(slices, [key, "_slice"])
    flag = F.when(F.col("_opens"), F.col("_opening_changed")).otherwise(F.col("_changed"))
    return (
        joined.withColumn("_flag", flag)
        .withColumn("group_number", F.col("_before") + F.sum("_flag").over(by_time))
        .groupBy(
            key,
            F.coalesce(state, "_known", "_carried").alias(state),
            "group_number",
        )
        .agg(F.min(at).alias("start_at"), F.min("_utc").alias("start_utc"))
    )


def type2_rows(
    intervals: DataFrame, key: str, state: str, start: str, utc: str, hot: Sequence | None = None
) -> DataFrame:
    """Half-open validity ``[start, end)`` for each interval (M2 with W7).

    Expects the columns of :func:`change_intervals`. The end is the key's next start; the last interval stays open until
    9999-12-31 and is marked current.
    """
    ended = next_value(
        # NULL text sorts first, as in the interval builder
        intervals.withColumn("_state", F.coalesce(F.col(state), F.lit(""))),
        [key], [start, utc, "group_number", "_state"], start, "_end", hot=hot,
    ).drop("_state")
    return ended.withColumn("is_current", F.col("_end").isNull()).withColumn(
        "_end", F.coalesce("_end", open_end())
    )


def customer_scd(intervals: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """Type-2 customer dimension without the default member or audit columns."""
    rows = type2_rows(
        intervals, "user_id_db", "email_address", "start_local_datetime", "start_utc_timestamp", hot
    )
    return rows.select(
        surrogate_key(
            "user_id_db",
            "start_local_datetime",
            F.coalesce("email_address", F.lit("")),
        ).alias("scd_customer_key"),
        "user_id_db",
        F.coalesce("email_address", F.lit("Unknown")).alias("email_address"),
        F.to_date("start_local_datetime").alias("start_local_date"),
        F.to_date("_end").alias("end_local_date"),
        "start_local_datetime",
        F.col("_end").alias("end_local_datetime"),
        "is_current",
        F.col("email_address").isNotNull().alias("has_email_info"),
    )


SCD_MEMBER = {
    "scd_customer_key": UNKNOWN_KEY, "user_id_db": "-1", "email_address": "Unknown",
    "start_local_date": OPEN_START[:10], "end_local_date": OPEN_END[:10],
    "start_local_datetime": OPEN_START, "end_local_datetime": OPEN_END,
    "is_current": False, "has_email_info": False,
}


def customer_current(intervals: DataFrame) -> DataFrame:
    """Type-1 customer dimension (M3): latest known email and first active day.

    The forward fill, last and first value over a whole user (W3, W8, W9) come
    down to one aggregate, which combines before the shuffle.
    """
    known = F.when(
        F.col("email_address").isNotNull(),
        F.struct("start_local_datetime", "start_utc_timestamp", "group_number", "email_address"),
    )
    return intervals.groupBy("user_id_db").agg(
        F.max(known)["email_address"].alias("_email"),
        F.to_date(F.min("start_local_datetime")).alias("active_date"),
    ).select(
        surrogate_key("user_id_db").alias("customer_key"),
        "user_id_db",
        F.coalesce("_email", F.lit("Unknown")).alias("email_address"),
        "active_date",
        F.col("_email").isNotNull().alias("has_email_info"),
    )


CURRENT_MEMBER = {
    "customer_key": UNKNOWN_KEY, "user_id_db": "-1", "email_address": "Unknown",
    "active_date": OPEN_START[:10], "has_email_info": False,
}


def with_scd_member(scd: DataFrame) -> DataFrame:
    return with_audit(with_default_member(scd, SCD_MEMBER))


def with_current_member(current: DataFrame) -> DataFrame:
    return with_audit(with_default_member(current, CURRENT_MEMBER))


def version_at(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    carry: list[str],
    start: str = "start_local_datetime",
    end: str = "end_local_datetime",
    ties: list[str] | None = None,
    hot: Sequence | None = None,
) -> DataFrame:
    """The version valid at each fact's time, ``start <= at < end``.

    Versions of one key do not overlap, thus only the one that started last
    can hold. Facts before the first start, or without a key, get NULL.
    """
    payload = [end] + [c for c in carry if c != end]
    found = latest_at(
        facts, versions, [key], at, start, payload, ties=ties if ties is not None else [end], hot=hot
    )
    valid = F.col(at) < F.col(end)
    out = found.withColumns({c: F.when(valid, F.col(c)) for c in payload})
    return out if end in carry else out.drop(end)
