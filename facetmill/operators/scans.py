"""Ordered scans over one key's history that survive a key with a third of all rows.

A window partitioned by the key alone puts a whole key into one task. These
operators cut each history into slices by a monotone expression of the order
column (a calendar hour, an address prefix). Rows are shuffled by
``(key, slice)``; only one summary row per slice goes through the window
partitioned by the key, so that window is bounded by the calendar (or the
address space), not by the data. Slice results are then completed with what
the summary carries in from the neighbouring slices.

Keys must not be NULL; callers set such rows aside first.

Slices cost shuffles of their own. Where the caller knows the hot keys (:func:`hot_values`) only those are cut, and
without any the history is one window by the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import hour_slice
from ..session import materialize

BEFORE_HERE = (Window.unboundedPreceding, -1)
UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
#: A key with more rows than this is cut into slices where hot keys are known.
HOT_ROWS = 1_000_000
#: Up to so many hot keys are named; beyond that every key is cut.
NAMED_KEYS = 10_000


def hot_values(rows: DataFrame, key: str, hot_rows: int | None = None) -> list | None:
    """Keys with more than ``hot_rows`` rows, or None if they are too many to be named. Pass a written table: it is read for it."""
    counts = rows.select(key).dropna().groupBy(key).count()
    many = counts.where(F.col("count") > (HOT_ROWS if hot_rows is None else hot_rows))
    values = [r[0] for r in many.limit(NAMED_KEYS + 1).collect()]
    return values if len(values) <= NAMED_KEYS else None


def slice_where_hot(key: str, slice_by: Column, hot: Sequence | None) -> Column:
    """The slice of rows of hot keys; those of other keys are in one slice. Without a list every key is cut."""
    cut = whole_slice(slice_by)
    return cut if hot is None else F.when(F.col(key).isin(list(hot)), cut).otherwise(0)


def whole_slice(slice_by: Column) -> Column:
    """The slice, never NULL: rows without an order value come first, as in the order itself.

    Being free of NULLs, a join on it adds no filter to one side only, and both
    sides can share one shuffle.
    """
    return F.coalesce(slice_by, F.lit(-(2**31)))


def _rows_and_windows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column):
    rows = df.withColumn("_slice", whole_slice(slice_by))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy("_slice") if keys else Window.orderBy("_slice")
    return rows, inside, across


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    slice_by: Column | None = None,
) -> DataFrame:
    """Last non-null ``value`` at or before each row.

    ``order`` must rank rows of a key without ties in ``value``; its first
    entry is sliced by the hour unless ``slice_by`` says otherwise.
    """
    slice_by = hour_slice(order[0]) if slice_by is None else slice_by
    rows, inside, across = _rows_and_windows(df, keys, [F.col(o) for o in order], slice_by)
    at = F.when(F.col(value).isNotNull(), F.struct(*order))
    carried = (
        rows.groupBy(*keys, "_slice")
        .agg(F.max_by(F.col(value), at).alias("_tail"))
        .select(
            *keys,
            "_slice",
            F.last("_tail", ignorenulls=True).over(across.rowsBetween(*BEFORE_HERE)).alias("_carried"),
        )
    )
    here = F.last(value, ignorenulls=True).over(inside.rowsBetween(*UP_TO_HERE))
    return (
        rows.join(carried, [*keys, "_slice"])
        .withColumn(out, F.coalesce(here, "_carried"))
        .drop("_slice", "_carried")
    )


def next_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    slice_by: Column | None = None,
    hot: Sequence | None = None,
) -> DataFrame:
    """``value`` of the key's next row, NULL on its last row (W7). ``value`` must not be NULL.

    ``hot``: the hot keys, if they are known; for a single key column.
    """
    if hot is not None and not hot:
        return df.withColumn(out, F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)))
    slice_by = hour_slice(order[0]) if slice_by is None else slice_by
    if hot:
        slice_by = slice_where_hot(keys[0], slice_by, hot)
    rows, inside, across = _rows_and_windows(df, keys, [F.col(o) for o in order], slice_by)
    following = (
        rows.groupBy(*keys, "_slice")
        .agg(F.min_by(F.col(value), F.struct(*order)).alias("_head"))
        .select(*keys, "_slice", F.lead("_head").over(across).alias("_following"))
    )
    return (
        rows.join(following, [*keys, "_slice"])
        .withColumn(out, F.coalesce(F.lead(value).over(inside), "_following"))
        .drop("_slice", "_following")
    )


def latest_at(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: str,
    right_at: str,
    carry: Sequence[str],
    ties: Sequence[str] = (),
    slice_of=hour_slice,
    hot: Sequence | None = None,
) -> DataFrame:
    """For each left row the columns ``carry`` of the latest right row of its key at or before it.

    A merge of both sides followed by a forward fill: the work is linear in
    the rows, no pairs are formed, and a hot key is spread over its slices.
    ``ties`` ranks right rows that start together; the last one wins. Left
    rows with a NULL key or time match nothing and skip the shuffle. ``hot``: the hot keys of both sides, if they are
    known; for a single key column.
    """
    left_cols = left.columns
    matchable = F.col(left_at).isNotNull()
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    usable = F.col(right_at).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()

    # ``_rank`` is NULL on left rows only; ``_side`` puts a start before the rows at that time.
    probes = left.where(matchable).select(
        *left_cols,
        F.col(left_at).alias("_at"),
        F.lit(1).alias("_side"),
        slice_where_hot(keys[0], slice_of(left_at), hot).alias("_slice"),
    )
    starts = right.where(usable).select(
        *keys,
        F.col(right_at).alias("_at"),
        F.lit(0).alias("_side"),
        slice_where_hot(keys[0], slice_of(right_at), hot).alias("_slice"),
        F.struct(F.lit(0).alias("_"), *ties).alias("_rank"),
        F.struct(*carry).alias("_payload"),
    )
    rows = probes.unionByName(starts, allowMissingColumns=True)
    carry_types = right.select(*carry).schema
    unmatched = left.where(~F.coalesce(matchable, F.lit(False))).select(
        *left_cols, *[F.lit(None).cast(f.dataType).alias(f.name) for f in carry_types]
    )

    def matched(rows: DataFrame, found: Column) -> DataFrame:
        out = rows.withColumn("_found", found).where("_side = 1")
        return out.select(*left_cols, *[F.col(f"_found.{c}").alias(c) for c in carry]).unionByName(unmatched)

    def here(*by: str) -> Column:
        inside = Window.partitionBy(*by).orderBy("_at", "_side", "_rank")
        return F.last("_payload", ignorenulls=True).over(inside.rowsBetween(*UP_TO_HERE))

    if hot is not None and not hot:
        return matched(rows.drop("_slice"), here(*keys))
    # One row per slice of either side: where something is wanted, what a slice ends with.
    wanted = probes.select(*keys, "_slice").distinct().withColumn("_wanted", F.lit(True))
    closing = starts.groupBy(*keys, "_slice").agg(
        F.max_by("_payload", F.struct("_at", "_rank")).alias("_closing")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        wanted.unionByName(closing, allowMissingColumns=True)
        .withColumn("_carried", F.last("_closing", ignorenulls=True).over(earlier))
        .where("_wanted")
        .select(*keys, "_slice", "_carried")
    )
    # slices of the right side in which nothing is wanted end here
    return matched(rows.join(carried, [*keys, "_slice"]), F.coalesce(here(*keys, "_slice"), "_carried"))


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "row_num") -> DataFrame:
    """Position of every row in one global order, from 1.

    Rows are range-partitioned on the order columns and written once, so that
    the partition number is fixed even when an executor is lost. Each partition
    is numbered by itself and shifted by the row count of those before it.
    """
    ranged = materialize(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    shift = (
        ranged.groupBy("_part")
        .count()
        .select(
            "_part",
            F.coalesce(
                F.sum("count").over(Window.orderBy("_part").rowsBetween(*BEFORE_HERE)), F.lit(0)
            ).alias("_shift"),
        )
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        ranged.join(shift, "_part")
        .withColumn(out, F.row_number().over(inside) + F.col("_shift"))
        .drop("_part", "_shift")
    )


def day_row_number(df: DataFrame, day: str, order: Sequence[str], out: str = "row_num") -> DataFrame:
    """Position within the day: the global position less that of the day's first row.

    Rows are ranged on day and order, so an hour of the whole log is as many tasks as it has rows for; days have one summary row each.
    """
    numbered = materialize(global_row_number(df, [day, *order], "_place"), "places")
    first = numbered.groupBy(day).agg((F.min("_place") - 1).alias("_before")).withColumnRenamed(day, "_day")
    return (
        numbered.join(first, F.col(day).eqNullSafe(F.col("_day")))
        .withColumn(out, F.col("_place") - F.col("_before"))
        .drop("_place", "_before", "_day")
    )
