"""MERGE semantics on plain Parquet: pure functions that return the new table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.audit import CREATED, UPDATED, created_columns, updated_columns
from ..functions.dates import lookback
from ..functions.text import value_if
from .joins import fits_memory


class DuplicateKeyError(ValueError):
    """The incoming side holds a key more than once."""


def refuse_duplicates(new: DataFrame, keys: Sequence[str]) -> None:
    """Fail like MERGE does when two incoming rows target one row. Runs a job."""
    if new.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise DuplicateKeyError(f"incoming rows are not unique on {list(keys)}")


def any_differs(columns: Sequence[str], left: str = "n", right: str = "o") -> Column:
    """True when any column differs, NULL being a value like any other."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def newer_than_target(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows past the target's high-water mark; all rows for an empty target (M4, A4)."""
    mark = target.agg(F.max(column)).scalar()
    return source.where(mark.isNull() | (F.col(column) > mark))


def changed_or_new(
    new: DataFrame, old: DataFrame, keys: Sequence[str], compare: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Rows to write when only real changes count.

    Matched rows that differ in a ``compare`` column take the new attributes,
    keep ``created_*`` and the columns in ``keep`` from the old row and get a
    new ``updated_*``. Unmatched new rows get both pairs fresh. One outer join
    serves both parts.
    """
    n, o = new.alias("n"), old.withColumn("_there", F.lit(True)).alias("o")
    joined = n.join(o, [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys], "left")
    there = F.col("o._there").isNotNull()
    fresh = dict(zip(CREATED + UPDATED, created_columns() + updated_columns()))
    out = []
    for c in old.columns:
        if c in CREATED:
            out.append(value_if(there, F.col(f"o.{c}"), fresh[c]).alias(c))
        elif c in UPDATED:
            out.append(fresh[c].alias(c))
        elif c in keep:
            out.append(value_if(there, F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        else:
            out.append(F.col(f"n.{c}").alias(c))
    return joined.where(~there | any_differs(compare)).select(*out)


def with_carried_audit(
    new: DataFrame, old: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """All new rows; ``created_*`` from the old row if there is one.

    With ``compare``, ``updated_*`` move only when one of those columns
    changed (a NULL counts as a value); without it they always move.
    """
    audit = [*CREATED, *UPDATED]
    n = new.alias("n")
    o = old.select(*keys, *(compare or []), *audit).withColumn("_there", F.lit(True)).alias("o")
    joined = n.join(o, [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys], "left")
    there = F.col("o._there").isNotNull()
    moved = ~there | any_differs(compare) if compare else F.lit(True)
    fresh = dict(zip(audit, created_columns() + updated_columns()))
    cols = [F.col(f"n.{c}").alias(c) for c in new.columns]
    cols += [value_if(there, F.col(f"o.{c}"), fresh[c]).alias(c) for c in CREATED]
    cols += [value_if(moved, fresh[c], F.col(f"o.{c}")).alias(c) for c in UPDATED]
    return joined.select(*cols)


def merge_columns(
    old: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str], check: bool = True
) -> DataFrame:
    """The full table after a merge that changes only the ``update`` columns (M8).

    Matched rows take those columns from ``new`` (a new NULL too) and the rest
    from ``old``; new keys are inserted whole; keys missing in ``new`` stay.
    """
    if check:
        refuse_duplicates(new, keys)
    o = old.withColumn("_in_old", F.lit(True)).alias("o")
    n = new.withColumn("_in_new", F.lit(True)).alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    in_old, in_new = F.col("o._in_old").isNotNull(), F.col("n._in_new").isNotNull()
    out = []
    for c in old.columns:
        from_new = ~in_old | in_new if c in update else ~in_old
        out.append(F.when(from_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return joined.select(*out)


def late_floor(target: DataFrame, column: str, days: int = 7, as_of: datetime.date | None = None) -> Column:
    """First day still open: ``days`` before the target's newest day up to ``as_of``.

    Dates are written by clients. One row dated in the future must not close the
    window for all later loads, so days after ``as_of`` (default: today) do not count.
    """
    last = F.lit(as_of) if as_of else F.current_date()
    return target.where(F.col(column) <= last).agg(lookback(F.max(column), days)).scalar()


def late_window(
    source: DataFrame, target: DataFrame, column: str, days: int = 7, as_of: datetime.date | None = None
) -> DataFrame:
    """Source rows inside the open window; all rows for an empty target."""
    floor = late_floor(target, column, days, as_of)
    return source.where(floor.isNull() | (F.col(column) >= floor))


def left_out(
    source: DataFrame, target: DataFrame, column: str, days: int = 7, as_of: datetime.date | None = None
) -> DataFrame:
    """Source rows that :func:`late_window` leaves out: older than the window, or without a date."""
    floor = late_floor(target, column, days, as_of)
    return source.where(floor.isNotNull() & (F.col(column).isNull() | (F.col(column) < floor)))


def reprocess_late(
    staged: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    date_column: str = "local_order_date",
    days: int = 7,
    as_of: datetime.date | None = None,
) -> DataFrame:
    """Rows to write for a fact with late arrivals (M7).

    Staged rows inside the lookback replace the measures of matched target
    rows (all other columns stay) or are inserted.
    """
    recent = late_window(staged, target, date_column, days, as_of)
    n, o = recent.alias("n"), target.withColumn("_there", F.lit(True)).alias("o")
    joined = n.join(o, [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys], "left")
    there = F.col("o._there").isNotNull()
    fresh = dict(zip(CREATED + UPDATED, created_columns() + updated_columns()))
    out = []
    for c in target.columns:
        if c in UPDATED:
            out.append(fresh[c].alias(c))
        elif c in CREATED:
            out.append(value_if(there, F.col(f"o.{c}"), fresh[c]).alias(c))
        elif c in measures:
            out.append(F.col(f"n.{c}").alias(c))
        else:
            out.append(value_if(there, F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
    return joined.select(*out)


def merge_touched(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    partition: str,
    check: bool = True,
) -> DataFrame:
    """The partitions that ``changes`` touch, merged; the rest of the target is not read.

    ``changes`` hold matched rows with their old ``partition`` value, as
    :func:`reprocess_late` gives them, and should be a written table. The
    partitions are named in the filter, so that the scan of the target opens no
    other folder. Write the result with dynamic partition overwrite: an upsert of
    a week rewrites a week, not the whole table.
    """
    return merge_columns(in_partitions(target, partition, partition_values(changes, partition)), changes, keys, update, check)


def partition_values(df: DataFrame, partition: str) -> list:
    """The distinct values of a date column: a short list, bounded by the calendar."""
    return sorted(r[0] for r in df.select(partition).distinct().where(F.col(partition).isNotNull()).collect())


def in_partitions(df: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """Rows of the named partitions, by a literal list that prunes the scan."""
    return df.where(F.col(partition).isin(list(values)) if values else F.lit(False))


def replace_groups(
    new: DataFrame, old: DataFrame, group: str, keys: Sequence[str]
) -> DataFrame:
    """``old`` with every group (order) that ``new`` holds replaced as a whole.

    A corrected line replaces the old one whatever its key was, and a line that is
    no longer part of its group goes. Rows with an unchanged key keep ``created_*``.

    ``old`` is measured; where the little that is asked of it can be broadcast, as that of an open window, ``new`` does not move.
    """
    known, arrived = old.select(*keys, *CREATED, *UPDATED), new.select(group)
    if fits_memory(old.select(*dict.fromkeys([group, *keys]), *CREATED, *UPDATED)):
        known = F.broadcast(known)
        arrived = arrived.join(F.broadcast(old.select(group)), group, "left_semi")
    audited = with_carried_audit(new, known, keys).select(old.columns)
    return old.join(arrived.distinct(), group, "left_anti").select(old.columns).unionByName(audited)


def reconcile_groups(
    new: DataFrame, old: DataFrame, group: str, keys: Sequence[str], line: Sequence[str], declared: str
) -> DataFrame:
    """``old`` after a load that may hold only some lines of a group (order).

    ``declared`` is a column of ``new``: how many lines the whole group has. Where the load holds as many, the
    group is replaced as a whole. Where it holds fewer, or the number is not known, a line that arrives replaces
    the old lines with the same ``line`` columns (no NULLs) and all others stay: nothing vanishes because it
    came in another load. Rows with an unchanged key keep ``created_*``.
    """
    counts = new.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.max(declared).alias("_declared"))
    whole = counts.where(F.col("_n") >= F.col("_declared")).select(group)
    rows = new.drop(declared)
    audited = with_carried_audit(rows, old, keys).select(old.columns)
    arrived = rows.select(group, *line).distinct()
    kept = old.join(whole, group, "left_anti").join(arrived, [group, *line], "left_anti")
    return kept.select(old.columns).unionByName(audited)


def shrinking_groups(new: DataFrame, old: DataFrame, group: str, line: Sequence[str]) -> DataFrame:
    """Groups that :func:`replace_groups` would leave with lines missing: (group, lost_lines)."""
    arrived = new.select(group, *line).distinct()
    held = old.join(new.select(group).distinct(), group, "left_semi")
    return held.join(arrived, [group, *line], "left_anti").groupBy(group).agg(F.count(F.lit(1)).alias("lost_lines"))
