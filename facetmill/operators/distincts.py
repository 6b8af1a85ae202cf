"""Duplicate removal, representatives, samples and default members.

All of these combine inside each task before the shuffle, so a key or a group
of copies with a third of all rows arrives as a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns; arrays of structs may be among them."""
    return df.select(*columns).distinct()


def distinct_non_blank(df: DataFrame, column: str) -> DataFrame:
    """Distinct values without NULL and the empty text."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != "")).select(column).distinct()


def earliest_value(df: DataFrame, key: str, value: str, order: Sequence[str], out: str) -> DataFrame:
    """One value per key, that of the key's first row in ``order``."""
    return df.groupBy(key).agg(F.min_by(F.col(value), F.struct(*order)).alias(out))


def sample_rows(df: DataFrame, n: int, by: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows in a random, repeatable choice (O4): those with the least hash of ``by`` and the seed.

    One pass: each task keeps its ``n`` least, and those meet in one task (a sorted limit), so ``n`` is the size of a sample.
    """
    rank = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in by]))
    return df.withColumn("_rank", rank).orderBy("_rank", *by).limit(n).drop("_rank")


def with_default_member(dim: DataFrame, member: dict) -> DataFrame:
    """Add the row that stands for "unknown" (O5). Columns not named become NULL."""
    spark = dim.sparkSession
    row = spark.range(0, 1, 1, 1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema]
    )
    return dim.unionByName(row)
