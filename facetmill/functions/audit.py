"""Who wrote a row and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CREATED = ("created_at", "created_by")
UPDATED = ("updated_at", "updated_by")
AUDIT = CREATED + UPDATED


def created_columns() -> list[Column]:
    return [F.current_timestamp().alias("created_at"), F.session_user().alias("created_by")]


def updated_columns() -> list[Column]:
    return [F.current_timestamp().alias("updated_at"), F.session_user().alias("updated_by")]


def with_audit(df: DataFrame) -> DataFrame:
    return df.select("*", *created_columns(), *updated_columns())


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT)
