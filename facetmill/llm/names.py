"""Operators on tables whose columns may have any name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def apart(docs: DataFrame, fn: Callable[..., DataFrame], **roles: str | None) -> DataFrame:
    """``fn`` applied to ``docs`` with its columns under neutral names, which no operator uses; the result has the old names.

    ``roles``: arguments of ``fn`` that name a column. ``fn`` returns the columns it was given, besides any others.
    """
    neutral = [f"_in{i}" for i in range(len(docs.columns))]
    places = dict(zip(docs.columns, neutral))
    out = fn(docs.toDF(*neutral), **{role: places[name] for role, name in roles.items() if name is not None})
    return out.select(*neutral).toDF(*docs.columns)
