"""Runnable queries over the test tables, each with the SQL that says what it must return."""

from __future__ import annotations

from .registry import QUERIES, SQL  # noqa: F401
from . import expressions, history, ingest, streams, upserts, warehouse, kept  # noqa: F401  (register)
