"""Runnable queries over the given tables."""

from __future__ import annotations

from winback.plans import (  # noqa: F401 - importing a module registers its queries
    explanation,
    exploration,
    modeling,
    monitoring,
    scoring,
    training,
    transactions,
)
from winback.plans.catalog import QUERIES, SQL, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
