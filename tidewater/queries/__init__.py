"""Registered queries over the sample tables, each with its oracle SQL where SQL can say it."""

from tidewater.queries import cdc, customers, features, models, operational, quality, sales, scalars, star, streams  # noqa: F401
from tidewater.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
