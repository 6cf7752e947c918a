"""Queries over the given tables, each with its SQL twin where SQL can say it."""

from catalog.registry import ORACLES, QUERIES  # noqa: F401
from catalog import joins, learned, rows, runs, texts  # noqa: F401
