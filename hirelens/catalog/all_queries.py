"""Imports every module of queries, so that the registry is full."""

from . import check_queries, history_queries, record_queries, star_queries, table_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
