"""Registered queries, each with the SQL an independent engine checks it with."""

from lakeweave.catalog import basics, grouping, io, profiles, quality, series, star, sync  # noqa: F401
from lakeweave.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
