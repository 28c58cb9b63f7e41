"""Queries over the given tables, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagtrend.plans.catalog import answers, groups, records, samples, trends
from tagtrend.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["answers", "groups", "records", "samples", "trends", "queries", "oracle_sql"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
