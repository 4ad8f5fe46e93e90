"""All queries of the library, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronofact.plans import problems, reference, reference_sql

Query = Callable[[SparkSession, str], DataFrame]


def core_queries() -> dict[str, Query]:
    return reference.QUERIES | problems.QUERIES


def core_sql() -> dict[str, str]:
    return reference_sql.SQL | problems.SQL
