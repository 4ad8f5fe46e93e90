"""Constraint queries (Q1-Q11): each returns the rows, or the keys, that break the constraint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1."""
    return df.where(F.col(column).isNull())


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their number; null is a key like any other."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Q3: rows with another value; null passes."""
    return df.where(~F.col(column).isin(values))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Q4: rows outside [low, high]; null passes, NaN doesn't."""
    return df.where((F.col(column) < low) | (F.col(column) > high))


def not_single_latest(versions: DataFrame, key: str = "fact_key") -> DataFrame:
    """Keys that don't have exactly one latest version."""
    return versions.groupBy(key).agg(F.sum(F.col("is_latest").cast("int")).alias("n_latest")).where("n_latest <> 1")


def gaps_in_windows(versions: DataFrame, key: str = "fact_key") -> DataFrame:
    """Versions that don't end where the next one begins."""
    w = Window.partitionBy(key).orderBy("version_no")
    return versions.select(key, "version_no", "valid_from", "valid_to", F.lead("valid_from").over(w).alias("next_from")).where("next_from is not null and valid_to <> next_from")


def orphans(df: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """Rows whose key the other table lacks (anti join); a null key has no partner."""
    return df.join(other.select(column).distinct(), column, "left_anti")


class CheckFailed(ValueError):
    """A check found rows."""


def require_none(name: str, violations: DataFrame, severity: str = "error") -> int:
    """Q10: raise if there are violations; with severity 'warn' return their number."""
    n = violations.count()
    if n and severity == "error":
        raise CheckFailed(f"{name}: {n} rows")
    return n


def require_promoted(version: str | None) -> str:
    """Q10: after an evaluation an index version is promoted, the new one or the one before."""
    if version is None:
        raise CheckFailed("a promoted index version: there is none")
    return version
