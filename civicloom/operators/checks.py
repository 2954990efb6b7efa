"""Data tests: each returns the rows that break a rule, so an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.filter(F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0)) == 1)


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number; nulls are equal."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value isn't null and isn't accepted."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value isn't null and isn't in the parent table."""
    known = parent.select(F.col(parent_column).alias("_k")).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_k"), "left_anti")
