"""Aggregations (A1-A6).  All combine before their shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.operators.columns import quoted


def max_per_key(df: DataFrame, key: str | Sequence[str], column: str, name: str) -> DataFrame:
    """A1."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.max(quoted(column)).alias(name))


def sums_per_key(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """A2: sums, given as result name -> column."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        *[F.sum(quoted(column)).alias(name) for name, column in sums.items()]
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """A3: quotient of two totals as double; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_of_sums(
    df: DataFrame, keys: Sequence[str], numerator: str, denominator: str, name: str
) -> DataFrame:
    """A3: ratio of sums per key, which is not the mean of ratios."""
    totals = sums_per_key(df, keys, {"__over": numerator, "__under": denominator})
    return totals.withColumn(name, ratio(F.col("__over"), F.col("__under"))).drop(
        "__over", "__under"
    )


def overall_max(df: DataFrame, column: str, name: str) -> DataFrame:
    """A4: one row."""
    return df.agg(F.max(quoted(column)).alias(name))


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """A5: one row."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A6."""
    return df.select(quoted(column)).distinct()
