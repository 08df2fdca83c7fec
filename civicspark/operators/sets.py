"""Unions, sampling and ordering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.operators.columns import ticked
from civicspark.operators.quality import require_columns


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; number types widen (int with double is double)."""
    if not frames:
        raise ValueError("union of no frames")
    return reduce(lambda a, b: a.unionByName(b), frames)


def append_rows(df: DataFrame, rows: Sequence[Mapping]) -> DataFrame:
    """Add constant rows to a lookup; each must name exactly its columns."""
    if not rows:
        return df
    for row in rows:
        if set(row) != set(df.columns):
            raise ValueError(f"Row columns {sorted(row)} differ from {sorted(df.columns)}")
    extra = df.sparkSession.createDataFrame(
        [tuple(row[c] for c in df.columns) for row in rows], df.schema
    )
    return df.unionByName(extra)


def first_rows(df: DataFrame, n: int | None) -> DataFrame:
    """O1: at most n rows, whichever come first; ``None`` means all of them."""
    return df if n is None else df.limit(n)


def stable_rows(df: DataFrame, n: int | None) -> DataFrame:
    """O1: n rows that are the same on every run: those with the least hash of the whole row.

    Each task keeps its n best, so only those are gathered.  ``None`` means all rows.
    """
    if n is None:
        return df
    kept = [ticked(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.orderBy(F.xxhash64(*kept), *kept).limit(n)


def first_rows_by(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """O1, O2: the first n rows in a given order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """O3."""
    require_columns(df, columns)
    return df.select([ticked(c) for c in columns]).limit(n)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """K7, A5, U4: (table_name, n_rows) ordered by name, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in sorted(tables.items())
    ]
    return union_all(counts).orderBy("table_name")
