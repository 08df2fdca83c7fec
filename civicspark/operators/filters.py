"""Row filters."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.functions.scalars import matches
from civicspark.operators.columns import quoted
from civicspark.operators.joins import semi_join_codes
from civicspark.operators.quality import require_columns

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Box:
    """Inclusive longitude/latitude box.  The defaults are fixed values."""

    west: float = -3.1178
    east: float = -2.25211
    south: float = 51.273
    north: float = 51.68239


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """F1."""
    return df.where(quoted(column) == F.lit(value))


def differs(df: DataFrame, column: str, value) -> DataFrame:
    """rows whose value is another one; NULL is dropped as well."""
    return df.where(quoted(column) != F.lit(value))


def in_box(
    df: DataFrame, box: Box = Box(), long_col: str = "long", lat_col: str = "lat"
) -> DataFrame:
    """inclusive on all four edges; rows without coordinates drop out."""
    return df.where(
        quoted(long_col).between(box.west, box.east)
        & quoted(lat_col).between(box.south, box.north)
    )


def in_codes(df: DataFrame, column: str, codes: Sequence | DataFrame) -> DataFrame:
    """membership.  A short literal list stays a predicate; a frame is a semi-join."""
    if isinstance(codes, DataFrame):
        return semi_join_codes(df, column, codes)
    if not codes:
        return df.where(F.lit(False))
    return df.where(quoted(column).isin(list(codes)))


def latest_period(df: DataFrame, column: str) -> DataFrame:
    """rows of the latest period of the whole input, by a scalar subquery.

    Only the period column is read for the maximum, and the maximum is one row.
    """
    require_columns(df, [column])
    return df.where(quoted(column) == df.agg(F.max(quoted(column))).scalar())


def not_null(df: DataFrame, column: str) -> DataFrame:
    """F6."""
    return df.where(quoted(column).isNotNull())


def in_codes_of_first_column(
    df: DataFrame, candidates: Sequence[str], codes: Sequence | DataFrame
) -> DataFrame:
    """F4 on the first candidate column that exists; with none, warn and pass all rows."""
    for name in candidates:
        if name in df.columns:
            return in_codes(df, name, codes)
    log.warning("Code column not found, nothing filtered. Available: %s", df.columns)
    return df


def flag_matching(df: DataFrame, column: str, pattern: str, flag: str) -> DataFrame:
    """F8: boolean column, true where the pattern occurs in the text."""
    return df.withColumn(flag, matches(quoted(column), pattern))


def in_months(
    df: DataFrame,
    date: Column | str,
    first: tuple[int, int],
    last: tuple[int, int],
) -> DataFrame:
    """rows dated from the first (year, month) to the last, both included.

    The bounds are dates, so that a scan can skip what lies outside them.
    """
    date = quoted(date) if isinstance(date, str) else date
    begin = datetime.date(first[0], first[1], 1)
    end = datetime.date(last[0] + last[1] // 12, last[1] % 12 + 1, 1)
    return df.where((date >= F.lit(begin)) & (date < F.lit(end)))
