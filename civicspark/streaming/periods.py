"""Reporting periods (I1, I2).  A period is (year, month)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions.scalars import months_after
from civicspark.operators.columns import quoted


def previous_month(today: date | None = None) -> tuple[int, int]:
    """Default end of a period range; January rolls back into December."""
    last_day = (today or date.today()).replace(day=1) - timedelta(days=1)
    return (last_day.year, last_day.month)


def three_months_back(today: date | None = None) -> tuple[int, int]:
    """Default start: three months back, never before January of the same year."""
    today = today or date.today()
    return (today.year, max(1, today.month - 3))


def period_after(day: date) -> tuple[int, int]:
    """The month after a day."""
    return (day.year + day.month // 12, day.month % 12 + 1)


def next_period(published: DataFrame, date_column: str) -> DataFrame:
    """The month after the latest published date, as one row (year, month).

    An empty table is an error when the row is computed.
    """
    latest = F.max(quoted(date_column)).cast("date")
    checked = F.coalesce(latest, F.raise_error("no date published yet").cast("date"))
    year, month = months_after(F.col("latest"), 1)
    return published.agg(checked.alias("latest")).select(
        year.alias("year"), month.alias("month")
    )


def next_period_value(published: DataFrame, date_column: str) -> tuple[int, int]:
    """I1 as a value for :func:`read_certificate_pages`.  Runs a job; one row comes back."""
    row = next_period(published, date_column).first()
    return (row["year"], row["month"])
