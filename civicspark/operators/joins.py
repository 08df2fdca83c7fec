"""Joins (J1-J7).

No side carries a broadcast hint.  Spark broadcasts a side only while its size, from
file statistics or measured by adaptive execution, is below the session threshold, and
otherwise shuffles both sides, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.operators.columns import join_side_by_side, quoted
from civicspark.operators.quality import require_columns


def lookup_join(
    facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, clash: str = "drop"
) -> DataFrame:
    """Inner join of facts with a (filtered, column-pruned) lookup."""
    return join_side_by_side(facts, lookup, [(fact_key, lookup_key)], "inner", clash)


def enrich(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, clash: str = "drop"
) -> DataFrame:
    """J2, one step: left join; facts without a match keep NULLs."""
    return join_side_by_side(facts, dimension, [(fact_key, dimension_key)], "left", clash)


def enrich_dimension(
    dimension: DataFrame,
    others: Sequence[tuple[DataFrame, str, str]],
    clash: str = "drop",
) -> DataFrame:
    """J2, the chain: attach (frame, own key, frame's key) to a dimension.

    A chain fact -> dimension -> others gives the same rows as fact -> (dimension with
    others attached), because every further key sits on the dimension.  Attaching them
    there first means the facts, by far the largest side, are shuffled once.
    """
    for frame, own_key, frame_key in others:
        dimension = enrich(dimension, frame, own_key, frame_key, clash)
    return dimension


def latest_per_key(df: DataFrame, key: str | Sequence[str], stamp: str) -> DataFrame:
    """All rows at the latest stamp of their key, ties kept.

    Rows with a NULL key or a NULL stamp vanish.  The per-key maximum is combined before
    its shuffle and reads two columns only.  Rows are joined back on (key, stamp), so a
    key with very many rows spreads over its stamps, and a single hot (key, stamp) is
    split by the skew join; a window would put the whole key into one task.  Filters on
    the result reach the row side of the join and never the maximum.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(df, [*keys, stamp])
    best = df.groupBy([quoted(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(
        F.max(quoted(stamp)).alias("__latest")
    )
    condition = [quoted(k) == F.col(f"__key_{i}") for i, k in enumerate(keys)]
    condition.append(quoted(stamp) == F.col("__latest"))
    return df.join(best, condition, "inner").drop(*best.columns)


def semi_join_codes(
    df: DataFrame, column: str, codes: DataFrame, code_column: str | None = None
) -> DataFrame:
    """Rows whose value is among the codes; the codes never visit the driver."""
    code_column = code_column or codes.columns[0]
    require_columns(df, [column])
    require_columns(codes, [code_column])
    wanted = codes.select(quoted(code_column).alias("__code"))
    return df.join(wanted, quoted(column) == F.col("__code"), "left_semi")
