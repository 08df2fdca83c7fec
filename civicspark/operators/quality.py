"""Duplicates, keys, required columns and lenient types."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names the frame lacks; Spark ignores case, so does this."""
    have = {name.lower() for name in df.columns}
    return [name for name in names if name.lower() not in have]


def require_columns(df: DataFrame, names: Iterable[str], what: str = "columns") -> None:
    """``ValueError`` that lists what is missing.  Schema only, no job."""
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"Missing required {what}: {missing}. Available: {df.columns}")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; copies collapse before the shuffle."""
    return df.dropDuplicates()


def distinct_by_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """One row per key, the first in the given order.

    Without an order, or where it ties, the remaining columns decide, so the survivor
    does not depend on partitioning.  NULL counts as a key value.  Without an order the
    survivor is a combined minimum of the remaining columns as one struct, so nothing is sorted
    by them.  With one, the ``= 1`` on a row number makes Spark keep one row per key in each map
    task already.  Either way a key that holds a large share of the rows never gathers in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(df, keys)
    named = {k.lower() for k in keys}
    rest = [f for f in df.schema.fields if f.name.lower() not in named]
    sortable = [F.col(f"`{f.name}`") for f in rest if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    if not order and rest and len(sortable) == len(rest):
        least = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(F.struct(*sortable)).alias("__row"))
        return least.select([
            F.col(f"`{c}`") if c.lower() in named else F.col(f"__row.`{c}`") for c in df.columns
        ])
    window = Window.partitionBy(*keys).orderBy(*order, *(sortable or keys))
    return df.withColumn("__nth", F.row_number().over(window)).where("__nth = 1").drop("__nth")


def duplicate_keys(df: DataFrame, *key: str, digest: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """Keys that occur more than once, with their ``count``.

    As in a unique index, a key with a NULL part never counts as a duplicate.  Texts in the key
    are first counted by a 64-bit digest, so whole texts are not shuffled; only rows whose digest
    another row has are then compared by their full keys, and two keys that merely share a
    digest are told apart there.
    """
    keyed, shared = _shared_digests(df, key, digest)
    if shared is not None:
        keyed = keyed.join(shared, shared.columns, "left_semi")
    return keyed.groupBy(*key).count().where("count > 1")


def _shared_digests(
    df: DataFrame, key: Sequence[str], digest: Callable[..., Column] = F.xxhash64
) -> tuple[DataFrame, DataFrame | None]:
    """Whole keys with a digest of their texts, and the digests that two rows have; None for the
    latter where the key has no text."""
    require_columns(df, key)
    keyed = df.dropna("any", subset=list(key)).select(*[F.col(f"`{k}`") for k in key])
    kinds = {f.name.lower(): f.dataType for f in keyed.schema.fields}
    texts = [k for k in key if isinstance(kinds[k.lower()], (T.StringType, T.BinaryType))]
    if not texts:
        return keyed, None
    rest = [k for k in key if k not in texts]
    keyed = keyed.withColumn("__digest", digest(*[F.col(f"`{k}`") for k in texts]))
    counts = keyed.groupBy("__digest", *rest).agg(F.count(F.lit(1)).alias("__n"))
    return keyed, counts.where("__n > 1").drop("__n")


def assert_unique(df: DataFrame, *key: str) -> None:
    """D5 as a check.  Runs a job; names up to five offending keys.

    Where no two rows share a digest there is nothing to compare, and whole keys are not shuffled.
    """
    _, shared = _shared_digests(df, key)
    if shared is not None and shared.count() == 0:
        return
    found = duplicate_keys(df, *key).limit(5).collect()
    if found:
        raise ValueError(f"Duplicate values for key {key}: {[tuple(r)[:-1] for r in found]}")


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema, in its order; a value that does not fit becomes NULL."""
    require_columns(df, schema.fieldNames())
    return df.select(
        [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def parse_date_if_text(df: DataFrame, *names: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text columns to dates, NULL where the text is no date; date columns pass."""
    require_columns(df, names)
    text = [n for n in names if not isinstance(df.schema[n].dataType, T.DateType)]
    return df.withColumns({n: F.try_to_date(F.col(f"`{n}`"), fmt) for n in text})


def count_rows_of(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same frame with a row count that its own next action fills in (no extra job).

    ``observation.get["rows"]`` is available once an action on the frame has run.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def rows_counted(observation: Observation, written: DataFrame) -> int:
    """The observed count; where Spark saw beforehand that there is nothing to write, and so
    observed nothing, the written table is counted."""
    try:
        return observation.get["rows"]
    except (KeyError, Py4JJavaError):
        return written.count()


def warn_if_none(rows: int, message: str) -> int:
    """Log a warning when there are no rows; returns the count."""
    if rows == 0:
        log.warning(message)
    return rows


def warn_if_empty(observation: Observation, message: str) -> int:
    """The same for a frame that was observed."""
    return warn_if_none(observation.get["rows"], message)
