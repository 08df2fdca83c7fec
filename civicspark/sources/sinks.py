"""Writers (K1-K6).  Every one is a distributed write of Spark part files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.operators.columns import quoted, ticked
from civicspark.operators.quality import distinct_by_key, require_columns


#: Most partitions by which rows are gathered.  Up to this many, Spark writes a row straight to the
#: file of its partition; beyond it, a task first holds its rows in memory and spills them.
GATHER_PARTITIONS = 200


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """K1, K2: write Parquet in place of whatever is there; returns the table as written.

    Spark refuses to replace a path the frame itself reads from.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def gather_by(df: DataFrame, column: str) -> DataFrame:
    """The same rows with those of one value in few tasks; a value with very many rows is split.

    The number of partitions is bounded: whole rows go through this shuffle, and with a number
    that grows with the data every row would be spilled once on the way.
    """
    parts = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), GATHER_PARTITIONS)
    return df.hint("rebalance", parts, column)


def replace_partitioned(df: DataFrame, path: str, column: str) -> DataFrame:
    """K1: as :func:`replace_table`, with a folder for each value of a column.

    Filters and semi-joins on the column then read only the folders they need.  A value's rows
    go to few files; a value with very many rows is split.  The table comes back with its own
    types and column order.  An empty text in the column comes back as NULL.
    """
    require_columns(df, [column])
    gather_by(df, column).write.mode("overwrite").partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select([ticked(c) for c in df.columns])


def export_csv(df: DataFrame, path: str) -> None:
    """K3: a folder of CSV parts, each with the header; quotes inside a field are doubled
    and blanks at its ends are kept."""
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def export_tables(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """K4: every table as Parquet under one root; returns name -> path."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def write_codes(df: DataFrame, column: str, path: str) -> None:
    """K6: one column of codes as JSON lines."""
    df.select(quoted(column)).write.mode("overwrite").json(path)


def read_codes(spark: SparkSession, path: str, column: str) -> DataFrame:
    """K6: the codes back, as a frame for a semi-join."""
    return spark.read.schema(f"`{column}` string").json(path)


def upsert_by_key(
    base: DataFrame,
    updates: DataFrame,
    key: str | Sequence[str],
    order: Sequence[Column | str],
) -> DataFrame:
    """K5: base rows whose key the updates do not name, plus the updates.

    Columns match by name.  Where the updates repeat a key, the row that comes last in
    ``order`` wins.  Keys with a NULL part are not unique keys, so such rows are all kept
    on both sides.  Write the result to a new path and switch readers over to it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(base, keys)
    require_columns(updates, base.columns)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & quoted(k).isNotNull()
    last_first = [_descending(o) for o in order]
    winners = distinct_by_key(updates.where(has_key), keys, last_first)
    keyless = updates.where(~has_key)
    # The keys alone, not the winners: an anti join needs no distinct right side.
    replaced = updates.where(has_key).select(
        [quoted(k).alias(f"__replaced_{i}") for i, k in enumerate(keys)]
    )
    condition = [quoted(k) == F.col(f"__replaced_{i}") for i, k in enumerate(keys)]
    untouched = base.join(replaced, condition, "left_anti")
    columns = [ticked(c) for c in base.columns]
    return untouched.unionByName(winners.select(columns)).unionByName(keyless.select(columns))


def _descending(order: Column | str) -> Column:
    return (quoted(order) if isinstance(order, str) else order).desc_nulls_last()
