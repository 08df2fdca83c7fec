"""Incremental ingest of certificate pages and the keyed refresh of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.functions.names import apply_names, upper_underscore
from civicspark.sources.keyed import KeyedTable
from civicspark.sources.sinks import replace_table, upsert_by_key

BATCH = "batch_id"


def collect_new_files(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    updates: str,
    checkpoint: str,
    file_format: str = "csv",
    max_files_per_batch: int = 1000,
    multi_line: bool = True,
) -> None:
    """Read every landed file not seen before, then stop.

    The stream's checkpoint remembers the files.  Micro-batch n is written to
    ``updates/batch_id=n`` in overwrite mode, so a batch that is run again after a failure
    replaces its own earlier attempt and no other.
    """
    reader = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_batch)
    )
    if file_format == "csv":
        for key, value in {
            "header": True, "quote": '"', "escape": '"',
            "enforceSchema": False, "mode": "FAILFAST", "multiLine": multi_line,
        }.items():
            reader = reader.option(key, value)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        named = apply_names(batch, upper_underscore)
        named.write.mode("overwrite").parquet(f"{updates.rstrip('/')}/{BATCH}={batch_id}")

    (
        reader.load(landed)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
        .start()
        .awaitTermination()
    )


def collected_updates(
    spark: SparkSession, updates: str, after_batch: int = -1
) -> DataFrame | None:
    """Micro-batches so far, with their number in ``batch_id``; None before the first.

    Batches up to ``after_batch``, already part of a refreshed base, are not even listed
    as input: the number is a partition of the files.
    """
    try:
        return spark.read.parquet(updates).where(F.col(BATCH) > after_batch)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def apply_updates(
    base: DataFrame, updates: DataFrame, key: str | Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """K5 over collected batches: a later batch wins, then the given order within a batch."""
    return upsert_by_key(base, updates, key, [F.col(BATCH).cast("long"), *order])


def refresh_table(
    spark: SparkSession,
    base: DataFrame,
    landed: str,
    schema: T.StructType,
    updates: str,
    checkpoint: str,
    target: str,
    key: str = "LMK_KEY",
    order: Sequence[str] = ("LODGEMENT_DATETIME",),
    file_format: str = "csv",
    after_batch: int = -1,
    multi_line: bool = True,
) -> DataFrame:
    """Take in new files, then write base and updates as one table to a new path.

    However many micro-batches the new files make, the table is rewritten once.  When the
    base is an earlier refresh, ``after_batch`` names the last batch it already holds; a table
    that remembers this, and rewrites only what updates touch, is refreshed by
    :func:`refresh_keyed_table`.
    """
    collect_new_files(spark, landed, schema, updates, checkpoint, file_format, multi_line=multi_line)
    batches = collected_updates(spark, updates, after_batch)
    merged = base if batches is None else apply_updates(base, batches, key, order)
    return replace_table(merged, target)


def refresh_keyed_table(
    spark: SparkSession,
    root: str,
    landed: str,
    schema: T.StructType,
    updates: str,
    checkpoint: str,
    order: Sequence[str] = ("LODGEMENT_DATETIME",),
    file_format: str = "csv",
    multi_line: bool = True,
) -> KeyedTable:
    """Take in new files, then upsert the batches the table does not hold yet.

    The table's own record says which batch was its last, so a run without new files, or one
    that is repeated after a failure, brings back no old row.  Only touched buckets are rewritten.
    """
    table = KeyedTable.open(spark, root)
    collect_new_files(spark, landed, schema, updates, checkpoint, file_format, multi_line=multi_line)
    batches = collected_updates(spark, updates, table.state.last_batch)
    last = None if batches is None else batches.agg(F.max(BATCH)).first()[0]
    if last is None:
        return table
    return table.upsert(batches, [F.col(BATCH).cast("long"), *order], last_batch=int(last))
