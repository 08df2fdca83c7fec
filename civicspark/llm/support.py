"""What the operators of this subpackage share: tables, written intermediates, code on workers."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import civicspark
from civicspark.session import scratch_path

#: Rows of a side that may be copied to every executor.  Sides are counted before they are.
BROADCAST_ROWS = 200_000

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole table of the given folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = Path(tempfile.mkdtemp(prefix="civicspark-code-"))  # the driver uploads it from here
    root = Path(civicspark.__file__).resolve().parent
    context.addPyFile(shutil.make_archive(str(folder / "civicspark"), "zip", root.parent, root.name))
    _shipped.add(context.applicationId)


def pinned(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Later stages re-read it when an executor is lost, and it is computed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(
    df: DataFrame, side: DataFrame, keys: Sequence[str], how: str, rows: int, bound: int = BROADCAST_ROWS
) -> DataFrame:
    """Join with a side that has ``rows`` rows: copied to the executors while that is within
    ``bound``, shuffled with adaptive skew splitting beyond it.  The result is the same."""
    return df.join(F.broadcast(side) if rows <= bound else side, list(keys), how)
