"""Global row numbers and fixed-size code groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.operators.columns import quoted, ticked
from civicspark.session import cut_lineage

_ROW_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def number_in_order(df: DataFrame, column: str, name: str = "position") -> DataFrame:
    """Number rows 0, 1, 2... by a column of distinct values, without sorting in one task.

    Rows are range-partitioned and sorted inside each partition, which a reliable
    checkpoint pins down (runs a job).  A row's number is its place in the partition plus
    the sizes of the partitions before it; there is one such size per partition.
    """
    ordered = (
        df.repartitionByRange(quoted(column))
        .sortWithinPartitions(quoted(column))
        .withColumn("__id", F.monotonically_increasing_id())
    )
    pinned = cut_lineage(ordered).withColumns(
        {
            "__part": F.shiftright("__id", _ROW_BITS),
            "__place": F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    # One row per partition, so this running total is small whatever the data.
    running = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pinned.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(running), F.lit(0)).alias("__start"))
    )
    return (
        pinned.join(starts, "__part")
        .withColumn(name, F.col("__start") + F.col("__place"))
        .select(*[ticked(c) for c in df.columns], name)
    )


def chunk_codes(
    df: DataFrame, column: str, size: int = 100, separator: str = ","
) -> DataFrame:
    """(chunk, n_codes, codes, members): distinct codes in order, ``size`` to a chunk, as
    joined text and as an array."""
    codes = df.select(quoted(column).alias("code")).where("code IS NOT NULL").distinct()
    numbered = number_in_order(codes, "code").withColumn(
        "chunk", F.floor(F.col("position") / size).cast("long")
    )
    members = F.sort_array(F.collect_list(F.struct("position", F.col("code").cast("string").alias("code"))))
    return (
        numbered.groupBy("chunk")
        .agg(members.alias("__members"), F.count(F.lit(1)).alias("n_codes"))
        .select("chunk", "n_codes", F.transform("__members", lambda m: m["code"]).alias("members"))
        .select("chunk", "n_codes", F.array_join("members", separator).alias("codes"), "members")
    )


def chunk_filters(chunks: DataFrame, code_name: str) -> DataFrame:
    """The membership clause of each chunk, ``name IN ('a', 'b')``; quotes are doubled."""
    literals = F.transform("members", lambda m: F.concat(F.lit("'"), F.replace(m, F.lit("'"), F.lit("''")), F.lit("'")))
    return chunks.withColumn("clause", F.concat(F.lit(f"{code_name} IN ("), F.array_join(literals, ", "), F.lit(")")))
