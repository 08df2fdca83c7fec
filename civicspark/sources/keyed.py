"""Tables laid out by key, for upserts that rewrite only what they touch.

A keyed table is a folder with ``data``, Parquet files partitioned by a hash bucket of the key,
and ``state``, one small JSON record per change.  An upsert reads and overwrites only the buckets
in which updates fall; the files of all others stay as they are.  The record holds how far the
table is: the last applied micro-batch and the latest date of its high-water column, so the next
run reads no old input and scans no table to know where to go on.

A run may die at any point.  The merged buckets are first written to the shared folder and named
in a record as pending; then they replace the old ones; then a record without the mark follows.
Opening a table with a pending mark repeats the replacement, which changes nothing if it was
done.  Before the mark the old table is whole.  One writer at a time is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.operators.columns import quoted, ticked
from civicspark.operators.quality import distinct_by_key, require_columns
from civicspark.session import remove_scratch, scratch_path
from civicspark.sources.sinks import gather_by

BUCKET = "__bucket"


@dataclass(frozen=True)
class TableState:
    """One record: what a table is and how far it has come."""

    sequence: int
    key: tuple[str, ...]
    buckets: int
    schema: str
    high_water_column: str | None = None
    last_batch: int = -1
    high_water: str | None = None
    pending: str | None = None


class KeyedTable:
    """A table by key below ``root``.  Made by :meth:`create`, found again by :meth:`open`."""

    def __init__(self, spark: SparkSession, root: str, state: TableState):
        self.spark, self.root, self.state = spark, root.rstrip("/"), state
        self.schema = T.StructType.fromJson(json.loads(state.schema))

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @classmethod
    def create(
        cls, df: DataFrame, root: str, key: str | Sequence[str], buckets: int = 256, high_water_column: str | None = None
    ) -> KeyedTable:
        """Write a frame as a keyed table at a root that holds none yet.

        Rows with a NULL in the key are spread over the buckets by their other columns.
        Choose the buckets so that one fits a few tasks: they are the unit of rewriting.
        ``high_water_column`` is a date or timestamp whose latest day the record keeps.
        """
        keys, spark = (key,) if isinstance(key, str) else tuple(key), df.sparkSession
        require_columns(df, keys)
        if _latest_record(spark, root) is not None:
            raise ValueError(f"There is a keyed table at {root}")
        table = cls(spark, root, TableState(0, keys, buckets, df.schema.json(), high_water_column))
        table._laid_out(table.with_bucket(df)).write.mode("overwrite").partitionBy(BUCKET).parquet(table.data)
        table._record(high_water=table._latest(table.read()))
        return table

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> KeyedTable:
        """The table as its latest record describes it; an unfinished replacement is finished."""
        row = _latest_record(spark, root)
        if row is None:
            raise ValueError(f"No keyed table at {root}")
        table = cls(spark, root, TableState(**row | {"key": tuple(row["key"])}))
        table._finish()
        return table

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows, of some buckets or of all; files of other buckets are not listed as input."""
        kept = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(self.data)
        if buckets is not None:
            kept = kept.where(F.col(BUCKET).isin([int(b) for b in buckets]))
        return kept.drop(BUCKET)

    def with_bucket(self, df: DataFrame) -> DataFrame:
        whole = F.xxhash64(*[quoted(k) for k in self.state.key])
        spread = F.xxhash64(*[quoted(f.name) for f in self.schema.fields if _hashable(f.dataType)])
        number = F.when(self._has_key(), whole).otherwise(spread)
        return df.withColumn(BUCKET, F.pmod(number, F.lit(self.state.buckets)).cast("int"))

    def upsert(
        self, updates: DataFrame, order: Sequence[Column | str], last_batch: int | None = None
    ) -> KeyedTable:
        """Replace the rows whose keys the updates name, add the others (K5).

        Columns match by name and take the table's types.  Where the updates repeat a key, the
        row that comes last in ``order`` wins; ``order`` may use columns that the table lacks.
        Keys with a NULL part are not unique keys: such rows are added.
        """
        require_columns(updates, self.schema.fieldNames())
        typed = updates.withColumns({f.name: quoted(f.name).cast(f.dataType) for f in self.schema.fields})
        columns = [ticked(f.name) for f in self.schema.fields]
        last_first = [(quoted(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
        winners = distinct_by_key(typed.where(self._has_key()), list(self.state.key), last_first).select(columns)
        new_path, merged_path = scratch_path(self.spark, "winners"), scratch_path(self.spark, "merged")
        new = self.with_bucket(winners.unionByName(typed.where(~self._has_key()).select(columns)))
        new.write.parquet(new_path)  # written once: it decides the buckets and is then joined
        new = self.spark.read.schema(new.schema).parquet(new_path)
        progress = {
            "last_batch": max(self.state.last_batch, -1 if last_batch is None else last_batch),
            "high_water": max((h for h in (self.state.high_water, self._latest(new)) if h is not None), default=None)}
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # no more than there are buckets
        if touched:
            replaced = new.where(self._has_key()).select(*[quoted(k).alias(f"__replaced_{i}") for i, k in enumerate(self.state.key)])
            same = [quoted(k) == F.col(f"__replaced_{i}") for i, k in enumerate(self.state.key)]
            untouched = self.with_bucket(self.read(touched)).join(replaced, same, "left_anti")
            self._laid_out(untouched.unionByName(new)).write.partitionBy(BUCKET).parquet(merged_path)
        # From this record on the upsert counts as done; what is left of it can be repeated.
        if touched or any(getattr(self.state, name) != value for name, value in progress.items()):
            self._record(pending=merged_path if touched else None, **progress)
        remove_scratch(self.spark, new_path)
        self._finish()
        return self

    def _finish(self) -> None:
        """Put pending buckets in the place of the old ones; no other bucket is touched."""
        pending = self.state.pending
        if pending:
            merged = self.spark.read.schema(self.with_bucket(self.read()).schema).parquet(pending)
            (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.data))
            self._record(pending=None)
            remove_scratch(self.spark, pending)

    def _latest(self, rows: DataFrame) -> str | None:
        """The latest day of the high-water column of written rows; reads that column alone."""
        if self.state.high_water_column is None:
            return None
        return rows.agg(F.max(quoted(self.state.high_water_column).cast("date")).cast("string")).first()[0]

    def _has_key(self) -> Column:
        has = F.lit(True)
        for k in self.state.key:
            has = has & quoted(k).isNotNull()
        return has

    def _laid_out(self, df: DataFrame) -> DataFrame:
        """A bucket in few files: rebalancing also splits one that is too large for a task."""
        return gather_by(df, BUCKET)

    def _record(self, **changes) -> None:
        self.state = replace(self.state, sequence=self.state.sequence + 1, **changes)
        row = asdict(self.state) | {"key": list(self.state.key)}
        frame = self.spark.createDataFrame([tuple(row[n] for n in _RECORD.fieldNames())], _RECORD)
        frame.coalesce(1).write.mode("overwrite").json(f"{self.root}/state/change={self.state.sequence}")


_RECORD = (
    T.StructType().add("sequence", "integer").add("key", T.ArrayType(T.StringType())).add("buckets", "integer").add("schema", "string")
    .add("high_water_column", "string").add("last_batch", "integer").add("high_water", "string").add("pending", "string"))


def _latest_record(spark: SparkSession, root: str) -> dict | None:
    try:
        records = spark.read.schema(_RECORD).json(f"{root.rstrip('/')}/state").select(*_RECORD.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = records.orderBy(F.desc("sequence")).first()
    return None if row is None else row.asDict()


def _hashable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))
