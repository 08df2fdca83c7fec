"""CSV members of landed ZIP archives (S15, S16), read by a Spark job.

The driver sees paths only.  Each archive is opened by the task that reads it, as a
stream, and its member leaves that task in bounded Arrow batches of text; types are cast
by Spark afterwards.  An archive cannot be split, so many archives are the unit of
parallelism; ``partitions`` spreads the rows once they are out.
"""

from __future__ import annotations

import posixpath
import sys
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import csv, fs
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.operators.quality import cast_to_schema
from civicspark.session import cut_lineage

BATCH_ROWS = 20_000
#: Bytes a record may be long.  A longer one fails the job; pass a larger block.
BLOCK_BYTES = 32 << 20
#: Bytes of a member parsed at a time, unless a record is longer: a task holds several blocks.
USUAL_BLOCK_BYTES = 1 << 20
# Spark's names of a store that Arrow knows by another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}


def certificates_member(names: list[str]) -> str | None:
    """The member ``certificates.csv``, or None (the archive is skipped)."""
    return "certificates.csv" if "certificates.csv" in names else None


def only_csv_under_data(names: list[str]) -> str:
    """The single CSV directly under ``Data/``; none or several is an error."""
    found = [
        str(path) for path in map(PurePosixPath, names)
        if path.parent.as_posix() == "Data" and path.suffix == ".csv"
    ]
    if not found:
        raise FileNotFoundError("No CSV file found directly under Data/ in the archive")
    if len(found) > 1:
        raise ValueError(f"Multiple CSV files found directly under Data/: {found}")
    return found[0]


def arrow_uri(path: str) -> str:
    """A Spark path as Arrow spells it: ``file:/x`` with an authority, stores by their Arrow names."""
    scheme, colon, rest = path.partition(":")
    if scheme == "file" and not rest.startswith("//"):
        rest = "//" + rest
    return _SCHEMES.get(scheme, scheme) + colon + rest


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The store a Spark path names, and the path inside it.

    ``hdfs`` needs Hadoop's native library on the workers, object stores their credentials
    in the environment, as Arrow opens the file there.
    """
    return fs.FileSystem.from_uri(arrow_uri(path))


def _text_batches(
    path: str, columns: list[str], choose: Callable, block_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The chosen member as batches of text in the order of the wanted columns; empty is NULL.

    Blocks are small, so that what a task holds does not grow with its archive.  A block that
    does not parse is taken for a part of a longer record: the member is read again in larger
    blocks, up to ``block_bytes``, past the rows that are out.
    """
    store, inner = store_of(path)
    with store.open_input_file(inner) as stream, zipfile.ZipFile(stream) as archive:
        member = choose(archive.namelist())
        if member is None or archive.getinfo(member).file_size == 0:
            return
        block, rows_out = min(USUAL_BLOCK_BYTES, block_bytes), 0
        while True:
            try:
                with archive.open(member) as raw:
                    passed = 0  # rows of this attempt; those of an earlier one are out already
                    for rows in csv.open_csv(
                        raw,
                        csv.ReadOptions(use_threads=False, block_size=block),
                        csv.ParseOptions(newlines_in_values=True),
                        csv.ConvertOptions(
                            column_types=dict.fromkeys(columns, pa.string()), include_columns=columns,
                            null_values=[""], strings_can_be_null=True,
                        ),
                    ):
                        fresh = rows.slice(max(rows_out - passed, 0))
                        passed += len(rows)
                        rows_out = max(rows_out, passed)
                        if len(fresh):
                            yield fresh
                return
            except (pa.ArrowInvalid, pa.ArrowKeyError) as error:
                if isinstance(error, pa.ArrowKeyError) or block >= block_bytes:
                    # A record longer than a block, a ragged line, a missing column: say where.
                    raise ValueError(f"{member} of {path}: {error}") from error
                block = min(8 * block, block_bytes)  # perhaps a long record: once more from the start


def _archive_reader(
    columns: list[str], choose: Callable, batch_rows: int, block_bytes: int
) -> Callable:
    """The task function: paths in, batches of text rows out."""

    def read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                stem = posixpath.basename(path).rsplit(".", 1)[0]
                for block in _text_batches(path, columns, choose, block_bytes):
                    for start in range(0, len(block), batch_rows):
                        rows = block.slice(start, batch_rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([stem] * len(rows), pa.string()), *rows.columns],
                            names=["source_file", *columns],
                        )

    return read_archives


def _archives(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
    )


def archive_members(
    spark: SparkSession,
    folder: str,
    choose: Callable[[list[str]], str | None] = certificates_member,
    glob: str = "*.zip",
) -> DataFrame:
    """Every archive with the member a read takes from it; NULL marks an archive it skips."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = []
            for path in batch.column(0).to_pylist():
                store, inner = store_of(path)
                with store.open_input_file(inner) as stream, zipfile.ZipFile(stream) as archive:
                    members.append(choose(archive.namelist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(members, pa.string())], names=["path", "member"]
            )

    return _archives(spark, folder, glob).mapInArrow(look, "path string, member string")


def _cast_or_fail(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema; text that does not fit its type fails the job."""
    columns = []
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        value = text.try_cast(f.dataType)
        message = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), text)
        misfit = F.when(text.isNotNull() & value.isNull(), F.raise_error(message).cast(f.dataType))
        columns.append(misfit.otherwise(value).alias(f.name))
    return df.select(columns)


def read_zipped_csv(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    choose: Callable[[list[str]], str | None] = certificates_member,
    glob: str = "*.zip",
    partitions: int | None = None,
    batch_rows: int = BATCH_ROWS,
    strict: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The chosen member of every archive, plus ``source_file`` (archive stem).

    A corrupt archive, a missing column or a ragged line fails the job; an archive for
    which ``choose`` returns None is skipped, and ``archive_members`` lists it.  Values that
    do not fit the declared types become NULL, or fail the job with ``strict``.
    """
    text_schema = T.StructType(
        [T.StructField("source_file", T.StringType())]
        + [T.StructField(f.name, T.StringType()) for f in schema.fields]
    )
    reader = _archive_reader(schema.fieldNames(), choose, batch_rows, block_bytes)
    rows = _archives(spark, folder, glob).mapInArrow(reader, text_schema)
    if partitions:
        rows = rows.repartition(partitions)
    typed = T.StructType([text_schema["source_file"], *schema.fields])
    return _cast_or_fail(rows, typed) if strict else cast_to_schema(rows, typed)


_ARCHIVE = "__archive"


def _versions(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Every landed archive with a digest of its path, length and time; no archive is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    version = F.sha2(F.concat_ws("|", "path", "length", F.col("modificationTime").cast("double")), 256)
    return listed.select("path", F.substring(version, 1, 32).alias(_ARCHIVE))


def stage_archives(
    spark: SparkSession,
    folder: str,
    stage: str,
    columns: Sequence[str],
    choose: Callable[[list[str]], str | None] = certificates_member,
    glob: str = "*.zip",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Write the members of archives not staged yet as Parquet; returns what has landed.

    A staged archive is known by its path, length and time, so one that was replaced is read
    again and an unchanged one is never opened twice.  Its text rows are a partition of
    ``stage/rows``; only when they are written is it listed in ``stage/archives``, and a run that
    died before is repeated over its own files.  Archives without the member are listed too.
    """
    names, rows_at, list_at = list(columns), f"{stage.rstrip('/')}/rows", f"{stage.rstrip('/')}/archives"
    landed = cut_lineage(_versions(spark, folder, glob))  # one listing for all that follows
    try:
        staged = spark.read.parquet(list_at)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        staged = spark.createDataFrame([], landed.schema)
    new = landed.join(staged.select(_ARCHIVE).distinct(), _ARCHIVE, "left_anti").select("path", _ARCHIVE)
    n = new.count()
    if n:

        def read_new(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, version in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    stem = posixpath.basename(path).rsplit(".", 1)[0]
                    for block in _text_batches(path, names, choose, block_bytes):
                        for start in range(0, len(block), BATCH_ROWS):
                            rows = block.slice(start, BATCH_ROWS)
                            ends = [pa.array([x] * len(rows), pa.string()) for x in (stem, version)]
                            yield pa.RecordBatch.from_arrays([ends[0], *rows.columns, ends[1]], names=["source_file", *names, _ARCHIVE])

        text = T.StructType([T.StructField(c, T.StringType()) for c in ("source_file", *names, _ARCHIVE)])
        # An explicit number of partitions, so that few paths are not put together into one task.
        (new.repartition(n, "path").mapInArrow(read_new, text).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(_ARCHIVE).parquet(rows_at))
        new.write.mode("append").parquet(list_at)
    return landed


def read_staged_csv(
    spark: SparkSession,
    folder: str,
    stage: str,
    schema: T.StructType,
    choose: Callable[[list[str]], str | None] = certificates_member,
    glob: str = "*.zip",
    strict: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """As :func:`read_zipped_csv`, from members staged as Parquet that Spark can split.

    Rows of archives that are gone or were replaced stay in the stage but are not read.  A value
    that does not fit its type fails the job, or becomes NULL with ``strict=False``.
    """
    landed = stage_archives(spark, folder, stage, schema.fieldNames(), choose, glob, block_bytes)
    typed = T.StructType([T.StructField("source_file", T.StringType()), *schema.fields])
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in typed.fields] + [T.StructField(_ARCHIVE, T.StringType())])
    try:
        rows = spark.read.schema(text).parquet(f"{stage.rstrip('/')}/rows").join(landed.select(_ARCHIVE), _ARCHIVE, "left_semi")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], text)
    return _cast_or_fail(rows, typed) if strict else cast_to_schema(rows, typed)


# Workers get these functions with their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
