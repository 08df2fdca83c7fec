"""Schemas kept beside landed sources, so that a run infers nothing twice.

A schema is inferred when its source is first read and written as one small text file.  Every
later run takes it from there and compares it with what has landed: the header of a CSV source,
or the attributes in the first page of a feature source.  What differs is reported by column.
Each CSV file's own header and cells are checked by the read itself, which fails on a misfit;
:func:`type_drift` then names the columns whose types have changed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.sources.files import infer_csv_schema, read_csv


@dataclass(frozen=True)
class SchemaDrift:
    """How a landed source differs from its stored schema.  ``retyped`` is ``column: old -> new``."""

    missing: list[str] = field(default_factory=list)
    added: list[str] = field(default_factory=list)
    moved: list[str] = field(default_factory=list)
    retyped: list[str] = field(default_factory=list)

    def __bool__(self) -> bool:
        return bool(self.missing or self.added or self.moved or self.retyped)

    def __str__(self) -> str:
        parts = ((name, getattr(self, name)) for name in ("missing", "added", "moved", "retyped"))
        return "; ".join(f"{name}: {', '.join(columns)}" for name, columns in parts if columns)


class SchemaDriftError(ValueError):
    """A landed source no longer has the columns of its stored schema."""

    def __init__(self, source: str, drift: SchemaDrift):
        super().__init__(f"{source} differs from its stored schema - {drift}")
        self.drift = drift


def stored_schema(spark: SparkSession, store: str) -> T.StructType | None:
    """The schema written at ``store``, or None."""
    try:
        row = spark.read.text(store, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if row is None else T.StructType.fromJson(json.loads(row[0]))


def store_schema(spark: SparkSession, schema: T.StructType, store: str) -> T.StructType:
    """Write a schema; a former one is replaced."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(store)
    return schema


def compare_columns(have: Sequence[str], want: Sequence[str], ordered: bool) -> SchemaDrift:
    """Columns that are missing, new or, where the order counts, in another place."""
    common = [c for c in want if c in have]
    moved = [] if not ordered else [a for a, b in zip(common, [c for c in have if c in want], strict=True) if a != b]
    return SchemaDrift([c for c in want if c not in have], [c for c in have if c not in want], moved)


OnDrift = Callable[[str, SchemaDrift], None]


def fail_on_drift(source: str, drift: SchemaDrift) -> None:
    """The default: drift is an error that names the columns."""
    raise SchemaDriftError(source, drift)


def read_csv_stored(
    spark: SparkSession,
    path: str,
    store: str,
    overrides: Mapping[str, str] | None = None,
    multi_line: bool = True,
    on_drift: OnDrift = fail_on_drift,
) -> DataFrame:
    """A landed CSV with its stored schema; the first read infers and stores it.

    Where ``on_drift`` returns, the new schema is inferred and stored in place of the old one.
    """
    schema = stored_schema(spark, store)
    if schema is not None:
        # Without inference Spark reads no more than the first file's header here.
        header = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multi_line).columns
        drift = compare_columns(header, schema.fieldNames(), ordered=True)
        if drift:
            on_drift(path, drift)
            schema = None
    if schema is None:
        schema = store_schema(spark, infer_csv_schema(spark, path, overrides, multi_line=multi_line), store)
    return read_csv(spark, path, schema, multi_line)


def type_drift(
    spark: SparkSession, path: str, store: str, overrides: Mapping[str, str] | None = None, multi_line: bool = True
) -> tuple[SchemaDrift, T.StructType]:
    """How the types of a CSV's columns have changed, and its present schema.

    Infers anew, so it reads the source; meant for a source whose read has failed.
    """
    stored = stored_schema(spark, store)
    if stored is None:
        raise ValueError(f"No schema at {store}")
    landed = infer_csv_schema(spark, path, overrides, multi_line=multi_line)
    kinds = {f.name: f.dataType for f in landed.fields}
    changed = [
        f"{f.name}: {f.dataType.simpleString()} -> {kinds[f.name].simpleString()}"
        for f in stored.fields if f.name in kinds and kinds[f.name] != f.dataType
    ]
    return SchemaDrift(retyped=changed), landed


def infer_json_schema(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """The schema of landed JSON pages (runs a job over them)."""
    return spark.read.option("multiLine", multi_line).json(path).schema


def _leaves(kind: T.DataType, name: str = "") -> list[str]:
    """Dotted names of all fields below a type."""
    if isinstance(kind, T.ArrayType):
        return _leaves(kind.elementType, name)
    if isinstance(kind, T.StructType):
        return [leaf for f in kind.fields for leaf in _leaves(f.dataType, f"{name}.{f.name}".lstrip("."))]
    return [name]


def json_schema_stored(
    spark: SparkSession, path: str, store: str, multi_line: bool = True, on_drift: OnDrift = fail_on_drift
) -> T.StructType:
    """The stored schema of landed pages; the first page must name no other fields.

    Fields the first page lacks are not drift, since an empty page, or one whose values are all
    missing, names none.  ``on_drift`` as for :func:`read_csv_stored`.
    """
    schema = stored_schema(spark, store)
    if schema is not None:
        page = spark.read.text(path, wholetext=multi_line).first()
        if page is not None and page[0].strip():
            found = spark.range(1).select(F.schema_of_json(F.lit(page[0]))).first()[0]
            first = spark.createDataFrame([], f"page {found}").schema["page"].dataType
            known = _leaves(schema)
            added = [c for c in _leaves(first) if not any(c == k or k.startswith(f"{c}.") for k in known)]
            if added:
                on_drift(path, SchemaDrift(added=added))
                schema = None
    if schema is None:
        schema = store_schema(spark, infer_json_schema(spark, path, multi_line), store)
    return schema
