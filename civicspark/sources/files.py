"""CSV, Parquet, feature JSON and GeoJSON readers.

Readers only declare a scan.  Where a schema has to be inferred, the docstring says so;
inference reads the files once, so pass or persist a schema for repeated runs.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.functions.scalars import require_certificate_type
from civicspark.operators.columns import drop_if_present, quoted
from civicspark.operators.filters import in_months
from civicspark.operators.sets import first_rows
from civicspark.schemas import POSTCODE_OVERRIDES, page_schema
from civicspark.streaming.periods import previous_month

log = logging.getLogger(__name__)

_QUOTING = {"header": True, "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    multi_line: bool = True,
) -> DataFrame:
    """Files with a full declared schema.

    Spark matches CSV columns by position, so the header is checked and a file with other
    or reordered columns fails, and so does a cell that does not fit its type or a line with
    more or fewer fields.  A field may hold quoted line breaks; where none does,
    ``multi_line=False`` lets Spark split large files over tasks.
    """
    return spark.read.csv(
        path, schema=schema, enforceSchema=False, mode="FAILFAST", multiLine=multi_line, **_QUOTING
    )


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths, or patterns, under which something lies; the others are logged."""
    found = []
    for path in paths:
        try:
            spark.read.text(path)
            found.append(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("Nothing landed at %s", path)
    return found


def infer_csv_schema(
    spark: SparkSession,
    path: str | list[str],
    overrides: Mapping[str, str] | None = None,
    sampling_ratio: float | None = None,
    multi_line: bool = True,
) -> T.StructType:
    """Inferred schema with some types set by hand (runs a job)."""
    inferred = spark.read.csv(
        path, inferSchema=True, samplingRatio=sampling_ratio, multiLine=multi_line, **_QUOTING
    ).schema
    fixed = {k.lower(): v for k, v in (overrides or {}).items()}
    return T.StructType(
        [
            T.StructType.fromDDL(f"`{f.name}` {fixed[f.name.lower()]}")[0]
            if f.name.lower() in fixed
            else f
            for f in inferred.fields
        ]
    )


def read_csv_inferred(
    spark: SparkSession,
    path: str | list[str],
    overrides: Mapping[str, str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Inferred types; an overridden column is read as that type from the start,
    so codes such as ``01`` keep their zeros."""
    return read_csv(
        spark, path, infer_csv_schema(spark, path, overrides, multi_line=multi_line), multi_line
    )


def read_csv_lenient(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    multi_line: bool = True,
) -> DataFrame:
    """A cell that does not fit its type becomes NULL and the row stays."""
    return spark.read.csv(
        path, schema=schema, enforceSchema=False, mode="PERMISSIVE", multiLine=multi_line, **_QUOTING
    )


def read_postcodes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S2 with the directory's fixed overrides."""
    return read_csv_inferred(spark, path, POSTCODE_OVERRIDES)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """S6, S18."""
    return spark.read.parquet(*paths)


def read_features(
    spark: SparkSession,
    path: str | list[str],
    with_geometry: bool = True,
    drop: Iterable[str] = ("GlobalID",),
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Landed pages of ``{"features": [{"attributes": ..., "geometry": ...}]}``.

    One row per feature; attributes, and on request the geometry fields, become columns.
    A file is one page; with ``multi_line=False`` it holds a page per line, so that many
    pages share a file and Spark can split it.  The schema is inferred unless given.
    """
    reader = spark.read.option("multiLine", multi_line)
    pages = (reader.schema(schema) if schema else reader).json(path)
    features = pages.select(F.explode("features").alias("feature"))
    columns = ["feature.attributes.*"] + (["feature.geometry.*"] if with_geometry else [])
    return drop_if_present(features.select(*columns), *drop)


def read_feature_layers(
    spark: SparkSession, root: str, layers: Mapping[str, bool], multi_line: bool = True
) -> dict[str, DataFrame]:
    """Several landed layers under one root, given as name -> has geometry."""
    return {
        name: read_features(
            spark, f"{root.rstrip('/')}/{name}", with_geometry, multi_line=multi_line
        )
        for name, with_geometry in layers.items()
    }


def read_geojson(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """One row per feature: its properties, ``geometry_type`` and ``coordinates``."""
    reader = spark.read.option("multiLine", multi_line)
    documents = (reader.schema(schema) if schema else reader).json(path)
    return documents.select(F.explode("features").alias("feature")).select(
        "feature.properties.*",
        F.col("feature.geometry.type").alias("geometry_type"),
        F.col("feature.geometry.coordinates").alias("coordinates"),
    )


def read_landed_csv(
    spark: SparkSession,
    path: str | list[str],
    row_limit: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """A landed open-data CSV with inferred types, on request only some rows."""
    return first_rows(read_csv_inferred(spark, path, multi_line=multi_line), row_limit)


def read_certificate_pages(
    spark: SparkSession,
    path: str | list[str],
    cert_type: str = "domestic",
    local_authority: str | list[str] | None = None,
    from_period: tuple[int, int] | None = None,
    to_period: tuple[int, int] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Landed certificate pages, each file with its own header.

    Filters by authority and by lodgement month, (year, month) at both ends; the default
    end is the previous month.  A path where nothing landed adds no rows; with none left the
    frame is empty and has the full schema.  ``multi_line`` as for :func:`read_csv`.
    """
    schema = page_schema(require_certificate_type(cert_type))
    paths = existing_paths(spark, [path] if isinstance(path, str) else list(path))
    if not paths:
        return spark.createDataFrame([], schema)
    pages = read_csv(spark, paths, schema, multi_line)
    if local_authority is not None:
        codes = [local_authority] if isinstance(local_authority, str) else list(local_authority)
        pages = pages.where(quoted("local-authority").isin(codes))
    if from_period is not None:
        pages = in_months(
            pages, "lodgement-date", tuple(from_period), tuple(to_period or previous_month())
        )
    return pages
