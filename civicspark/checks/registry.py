"""Where checks are registered, and how they read their tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The casts that both sides of a check apply, by its name.
CASTS: dict[str, dict[str, str]] = {}


def check(
    name: str, sql: str, doubles: Sequence[str] = (), texts: Sequence[str] = ()
) -> Callable[[Query], Query]:
    """Register a query, and the SQL whose result it must equal.

    Decimals (``doubles``) and dates (``texts``) leave both engines in plain types, because
    the frames the engines hand out hold those two types in different ways.
    """
    casts = {**dict.fromkeys(doubles, "double"), **dict.fromkeys(texts, "string")}

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"check {name} registered twice")

        @wraps(query)
        def plain_types(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = query(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast(kind) for c, kind in casts.items()})

        QUERIES[name] = plain_types if casts else query
        CASTS[name] = casts
        ORACLES[name] = plain(sql)
        if casts:
            replaced = ", ".join(f'cast("{c}" AS {kind}) AS "{c}"' for c, kind in casts.items())
            ORACLES[name] = f"SELECT * REPLACE ({replaced}) FROM ({ORACLES[name]})"
        return query

    return register


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole test table.  Its schema is inferred once; inference is a job of its own."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
_TABLE_MARK = re.compile(r"\{(" + "|".join(TABLES) + r")\}")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Input frame from SQL that both engines run as it is; tables are marked ``{name}``."""
    names = set(_TABLE_MARK.findall(sql))
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def plain(sql: str) -> str:
    """The same SQL with bare table names."""
    return _TABLE_MARK.sub(r"\1", sql).strip()
