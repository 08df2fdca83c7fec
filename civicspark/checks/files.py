"""Readers and writers: whole tables go out to files of each format and come back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Collection

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.checks.registry import check, derive, table
from civicspark.functions.names import apply_names, hyphen_lower
from civicspark.operators.filters import in_codes
from civicspark.plans.emissions import tenure_wide
from civicspark.schemas import DOMESTIC_CERTIFICATES
from civicspark.session import scratch_path
from civicspark.sources.archives import (
    only_csv_under_data, read_staged_csv, read_zipped_csv, store_of,
)
from civicspark.sources.files import (
    read_certificate_pages, read_csv, read_csv_inferred, read_csv_lenient, read_feature_layers,
    read_features, read_geojson, read_landed_csv, read_parquet,
)
from civicspark.sources.sinks import (
    export_csv, export_tables, read_codes, replace_table, write_codes,
)


@check("csv_round_trip", """
SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM {documents}
""")
def csv_round_trip(spark, sf_dir):
    """Whole texts with quotes and line breaks through CSV."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-csv")
    export_csv(documents, path)
    return read_csv(spark, path, documents.schema)


_TYPED = """SELECT l_orderkey, l_linenumber, l_extendedprice,
    CASE WHEN l_linenumber < 10 THEN '0' || cast(l_linenumber AS string) ELSE 'x' END AS ruc11ind,
    l_shipdate, l_returnflag FROM {lineitem}"""


@check("csv_inferred_override", f"""
SELECT cast(l_orderkey AS integer) AS l_orderkey, l_linenumber, l_extendedprice, ruc11ind,
    cast(l_shipdate AS date) AS l_shipdate, l_returnflag FROM ({_TYPED})
""", texts=["l_shipdate"])
def csv_inferred_override(spark, sf_dir):
    """Inferred types; the overridden code column keeps its leading zeros."""
    path = scratch_path(spark, "lineitem-csv")
    typed = derive(spark, sf_dir, _TYPED).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    export_csv(typed, path)
    return read_csv_inferred(spark, path, {"ruc11ind": "string"}, multi_line=False)


_BAD_CELLS = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'bad' ELSE cast(user_id AS string) END AS rating,
    event_type FROM {events}"""


@check("csv_lenient", f"""
SELECT event_id, try_cast(rating AS integer) AS rating, event_type FROM ({_BAD_CELLS})
""")
def csv_lenient(spark, sf_dir):
    """A bad cell is NULL, its row stays."""
    path = scratch_path(spark, "events-csv")
    export_csv(derive(spark, sf_dir, _BAD_CELLS), path)
    return read_csv_lenient(spark, path, "event_id bigint, rating int, event_type string")


@check("landed_csv_sample", "SELECT least(count(*), 1000) AS n_rows FROM {lineitem}")
def landed_csv_sample(spark, sf_dir):
    """O1: the row limit of a sample run (any rows, so their number is checked)."""
    path = scratch_path(spark, "landed-csv")
    export_csv(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), path)
    return read_landed_csv(spark, path, 1000, multi_line=False).agg(F.count(F.lit(1)).alias("n_rows"))


_LANDED = """SELECT 'A' || cast(o_custkey % 25 AS string) AS local_authority_code,
    cast(year(o_orderdate) AS int) AS year, o_orderkey AS count_point_id,
    o_orderpriority AS direction_of_travel, o_totalprice AS all_motor_vehicles FROM {orders}"""


@check("landed_csv", _LANDED)
def landed_csv(spark, sf_dir):
    """A landed source with inferred types, every row and value, no limit."""
    path = scratch_path(spark, "landed-csv")
    export_csv(derive(spark, sf_dir, _LANDED), path)
    landed = read_landed_csv(spark, path, multi_line=False)
    return landed.withColumn("count_point_id", F.col("count_point_id").cast("bigint"))


_TENURE_LONG = """SELECT 'Area ' || cast(l_orderkey AS string) AS GEOGRAPHY_NAME,
    'L' || cast(l_orderkey AS string) AS GEOGRAPHY_CODE,
    CASE l_linenumber WHEN 1 THEN 'Total: All households' WHEN 2 THEN 'Owned' WHEN 3 THEN 'Social rented'
        WHEN 4 THEN 'Private rented' WHEN 5 THEN 'Shared ownership' WHEN 6 THEN 'Rent free' ELSE 'Other' END
        AS C2021_TENURE_9_NAME,
    l_linenumber AS C2021_TENURE_9_SORTORDER, cast(sum(l_quantity) AS bigint) AS OBS_VALUE
FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""
_TENURES = ("Total: All households", "Owned", "Social rented", "Private rented", "Shared ownership", "Rent free", "Other")
_TENURE_COLUMNS = (
    "total_all_households", "owned", "social_rented", "private_rented", "shared_ownership", "rent_free", "other")


_TENURE_SQL = ", ".join(
    f"max(OBS_VALUE) FILTER (C2021_TENURE_9_SORTORDER = {n}) AS {c}" for n, c in enumerate(_TENURE_COLUMNS, 1))


@check("landed_tenure", f"""
SELECT GEOGRAPHY_NAME AS lsoa_name, GEOGRAPHY_CODE AS lsoa21cd, {_TENURE_SQL}
FROM ({_TENURE_LONG}) GROUP BY 1, 2
""")
def landed_tenure(spark, sf_dir):
    """A landed census table, long form, with all its categories to one row per area."""
    path = scratch_path(spark, "tenure-csv")
    export_csv(derive(spark, sf_dir, _TENURE_LONG), path)
    wide = tenure_wide(
        read_landed_csv(spark, path, multi_line=False),
        _TENURES,
    )
    return wide.select(
        "lsoa_name", "lsoa21cd", *[F.col(c).cast("bigint").alias(c) for c in _TENURE_COLUMNS]
    )


@check("parquet_round_trip", "SELECT l_orderkey, l_quantity, l_shipdate FROM {lineitem} WHERE l_returnflag = 'R'")
def parquet_round_trip(spark, sf_dir):
    """A replaced table; the filter prunes its partitions."""
    path = scratch_path(spark, "lineitem-parquet")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_shipdate", "l_returnflag"
    )
    replace_table(lines, path, ["l_returnflag"])
    replace_table(lines, path, ["l_returnflag"])
    return read_parquet(spark, path).where("l_returnflag = 'R'").drop("l_returnflag")


@check("exported_tables", """
SELECT c_custkey, c_name, n_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
""")
def exported_tables(spark, sf_dir):
    """K4: tables exported under one root and joined from there."""
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "nation")}
    paths = export_tables(tables, scratch_path(spark, "export"))
    customer, nation = (read_parquet(spark, paths[name]) for name in ("customer", "nation"))
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "c_name", "n_name")


@check("code_list_file", """
SELECT event_id, user_id FROM {events} WHERE user_id IN
    (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING')
""")
def code_list_file(spark, sf_dir):
    """K6: codes written as JSON, read back and used as a filter."""
    path = scratch_path(spark, "codes-json")
    building = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    codes = building.select(F.col("c_custkey").cast("string").alias("code"))
    write_codes(codes, "code", path)
    wanted = read_codes(spark, path, "code").select(F.col("code").cast("bigint"))
    return in_codes(table(spark, sf_dir, "events").select("event_id", "user_id"), "user_id", wanted)


def _land_documents(
    df: DataFrame, path: str, key: str, per_page: int = 2000, **members: str
) -> None:
    """Land rows as JSON documents ``{"features": [...]}``, a bounded number to a document
    and one document to a line."""
    feature = F.struct(*[F.expr(e).alias(name) for name, e in members.items()])
    pages = (
        df.select(feature.alias("feature"), F.floor(F.col(key) / per_page).alias("page"))
        .groupBy("page")
        .agg(F.collect_list("feature").alias("features"))
        .select(F.to_json(F.struct("features")).alias("document"))
    )
    pages.write.mode("overwrite").text(path)


@check("features_unnest", """
SELECT c_name AS name, c_custkey AS id, c_acctbal AS x, cast(c_nationkey AS double) AS y FROM {customer}
""")
def features_unnest(spark, sf_dir):
    """Feature pages with point geometry; the global id is left out."""
    root = scratch_path(spark, "layers")
    _land_documents(
        table(spark, sf_dir, "customer"), f"{root}/centroids", "c_custkey",
        attributes="struct(c_name AS name, c_custkey AS id, 'g' AS GlobalID)",
        geometry="struct(c_acctbal AS x, cast(c_nationkey AS double) AS y)",
    )
    return read_feature_layers(spark, root, {"centroids": True}, multi_line=False)["centroids"]


@check("features_flat", "SELECT o_orderkey AS id, o_orderstatus AS status FROM {orders}")
def features_flat(spark, sf_dir):
    """Feature pages without geometry."""
    path = scratch_path(spark, "flat")
    _land_documents(
        table(spark, sf_dir, "orders"), path, "o_orderkey",
        attributes="struct(o_orderkey AS id, o_orderstatus AS status)",
    )
    return read_features(spark, path, with_geometry=False, multi_line=False)


@check("geojson_scan", """
SELECT s_name AS CAUTHNM, 'Polygon' AS geometry_type, s_acctbal AS west, 4 AS corners FROM {supplier}
""")
def geojson_scan(spark, sf_dir):
    """Polygons with their properties."""
    path = scratch_path(spark, "geojson")
    ring = "array(array(s_acctbal, 1D), array(9D, 1D), array(9D, 9D), array(s_acctbal, 1D))"
    _land_documents(
        table(spark, sf_dir, "supplier"), path, "s_suppkey",
        properties="struct(s_name AS CAUTHNM)",
        geometry=f"struct('Polygon' AS type, array({ring}) AS coordinates)",
    )
    shapes = read_geojson(spark, path, multi_line=False)
    outer = F.col("coordinates")[0]
    return shapes.select(
        "CAUTHNM", "geometry_type", outer[0][0].alias("west"), F.size(outer).alias("corners")
    )


def _csv_field(field: T.StructField) -> Column:
    """A value as ``export_csv`` writes it; NULL is empty."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    else:
        text = value.cast("string")
    if isinstance(field.dataType, T.StringType):
        doubled = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        quoted = (text == "") | text.contains(",") | text.contains('"') | text.contains("\n") | text.contains("\r")
        text = F.when(quoted, doubled).otherwise(text)
    return F.coalesce(text, F.lit(""))


def _land_csv(df: DataFrame, path: str, empty: Collection[str] = ()) -> None:
    """Land rows as the CSV parts that ``export_csv`` would write, each with its header.

    The lines are one expression over the columns; the commas of ``empty`` ones, NULL in every
    row, are put together beforehand.  The first row of a task carries the header.
    """
    if df.isEmpty():
        export_csv(df, path)
        return
    pieces, commas = [], ""
    for n, f in enumerate(df.schema.fields):
        commas += "," if n else ""
        if f.name not in empty:
            pieces += [F.lit(commas), _csv_field(f)]
            commas = ""
    line = F.concat(*pieces, F.lit(commas))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit(",".join(df.columns) + "\n")
    df.select(F.when(first, F.concat(header, line)).otherwise(line).alias("line")).write.mode("overwrite").text(path)


_CERTIFICATES = """SELECT 'K' || cast(o_orderkey AS string) AS LMK_KEY,
    'A' || cast(o_custkey % 25 AS string) AS LOCAL_AUTHORITY, o_orderpriority AS ADDRESS1,
    cast(o_orderdate AS date) AS LODGEMENT_DATE, cast(o_totalprice AS decimal(10,2)) AS TOTAL_FLOOR_AREA
FROM {orders}"""


def _certificate_rows(spark: SparkSession, sf_dir: str, sql: str = _CERTIFICATES) -> DataFrame:
    """All 93 columns; those the derived rows do not have are NULL."""
    rows = derive(spark, sf_dir, sql)
    return rows.select([
        F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in DOMESTIC_CERTIFICATES.fields
    ])


@check("certificate_pages", f"""
SELECT LMK_KEY, LOCAL_AUTHORITY, ADDRESS1, LODGEMENT_DATE, TOTAL_FLOOR_AREA FROM ({_CERTIFICATES})
WHERE LOCAL_AUTHORITY = 'A4'
    AND year(LODGEMENT_DATE) * 12 + month(LODGEMENT_DATE) BETWEEN 1997 * 12 + 3 AND 1999 * 12 + 1
""", doubles=["TOTAL_FLOOR_AREA"], texts=["LODGEMENT_DATE"])
def certificate_pages(spark, sf_dir):
    """Landed pages, each with its header, by authority and month range; a listed
    path that does not exist takes nothing from the others, and files are split."""
    path = scratch_path(spark, "pages")
    export_csv(apply_names(_certificate_rows(spark, sf_dir), hyphen_lower), path)
    pages = read_certificate_pages(
        spark, [path, path + "-absent"], "domestic", "A4", (1997, 3), (1999, 1), multi_line=False
    )
    return apply_names(pages, lambda n: n.upper().replace("-", "_")).select(
        "LMK_KEY", "LOCAL_AUTHORITY", "ADDRESS1", "LODGEMENT_DATE", "TOTAL_FLOOR_AREA"
    )


def _zip_partitions(member: str, folder: str):
    """Task function: each partition becomes one archive with one CSV member."""

    def write_archive(batches):
        store, inner = store_of(folder)
        store.create_dir(inner, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}"
        rows = 0
        with store.open_output_stream(f"{inner}/{name}.zip") as sink:
            with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("schema.json", "{}")
                with archive.open(member, "w", force_zip64=True) as raw:
                    text = io.TextIOWrapper(raw, encoding="utf-8", newline="")
                    for batch in batches:
                        batch.to_csv(text, index=False, header=rows == 0, lineterminator="\n", chunksize=500)
                        rows += len(batch)
                    text.flush()
        yield pd.DataFrame({"archive": [name], "n_rows": [rows]})

    return write_archive


def _land_archives(df: DataFrame, member: str, key: str, folder: str) -> None:
    """One archive per partition; the partitions grow with the table."""
    df.repartition(key).mapInPandas(
        _zip_partitions(member, folder), "archive string, n_rows bigint"
    ).write.mode("overwrite").parquet(folder + "-log")


@check("zipped_csv", """
SELECT doc_id, nullif(text, '') AS text, lang, n_chars FROM {documents}
""")
def zipped_csv(spark, sf_dir):
    """Whole texts out of ZIP archives."""
    folder = scratch_path(spark, "zips")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    _land_archives(documents, "certificates.csv", "doc_id", folder)
    return read_zipped_csv(spark, folder, documents.schema, strict=True).drop("source_file")


@check("zipped_data_folder", """
SELECT c_custkey, c_name, cast(c_acctbal AS decimal(10,2)) AS c_acctbal FROM {customer}
""", doubles=["c_acctbal"])
def zipped_data_folder(spark, sf_dir):
    """The single CSV under ``Data/`` of each archive, typed leniently."""
    folder = scratch_path(spark, "zips")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(10,2)").alias("c_acctbal")
    )
    _land_archives(customers, "Data/customers.csv", "c_custkey", folder)
    archives = read_zipped_csv(spark, folder, customers.schema, only_csv_under_data)
    return archives.drop("source_file")


@check("zipped_staged", """
SELECT doc_id, nullif(text, '') AS text, lang, n_chars FROM {documents}
""")
def zipped_staged(spark, sf_dir):
    """Whole texts through the stage of archives; the second read finds all of them there."""
    folder, stage = scratch_path(spark, "zips"), scratch_path(spark, "stage")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    _land_archives(documents, "certificates.csv", "doc_id", folder)
    for _ in range(2):
        rows = read_staged_csv(spark, folder, stage, documents.schema)
    return rows.drop("source_file")


@check("zipped_data_staged", """
SELECT c_custkey, c_name, cast(c_acctbal AS decimal(10,2)) AS c_acctbal FROM {customer}
""", doubles=["c_acctbal"])
def zipped_data_staged(spark, sf_dir):
    """The single CSV under ``Data/`` of each archive, staged and typed strictly."""
    folder, stage = scratch_path(spark, "zips"), scratch_path(spark, "stage")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(10,2)").alias("c_acctbal")
    )
    _land_archives(customers, "Data/customers.csv", "c_custkey", folder)
    return read_staged_csv(spark, folder, stage, customers.schema, only_csv_under_data).drop("source_file")
