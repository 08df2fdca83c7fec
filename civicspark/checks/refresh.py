"""Upserts, the incremental file stream and an end-to-end run."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.checks import inputs
from civicspark.checks.files import _CERTIFICATES, _certificate_rows, _land_csv, _land_documents
from civicspark.checks.registry import check, derive, table
from civicspark.functions.names import apply_names, hyphen_lower
from civicspark.plans.certificates import (
    certificate_updates, refresh_certificate_table, refresh_certificates,
)
from civicspark.plans.etl import build_tables, extract_all, run_full_etl
from civicspark.plans.views import Region
from civicspark.session import scratch_path
from civicspark.sources.keyed import KeyedTable
from civicspark.sources.sinks import export_csv, upsert_by_key
from civicspark.streaming.refresh import refresh_keyed_table, refresh_table

_BASE = """SELECT o_orderkey AS LMK_KEY, o_orderstatus AS STATUS, o_totalprice AS PRICE,
    cast(o_orderdate AS date) AS LODGED FROM {orders} WHERE o_orderkey % 5 <> 0"""
# Changed keys, new keys, and keys the batch itself repeats.
_BATCH = """SELECT o_orderkey AS LMK_KEY, 'new' AS STATUS, o_totalprice + 1 AS PRICE,
    cast(o_orderdate AS date) AS LODGED FROM {orders} WHERE o_orderkey % 5 < 2
UNION ALL SELECT o_orderkey, 'late', o_totalprice + 2, cast('2030-01-01' AS date)
    FROM {orders} WHERE o_orderkey % 10 = 1"""
_UPSERTED = f"""
WITH base AS ({_BASE}), batch AS ({_BATCH}),
winners AS (SELECT LMK_KEY, STATUS, PRICE, LODGED FROM
    (SELECT *, row_number() OVER (PARTITION BY LMK_KEY ORDER BY LODGED DESC) AS nth FROM batch)
    WHERE nth = 1)
SELECT * FROM base WHERE LMK_KEY NOT IN (SELECT LMK_KEY FROM winners)
UNION ALL SELECT * FROM winners"""


@check("upsert_by_key", _UPSERTED, texts=["LODGED"])
def upserted(spark, sf_dir):
    """Columns of the batch come hyphenated and in another order."""
    batch = derive(spark, sf_dir, _BATCH).select(
        F.col("LODGED").alias("lodged"), F.col("STATUS").alias("status"),
        F.col("PRICE").alias("price"), F.col("LMK_KEY").alias("lmk-key"),
    )
    return upsert_by_key(
        derive(spark, sf_dir, _BASE), certificate_updates([batch]), "LMK_KEY", ["LODGED"]
    )


@check("stream_refresh", _UPSERTED, texts=["LODGED"])
def stream_refresh(spark, sf_dir):
    """The same upsert through a file stream in two runs, each with its new files only."""
    landed, updates, checkpoint, target = (
        scratch_path(spark, name) for name in ("landed", "updates", "stream", "refreshed")
    )
    batch = derive(spark, sf_dir, _BATCH)
    base = derive(spark, sf_dir, _BASE)
    for run, part in enumerate((batch.where("STATUS = 'new'"), batch.where("STATUS = 'late'"))):
        # A stream lists one folder level; each run lands its files as a sub-folder.
        export_csv(part, f"{landed}/run={run}")
        result = refresh_table(
            spark, base, f"{landed}/run=*", batch.schema, updates, checkpoint,
            f"{target}/{run}", order=["LODGED"],
        )
    return result


@check("upsert_into_buckets", _UPSERTED, texts=["LODGED"])
def upsert_into_buckets(spark, sf_dir):
    """The same upsert into a table laid out by key, in place."""
    made = KeyedTable.create(derive(spark, sf_dir, _BASE), scratch_path(spark, "keyed"), "LMK_KEY", 16)
    return made.upsert(derive(spark, sf_dir, _BATCH), ["LODGED"]).read()


@check("stream_into_buckets", _UPSERTED, texts=["LODGED"])
def stream_into_buckets(spark, sf_dir):
    """Three runs of a stream into a keyed table; each goes on where its record says,
    the last finds nothing new."""
    landed, updates, checkpoint, root = (
        scratch_path(spark, name) for name in ("landed", "updates", "stream", "keyed")
    )
    batch = derive(spark, sf_dir, _BATCH)
    KeyedTable.create(derive(spark, sf_dir, _BASE), root, "LMK_KEY", 16, high_water_column="LODGED")
    for run, part in enumerate((batch.where("STATUS = 'new'"), batch.where("STATUS = 'late'"), None)):
        if part is not None:
            export_csv(part, f"{landed}/run={run}")
        result = refresh_keyed_table(
            spark, root, f"{landed}/run=*", batch.schema, updates, checkpoint, order=["LODGED"]
        )
    return result.read()


_REFRESHED_BASE = f"SELECT * FROM ({_CERTIFICATES}) WHERE LODGEMENT_DATE < date '1999-01-15'"
# Every tenth certificate was lodged again two years later.
_REFRESHED_PAGES = """SELECT 'K' || cast(o_orderkey AS string) AS LMK_KEY,
    'A' || cast(o_custkey % 25 AS string) AS LOCAL_AUTHORITY, 'new' AS ADDRESS1,
    cast(CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 24 MONTH ELSE o_orderdate END AS date)
        AS LODGEMENT_DATE, cast(o_totalprice AS decimal(10,2)) AS TOTAL_FLOOR_AREA
FROM {orders}"""


_REFRESHED = f"""
WITH base AS ({_REFRESHED_BASE}),
pages AS (SELECT * FROM ({_REFRESHED_PAGES}) WHERE LODGEMENT_DATE < date '2000-07-01' AND LODGEMENT_DATE
    >= (SELECT date_trunc('month', max(LODGEMENT_DATE)) + INTERVAL 1 MONTH FROM base)
    AND LOCAL_AUTHORITY IN ('A3', 'A4', 'A5'))
SELECT * FROM base WHERE LMK_KEY NOT IN (SELECT LMK_KEY FROM pages) UNION ALL SELECT * FROM pages
"""


@check("refreshed_certificates", _REFRESHED, doubles=["TOTAL_FLOOR_AREA"], texts=["LODGEMENT_DATE"])
def refreshed_certificates(spark, sf_dir):
    """Pages from the month after the table's latest, upserted into a new path."""
    landed = scratch_path(spark, "pages")
    export_csv(apply_names(_certificate_rows(spark, sf_dir, _REFRESHED_PAGES), hyphen_lower), landed)
    table_now = refresh_certificates(
        spark, _certificate_rows(spark, sf_dir, _REFRESHED_BASE), landed,
        scratch_path(spark, "refreshed"), la_codes=["A3", "A4", "A5"], to_period=(2000, 6),
    )
    return table_now.select(
        "LMK_KEY", "LOCAL_AUTHORITY", "ADDRESS1", "LODGEMENT_DATE", "TOTAL_FLOOR_AREA"
    )


@check("refreshed_certificate_table", _REFRESHED, doubles=["TOTAL_FLOOR_AREA"], texts=["LODGEMENT_DATE"])
def refreshed_certificate_table(spark, sf_dir):
    """The same pages into a keyed table, from the month its record names."""
    landed, root = scratch_path(spark, "pages"), scratch_path(spark, "keyed")
    export_csv(apply_names(_certificate_rows(spark, sf_dir, _REFRESHED_PAGES), hyphen_lower), landed)
    KeyedTable.create(
        _certificate_rows(spark, sf_dir, _REFRESHED_BASE), root, "LMK_KEY", 16, "LODGEMENT_DATE"
    )
    table_now = refresh_certificate_table(
        spark, root, landed, la_codes=["A3", "A4", "A5"], to_period=(2000, 6)
    )
    return table_now.read().select(
        "LMK_KEY", "LOCAL_AUTHORITY", "ADDRESS1", "LODGEMENT_DATE", "TOTAL_FLOOR_AREA"
    )


def _land_sources(spark, sf_dir) -> str:
    """Landed files of an end-to-end run, derived from the test tables."""
    root = scratch_path(spark, "landing")
    customers = table(spark, sf_dir, "customer")
    for layer, area in (("lsoa_2021_pwc", "LSOA21CD"), ("lsoa_2021_boundaries", "LSOA21CD"),
                        ("lsoa_2011_boundaries", "LSOA11CD")):
        _land_documents(
            customers, f"{root}/{layer}", "c_custkey",
            attributes=f"struct('L' || cast(c_custkey AS string) AS {area}, 'g' AS GlobalID)",
            geometry="struct(c_acctbal AS x, cast(c_nationkey AS double) AS y)",
        )
    for layer in ("lsoa_2021_lookups", "lsoa_2011_lookups"):
        _land_documents(
            customers, f"{root}/{layer}", "c_custkey",
            attributes="struct('L' || cast(c_custkey AS string) AS LSOACD, c_nationkey AS LAD)",
        )
    _land_documents(
        table(spark, sf_dir, "nation"), f"{root}/ca_la_lookup", "n_nationkey",
        # Codes of other regions are none of the other sources' authorities.
        attributes="struct(n_nationkey AS ObjectId, CASE n_regionkey WHEN 3 THEN 'A' ELSE 'B' END "
        "|| cast(n_nationkey AS string) AS LAD25CD, n_name AS LAD25NM, 'C' || cast(n_regionkey AS string) "
        "AS CAUTH25CD, CASE n_regionkey WHEN 3 THEN 'EUROPE' ELSE 'OTHER' END AS CAUTH25NM)",
    )
    _land_documents(
        table(spark, sf_dir, "supplier"), f"{root}/ca_boundaries_2025", "s_suppkey",
        properties="struct(s_name AS CAUTH25NM)",
        geometry="struct('Polygon' AS type, array(array(array(s_acctbal, 1D))) AS coordinates)",
    )
    orders = table(spark, sf_dir, "orders")
    _land_csv(
        orders.select(
            F.col("o_custkey").alias("local_authority_id"),
            F.concat(F.lit("A"), F.col("o_custkey") % 25).alias("local_authority_code"),
            F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("vehicles"),
        ), f"{root}/dft_traffic",
    )
    _land_csv(derive(spark, sf_dir, inputs.SUBSECTORS), f"{root}/ghg_emissions")
    _land_csv(
        customers.select(
            F.concat(F.lit("L"), F.col("c_custkey") * 2).alias("lsoa21_code"), "c_acctbal"
        ), f"{root}/imd_2025",
    )
    return root


_IN_REGION = "o_custkey % 25 IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey = 3)"


@check("full_run_inventory", f"""
SELECT 'ca_la_lookup' AS table_name, count(*) + 1 AS n_rows FROM {{nation}}
UNION ALL SELECT 'lsoa_2021_pwc', count(*) FROM {{customer}}
UNION ALL SELECT 'imd_2025', count(*) FROM {{customer}} WHERE c_custkey * 2 IN (SELECT c_custkey FROM {{customer}})
UNION ALL SELECT 'dft_la_lookup', count(*) FROM {{orders}} WHERE {_IN_REGION}
    AND year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM {{orders}})
UNION ALL SELECT 'ghg_emissions', count(*) FROM (SELECT DISTINCT o_custkey % 225, o_custkey % 25,
    year(o_orderdate), o_orderpriority, o_orderstatus, o_totalprice FROM {{orders}} WHERE {_IN_REGION})
""")
def full_run_inventory(spark, sf_dir):
    """Landed files to clean tables, then the inventory."""
    report = run_full_etl(
        spark, _land_sources(spark, sf_dir), scratch_path(spark, "warehouse"),
        extra_la_rows=[
            {"ladcd": "A99", "ladnm": "Extra", "cauthcd": "C3", "cauthnm": "EUROPE"}
        ],
        multi_line=False,
    )
    return report.raise_if_failed().inventory()


@check("extract_inventory", """
SELECT 'dft_traffic' AS table_name, count(*) AS n_rows FROM {orders}
UNION ALL SELECT 'ghg_emissions', count(*) FROM {orders}
UNION ALL SELECT 'imd_2025', count(*) FROM {customer}
""")
def extract_inventory(spark, sf_dir):
    """Extraction only, without geography."""
    landing = _land_sources(spark, sf_dir)
    warehouse = scratch_path(spark, "warehouse")
    return extract_all(spark, landing, warehouse, geography=False, multi_line=False).inventory()


@check("built_tables_view", f"""
WITH emissions AS ({inputs.EMISSIONS}), lookup AS ({inputs.LOOKUP})
SELECT calendar_year, cauthnm AS area, cast(sum(grand_total) AS double)
    / nullif(cast(sum(population_000s_mid_year_estimate) AS double), 0) AS per_cap
FROM emissions JOIN lookup ON local_authority_code = ladcd GROUP BY 1, 2
""")
def built_tables_view(spark, sf_dir):
    """All tables written and their keys checked; a view over them is read."""
    built = build_tables(
        spark,
        {
            "epc_domestic": derive(spark, sf_dir, inputs.DOMESTIC),
            "epc_nondom": derive(spark, sf_dir, inputs.NON_DOMESTIC),
            "postcodes": derive(spark, sf_dir, inputs.POSTCODES),
            "tenure": derive(spark, sf_dir, inputs.TENURE),
            "imd_lsoa": derive(spark, sf_dir, inputs.DEPRIVATION),
            "ca_la": derive(spark, sf_dir, inputs.LOOKUP),
            "emissions": derive(spark, sf_dir, inputs.EMISSIONS),
            "ghg_emissions": derive(spark, sf_dir, inputs.SUBSECTORS),
        },
        scratch_path(spark, "warehouse"),
        Region("EUROPE"),
    )
    if built.views.failed:
        raise RuntimeError(f"views failed: {built.views.failed}")
    return built.views.views["per_cap_emissions_ca_national_vw"]
