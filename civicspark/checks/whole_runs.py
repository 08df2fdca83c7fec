"""Values of end-to-end runs: every clean table of a full run, every view of a full build.

A run or build is made once per session and folder; each query reads one of its tables whole.
"""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.checks import inputs
from civicspark.checks.files import _certificate_rows, _land_csv
from civicspark.checks.refresh import _land_sources
from civicspark.checks.registry import CASTS, ORACLES, check, derive
from civicspark.functions.names import apply_names, hyphen_lower
from civicspark.plans.etl import BuildReport, RunReport, build_tables, run_full_etl
from civicspark.plans.views import Region
from civicspark.schemas import NON_DOMESTIC_CERTIFICATES
from civicspark.session import scratch_path

_made: dict[tuple[str, str, str], RunReport | BuildReport] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, make):
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _made:
        _made[key] = make(spark, sf_dir)
    return _made[key]


_LODGED = """o_orderkey, cast(o_orderdate AS date) AS LODGEMENT_DATE,
    cast(o_orderdate AS timestamp) + (o_orderkey % 86400) * INTERVAL 1 SECOND AS LODGEMENT_DATETIME,
    'A' || cast(o_custkey % 25 AS string) AS LOCAL_AUTHORITY, o_orderpriority AS ADDRESS1"""
# Customers have several certificates, of which some have no rating.
_DOMESTIC = f"""SELECT 'K' || cast(o_custkey AS string) AS LMK_KEY,
    CASE WHEN o_orderkey % 3 <> 0 THEN substr('ABCDEFG', cast(1 + o_orderkey % 7 AS int), 1) END
        AS CURRENT_ENERGY_RATING, cast(o_orderdate AS date) AS INSPECTION_DATE,
    cast(o_totalprice AS decimal(10,2)) AS TOTAL_FLOOR_AREA, {_LODGED} FROM {{orders}}"""
_NON_DOMESTIC = f"""SELECT 'N' || cast(o_custkey AS string) AS LMK_KEY,
    cast(o_orderkey % 150 AS int) AS ASSET_RATING, o_orderstatus AS BUILDING_LEVEL, {_LODGED} FROM {{orders}}"""


def _full_run(spark, sf_dir) -> RunReport:
    landing = _land_sources(spark, sf_dir)
    domestic = _certificate_rows(spark, sf_dir, _DOMESTIC)
    rows = derive(spark, sf_dir, _NON_DOMESTIC)
    non_domestic = rows.select([
        F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in NON_DOMESTIC_CERTIFICATES.fields
    ])
    for name, pages, sql in (("epc_domestic", domestic, _DOMESTIC), ("epc_nondomestic", non_domestic, _NON_DOMESTIC)):
        empty = set(pages.columns) - set(derive(spark, sf_dir, sql).columns)
        _land_csv(apply_names(pages, hyphen_lower), f"{landing}/{name}", set(map(hyphen_lower, empty)))
    return run_full_etl(
        spark, landing, scratch_path(spark, "warehouse"), download_epc=True, epc_from_date=(1993, 3),
        extra_la_rows=[{"ladcd": "A99", "ladnm": "Extra", "cauthcd": "C3", "cauthnm": "EUROPE"}],
        today=date(1998, 1, 15), multi_line=False,
    ).raise_if_failed()


def _clean(spark, sf_dir, name: str) -> DataFrame:
    return _once("run", spark, sf_dir, _full_run).tables[name]


_CODES = "(SELECT 'A' || cast(n_nationkey AS string) FROM {nation} WHERE n_regionkey = 3)"
_IN_PERIOD = f"""LOCAL_AUTHORITY IN {_CODES}
    AND LODGEMENT_DATE >= date '1993-03-01' AND LODGEMENT_DATE < date '1998-01-01'"""


@check("full_run_lookup", """
SELECT CASE n_regionkey WHEN 3 THEN 'A' ELSE 'B' END || cast(n_nationkey AS string) AS ladcd, n_name AS ladnm,
    'C' || cast(n_regionkey AS string) AS cauthcd, CASE n_regionkey WHEN 3 THEN 'EUROPE' ELSE 'OTHER' END AS cauthnm
FROM {nation} UNION ALL SELECT 'A99', 'Extra', 'C3', 'EUROPE'
""")
def full_run_lookup(spark, sf_dir):
    """The authority lookup of a full run."""
    return _clean(spark, sf_dir, "ca_la_lookup")


@check("full_run_centroids", """
SELECT DISTINCT 'L' || cast(c_custkey AS string) AS lsoa21cd, c_acctbal AS x, cast(c_nationkey AS double) AS y,
    c_acctbal AS geom_x, cast(c_nationkey AS double) AS geom_y FROM {customer}
""")
def full_run_centroids(spark, sf_dir):
    """The centroids of a full run, with their points."""
    return _clean(spark, sf_dir, "lsoa_2021_pwc").select(
        "lsoa21cd", "x", "y", F.col("geom.x").alias("geom_x"), F.col("geom.y").alias("geom_y")
    )


@check("full_run_emissions", f"""
SELECT DISTINCT * FROM ({inputs.SUBSECTORS}) WHERE local_authority_code IN {_CODES}
""")
def full_run_emissions(spark, sf_dir):
    """Every column of the emissions of a full run."""
    return _clean(spark, sf_dir, "ghg_emissions")


@check("full_run_traffic", f"""
SELECT cast(o_custkey AS int) AS dft_la_id, 'A' || cast(o_custkey % 25 AS string) AS ladcd, cast(year(o_orderdate) AS int) AS year
FROM {{orders}} WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM {{orders}})
    AND 'A' || cast(o_custkey % 25 AS string) IN {_CODES}
""")
def full_run_traffic(spark, sf_dir):
    """The traffic authorities of a full run."""
    return _clean(spark, sf_dir, "dft_la_lookup")


@check("full_run_deprivation", """
SELECT 'L' || cast(c_custkey * 2 AS string) AS lsoa21_code, c_acctbal FROM {customer}
WHERE c_custkey * 2 IN (SELECT c_custkey FROM {customer})
""")
def full_run_deprivation(spark, sf_dir):
    """The deprivation index of a full run."""
    return _clean(spark, sf_dir, "imd_2025")


@check("full_run_domestic", f"""
SELECT LMK_KEY, CURRENT_ENERGY_RATING, INSPECTION_DATE, TOTAL_FLOOR_AREA, LODGEMENT_DATE, LODGEMENT_DATETIME, LOCAL_AUTHORITY, ADDRESS1
FROM (SELECT *, row_number() OVER (PARTITION BY LMK_KEY ORDER BY CURRENT_ENERGY_RATING IS NULL,
    LODGEMENT_DATE DESC, LODGEMENT_DATETIME DESC) AS nth FROM ({_DOMESTIC}) WHERE {_IN_PERIOD})
WHERE nth = 1 AND CURRENT_ENERGY_RATING IS NOT NULL
""", doubles=["TOTAL_FLOOR_AREA"], texts=["INSPECTION_DATE", "LODGEMENT_DATE", "LODGEMENT_DATETIME"])
def full_run_domestic(spark, sf_dir):
    """The domestic certificates of a full run; its other columns have no values."""
    return _clean(spark, sf_dir, "epc_domestic").select(
        "LMK_KEY", "CURRENT_ENERGY_RATING", "INSPECTION_DATE", "TOTAL_FLOOR_AREA", "LODGEMENT_DATE",
        "LODGEMENT_DATETIME", "LOCAL_AUTHORITY", "ADDRESS1",
    )


@check("full_run_non_domestic", f"""
SELECT LMK_KEY, ASSET_RATING, BUILDING_LEVEL, LODGEMENT_DATE, LODGEMENT_DATETIME, LOCAL_AUTHORITY, ADDRESS1
FROM (SELECT *, row_number() OVER (PARTITION BY LMK_KEY ORDER BY LODGEMENT_DATETIME DESC) AS nth
    FROM ({_NON_DOMESTIC}) WHERE {_IN_PERIOD}) WHERE nth = 1
""", texts=["LODGEMENT_DATE", "LODGEMENT_DATETIME"])
def full_run_non_domestic(spark, sf_dir):
    """The non-domestic certificates of a full run; its other columns have no values."""
    return _clean(spark, sf_dir, "epc_nondomestic").select(
        "LMK_KEY", "ASSET_RATING", "BUILDING_LEVEL", "LODGEMENT_DATE", "LODGEMENT_DATETIME", "LOCAL_AUTHORITY", "ADDRESS1"
    )


def _full_build(spark, sf_dir) -> BuildReport:
    tables = {
        "epc_domestic": inputs.DOMESTIC, "epc_nondom": inputs.NON_DOMESTIC, "postcodes": inputs.POSTCODES,
        "tenure": inputs.TENURE, "imd_lsoa": inputs.DEPRIVATION, "ca_la": inputs.LOOKUP,
        "emissions": inputs.EMISSIONS, "ghg_emissions": inputs.SUBSECTORS,
    }
    built = build_tables(
        spark, {name: derive(spark, sf_dir, sql) for name, sql in tables.items()},
        scratch_path(spark, "warehouse"), Region("EUROPE"),
    )
    built.views.raise_if_failed()
    return built


# Each view of the build beside the SQL of the same view over the same tables.
_VIEW_CHECKS = {
    "simple_geog_lookup_vw": ("region_geography", "V26, V1"),
    "ca_la_ghg_emissions_sub_sector_ods_vw": ("subsector_emissions", "V26, V2"),
    "ca_emissions_evidence_long_tbl": ("emissions_long", "V26, V9"),
    "epc_domestic_vw": ("domestic_enriched", "V26, V3"),
    "epc_domestic_lep_vw": ("domestic_in_region", "V26, V4"),
    "epc_domestic_ods_vw": ("publication_view", "V26, V5"),
    "epc_non_domestic_vw": ("non_domestic_in_region", "V26, V6"),
    "epc_non_domestic_ods_vw": ("non_domestic_publication", "V26, V7"),
}


def _view(spark, sf_dir, view: str, same_as: str) -> DataFrame:
    built = _once("build", spark, sf_dir, _full_build).views.views[view]
    return built.withColumns({c: F.col(c).cast(kind) for c, kind in CASTS[same_as].items()})


for _name, (_same_as, _ids) in _VIEW_CHECKS.items():
    _query = partial(_view, view=_name, same_as=_same_as)
    _query.__doc__ = f"{_ids}: every column of {_name} over tables that a full build wrote."
    check(f"built_{_same_as}", ORACLES[_same_as])(_query)
