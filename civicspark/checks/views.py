"""The named clean-ups and views on domain-shaped inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.checks import inputs
from civicspark.checks.registry import check, derive, table
from civicspark.checks.scalars import _CATEGORY, _EPOCH, _YEAR
from civicspark.functions.names import apply_names, hyphen_lower
from civicspark.operators.sets import table_counts
from civicspark.plans.certificates import (
    DOMESTIC_LAYOUT, NON_DOMESTIC_LAYOUT, domestic_enriched_view, domestic_publication_view,
    domestic_region_view, non_domestic_publication_view, non_domestic_view,
    transform_epc_domestic, transform_epc_nondomestic,
)
from civicspark.plans.emissions import (
    EMISSIONS_KEEP, EMISSIONS_LONG, emissions_long_table, per_capita_emissions_view,
    subsector_emissions_view, transform_dft_lookup, transform_ghg_emissions, transform_imd_2025,
)
from civicspark.plans.geography import (
    add_geometry_column, consolidate_lookups, get_ca_la_codes, region_codes, simple_geography_view,
    small_area_codes, transform_ca_la_lookup, transform_lsoa_pwc,
)
from civicspark.plans.views import VIEWS, Region, create_all_views
from civicspark.schemas import NON_DOMESTIC_CERTIFICATES

REGION = "EUROPE"
_BOX = "long BETWEEN -3.1178 AND -2.25211 AND lat BETWEEN 51.273 AND 51.68239"


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())


_NUMBER = r"regexp_replace(cast({0} AS string), '\.0$', '')"
_LATEST = """SELECT * FROM certificates WHERE UPRN IS NOT NULL AND LODGEMENT_DATETIME IS NOT NULL
    QUALIFY rank() OVER (PARTITION BY UPRN ORDER BY LODGEMENT_DATETIME DESC) = 1"""
_DOMESTIC_VIEW = f"""
SELECT c.*, {_EPOCH.replace('built', 'NOMINAL_CONSTRUCTION_YEAR')} AS CONSTRUCTION_EPOCH,
    {_CATEGORY} AS TENURE_CLEAN,
    cast(date_part('day', c.LODGEMENT_DATETIME) AS int) AS LODGEMENT_DAY,
    cast(date_part('month', c.LODGEMENT_DATETIME) AS int) AS LODGEMENT_MONTH,
    cast(date_part('year', c.LODGEMENT_DATETIME) AS int) AS LODGEMENT_YEAR,
    p.lsoa21cd, p.msoa21cd, p.lsoa11cd, p.msoa11cd, p.lat, p.long, p.north1m, p.east1m,
    CASE WHEN p.long IS NOT NULL AND p.lat IS NOT NULL THEN
        'POINT (' || {_NUMBER.format('p.long')} || ' ' || {_NUMBER.format('p.lat')} || ')' END AS geom_text,
    p.imd20ind, p.pcds, t.* EXCLUDE (lsoa21cd), i.* EXCLUDE (lsoa11cd)
FROM (SELECT *, {_YEAR.replace('band', 'CONSTRUCTION_AGE_BAND')} AS NOMINAL_CONSTRUCTION_YEAR
    FROM ({_LATEST})) c
LEFT JOIN postcodes p ON c.POSTCODE = p.pcds
LEFT JOIN tenure t ON p.lsoa21cd = t.lsoa21cd
LEFT JOIN deprivation i ON p.lsoa11cd = i.lsoa11cd"""
_DOMESTIC_CTES = dict(
    certificates=inputs.DOMESTIC, postcodes=inputs.POSTCODES, tenure=inputs.TENURE,
    deprivation=inputs.DEPRIVATION, lookup=inputs.LOOKUP, enriched=_DOMESTIC_VIEW,
)
_IN_REGION = f"""
SELECT * FROM enriched WHERE LOCAL_AUTHORITY IN
    (SELECT ladcd FROM lookup WHERE cauthnm = '{REGION}') AND {_BOX}"""


_DOMESTIC_TYPES = {
    "doubles": (
        "CO2_EMISSIONS_CURRENT", "CO2_EMISSIONS_POTENTIAL", "CO2_EMISS_CURR_PER_FLOOR_AREA",
        "TOTAL_FLOOR_AREA",
    ),
    "texts": ("LODGEMENT_DATETIME", "LODGEMENT_DATE"),
}


def _layout_sql(layout: dict[str, str]) -> str:
    columns = ", ".join(
        f'{source} AS "{name}"' for name, source in layout.items() if name != "geo_point_2d"
    )
    return f"{columns}, concat('{{', lat, ', ', long, '}}') AS geo_point_2d"


def _domestic(spark, sf_dir):
    return domestic_enriched_view(
        derive(spark, sf_dir, inputs.DOMESTIC), derive(spark, sf_dir, inputs.POSTCODES),
        derive(spark, sf_dir, inputs.TENURE), derive(spark, sf_dir, inputs.DEPRIVATION),
    )


@check("domestic_enriched", f"{_with(**_DOMESTIC_CTES)} SELECT * FROM enriched", **_DOMESTIC_TYPES)
def domestic_enriched(spark, sf_dir):
    """V3: J3, J2, C1-C7, C11, P6."""
    return _domestic(spark, sf_dir)


@check("domestic_in_region", f"{_with(**_DOMESTIC_CTES)} {_IN_REGION}", **_DOMESTIC_TYPES)
def domestic_in_region(spark, sf_dir):
    """V4: J5, F3; the latest certificate is chosen before the filters."""
    return domestic_region_view(
        _domestic(spark, sf_dir), derive(spark, sf_dir, inputs.LOOKUP), REGION
    )


@check(
    "publication_view",
    f"{_with(**_DOMESTIC_CTES, regional=_IN_REGION)} "
    f"SELECT {_layout_sql(DOMESTIC_LAYOUT)} FROM regional",
    doubles=[
        "co2_emissions_current", "co2_emissions_potential", "co2_emiss_curr_per_floor_area",
        "total_floor_area",
    ],
    texts=["date"],
)
def publication_view(spark, sf_dir):
    """The flagship."""
    regional = domestic_region_view(
        _domestic(spark, sf_dir), derive(spark, sf_dir, inputs.LOOKUP), REGION
    )
    return domestic_publication_view(regional)


_NON_DOMESTIC_VIEW = f"""
SELECT c.*, l.*, p.lsoa21cd, p.lat, p.long,
    cast(date_part('day', c.LODGEMENT_DATETIME) AS int) AS LODGEMENT_DAY,
    cast(date_part('month', c.LODGEMENT_DATETIME) AS int) AS LODGEMENT_MONTH,
    cast(date_part('year', c.LODGEMENT_DATETIME) AS int) AS LODGEMENT_YEAR
FROM ({_LATEST}) c
JOIN lookup l ON c.LOCAL_AUTHORITY = l.ladcd
JOIN (SELECT pcds, lsoa21cd, lat, long FROM postcodes) p ON c.POSTCODE = p.pcds
WHERE c.LOCAL_AUTHORITY IN (SELECT ladcd FROM lookup WHERE cauthnm = '{REGION}')"""
_NON_DOMESTIC_CTES = dict(
    certificates=inputs.NON_DOMESTIC, postcodes=inputs.POSTCODES, lookup=inputs.LOOKUP,
    placed=_NON_DOMESTIC_VIEW,
)


def _non_domestic(spark, sf_dir):
    return non_domestic_view(
        derive(spark, sf_dir, inputs.NON_DOMESTIC), derive(spark, sf_dir, inputs.LOOKUP),
        derive(spark, sf_dir, inputs.POSTCODES), REGION,
    )


@check(
    "non_domestic_in_region",
    f"{_with(**_NON_DOMESTIC_CTES)} SELECT * FROM placed",
    doubles=["STANDARD_EMISSIONS", "TYPICAL_EMISSIONS", "TARGET_EMISSIONS", "BUILDING_EMISSIONS"],
    texts=["LODGEMENT_DATETIME", "LODGEMENT_DATE"],
)
def non_domestic_in_region(spark, sf_dir):
    """V6: J3, J1, J4, J5, C7."""
    return _non_domestic(spark, sf_dir)


@check(
    "non_domestic_publication",
    f"{_with(**_NON_DOMESTIC_CTES)} SELECT {_layout_sql(NON_DOMESTIC_LAYOUT)} "
    f"FROM placed WHERE {_BOX}",
    doubles=["standard_emissions", "typical_emissions", "target_emissions", "building_emissions"],
    texts=["date"],
)
def non_domestic_publication(spark, sf_dir):
    """V7: F3, P2, C8."""
    return non_domestic_publication_view(_non_domestic(spark, sf_dir))


@check("region_geography", f"""
{_with(postcodes=inputs.POSTCODES, lookup=inputs.LOOKUP)}, members AS
    (SELECT ladcd, ladnm FROM lookup WHERE cauthnm = '{REGION}')
SELECT COLUMNS('^ls|^ms|^lad|^pcd|^wd|^lad|^imd|lat|long')
FROM postcodes JOIN members ON lad25cd = ladcd
""")
def region_geography(spark, sf_dir):
    """V1: F1, J7, P5."""
    return simple_geography_view(
        derive(spark, sf_dir, inputs.POSTCODES), derive(spark, sf_dir, inputs.LOOKUP), REGION
    )


@check("subsector_emissions", f"""
{_with(emissions=inputs.SUBSECTORS, lookup=inputs.LOOKUP)}
SELECT * EXCLUDE (country, country_code, region, ladcd, ladnm, second_tier_authority)
FROM emissions JOIN lookup ON local_authority_code = ladcd
""")
def subsector_emissions(spark, sf_dir):
    """V2: J1, P3."""
    return subsector_emissions_view(
        derive(spark, sf_dir, inputs.SUBSECTORS), derive(spark, sf_dir, inputs.LOOKUP)
    )


@check("per_capita_emissions", f"""
{_with(emissions=inputs.EMISSIONS, lookup=inputs.LOOKUP)}
SELECT calendar_year, cauthnm AS area, cast(sum(grand_total) AS double)
    / nullif(cast(sum(population_000s_mid_year_estimate) AS double), 0) AS per_cap
FROM emissions JOIN (SELECT * FROM lookup WHERE ladnm <> 'NATION_8') ON local_authority_code = ladcd
GROUP BY 1, 2
""")
def per_capita_emissions(spark, sf_dir):
    """V8: F2, J1, A2, A3."""
    return per_capita_emissions_view(
        derive(spark, sf_dir, inputs.EMISSIONS), derive(spark, sf_dir, inputs.LOOKUP), "NATION_8"
    )


@check("emissions_long", f"""
{_with(emissions=inputs.EMISSIONS, lookup=inputs.LOOKUP)},
long AS (UNPIVOT emissions ON COLUMNS(* EXCLUDE ({', '.join(EMISSIONS_KEEP)}))
    INTO NAME sector VALUE emissions_kt_co2e)
SELECT {', '.join(EMISSIONS_LONG).replace(
    'total_bool', "regexp_matches(sector, '_total$|lulucf_net_emissions') AS total_bool"
)} FROM long JOIN lookup ON local_authority_code = ladcd
""", doubles=["population_000s_mid_year_estimate", "grand_total"])
def emissions_long(spark, sf_dir):
    """V9: R3, F8, J1."""
    return emissions_long_table(
        derive(spark, sf_dir, inputs.EMISSIONS), derive(spark, sf_dir, inputs.LOOKUP)
    )


@check("registry_view", f"""
{_with(emissions=inputs.SUBSECTORS, lookup=inputs.LOOKUP)}
SELECT la_ghg_sector, cauthnm, count(*) AS n_rows
FROM emissions JOIN lookup ON local_authority_code = ladcd GROUP BY 1, 2
""")
def registry_view(spark, sf_dir):
    """The registry builds what its tables allow; SQL then reads a registered view."""
    tables = {
        "ghg_emissions": derive(spark, sf_dir, inputs.SUBSECTORS),
        "ca_la": derive(spark, sf_dir, inputs.LOOKUP),
    }
    create_all_views(spark, tables, Region(REGION))
    return spark.sql(
        "SELECT la_ghg_sector, cauthnm, count(*) AS n_rows "
        "FROM ca_la_ghg_emissions_sub_sector_ods_vw GROUP BY la_ghg_sector, cauthnm"
    )


@check("registry_report", f"""
{_with(emissions=inputs.SUBSECTORS, lookup=inputs.LOOKUP)}
SELECT name, name = 'ca_la_ghg_emissions_sub_sector_ods_vw' AS created,
    CASE WHEN name = 'ca_la_ghg_emissions_sub_sector_ods_vw' THEN (SELECT count(*)
        FROM emissions JOIN lookup ON local_authority_code = ladcd) ELSE 0 END AS n_rows
FROM (VALUES {', '.join(f"('{name}')" for name in VIEWS)}) AS v(name)
""")
def registry_report(spark, sf_dir):
    """Which views the given tables allow, which not, and the rows of those created."""
    tables = {
        "ghg_emissions": derive(spark, sf_dir, inputs.SUBSECTORS),
        "ca_la": derive(spark, sf_dir, inputs.LOOKUP),
    }
    report = create_all_views(spark, tables, Region(REGION))
    counts = table_counts(report.views).select(
        F.col("table_name").alias("name"), F.lit(True).alias("created"), "n_rows"
    )
    failed = [(name, False, 0) for name, _ in report.failed]
    return counts.unionByName(
        spark.createDataFrame(failed, "name string, created boolean, n_rows bigint")
    )


_AUTHORITIES = """SELECT 'A' || cast(s_suppkey AS string) AS ladcd, s_name AS ladnm,
    'C' || cast(s_nationkey AS string) AS cauthcd, 'Area ' || cast(s_nationkey AS string) AS cauthnm
FROM {supplier}"""
_EXTRA = {"ladcd": "A1", "ladnm": "Extra", "cauthcd": "C9", "cauthnm": "Area 9"}


@check("authority_lookup", f"""
{_AUTHORITIES} UNION ALL SELECT 'A1', 'Extra', 'C9', 'Area 9'
""")
def authority_lookup(spark, sf_dir):
    """P4, P8, U3."""
    raw = derive(spark, sf_dir, _AUTHORITIES).toDF("LAD24CD", "LAD24NM", "CAUTH24CD", "CAUTH24NM")
    return transform_ca_la_lookup(raw.withColumn("ObjectId", F.lit(1)), [_EXTRA])


_CENTROIDS = """SELECT 'L' || cast(c_custkey AS string) AS lsoa21cd, c_acctbal AS x,
    cast(c_nationkey AS double) AS y FROM {customer}"""


@check("centroids", f"SELECT lsoa21cd, x, y, x AS geom_x, y AS geom_y FROM ({_CENTROIDS})")
def centroids(spark, sf_dir):
    """D1, P7, P17, D4, C9; every centroid comes in twice."""
    once = derive(spark, sf_dir, _CENTROIDS).toDF("LSOA21CD", "X", "Y")
    placed = add_geometry_column(transform_lsoa_pwc(once.unionByName(once)))
    return placed.select("lsoa21cd", "x", "y", F.col("geom.x").alias("geom_x"), F.col("geom.y").alias("geom_y"))


@check("emissions_cleanup", f"""
{_with(emissions=inputs.SUBSECTORS, lookup=inputs.LOOKUP)}
SELECT DISTINCT local_authority_code, calendar_year, la_ghg_sector, la_ghg_sub_sector
FROM emissions WHERE local_authority_code IN (SELECT ladcd FROM lookup WHERE cauthnm = '{REGION}')
""")
def emissions_cleanup(spark, sf_dir):
    """D1, F7."""
    raw = derive(spark, sf_dir, inputs.SUBSECTORS).select(
        "local_authority_code", "calendar_year", "la_ghg_sector", "la_ghg_sub_sector"
    )
    codes = get_ca_la_codes(region_codes(derive(spark, sf_dir, inputs.LOOKUP), REGION))
    return transform_ghg_emissions(raw, codes)


_TRAFFIC = """SELECT o_custkey AS local_authority_id,
    'A' || cast(o_custkey % 25 AS string) AS local_authority_code,
    cast(year(o_orderdate) AS int) AS year, o_totalprice AS all_motor_vehicles FROM {orders}"""


@check("traffic_lookup", f"""
{_with(traffic=_TRAFFIC, lookup=inputs.LOOKUP)}
SELECT local_authority_id AS dft_la_id, local_authority_code AS ladcd, year FROM traffic
WHERE year = (SELECT max(year) FROM traffic) AND local_authority_code IN (SELECT ladcd FROM lookup)
""")
def traffic_lookup(spark, sf_dir):
    """D4, F5, P14, F4."""
    codes = get_ca_la_codes(derive(spark, sf_dir, inputs.LOOKUP))
    return transform_dft_lookup(derive(spark, sf_dir, _TRAFFIC), codes)


_INDEX = """SELECT 'L' || cast(c_custkey % 700 AS string) AS lsoa21_code, c_acctbal AS imd_score
FROM {customer}"""


@check("deprivation_cleanup", f"""
SELECT lsoa21_code, min(imd_score) AS imd_score FROM ({_INDEX})
WHERE lsoa21_code IN (SELECT lsoa21cd FROM ({inputs.POSTCODES})) GROUP BY lsoa21_code
""")
def deprivation_cleanup(spark, sf_dir):
    """D4, D2, J6."""
    codes = derive(spark, sf_dir, inputs.POSTCODES).select("lsoa21cd").distinct()
    return transform_imd_2025(derive(spark, sf_dir, _INDEX), codes)


_PAGES = """SELECT 'K' || cast(o_custkey AS string) AS LMK_KEY, o_orderkey AS REPORT_TYPE,
    CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE substr('ABCDEFG', cast(1 + o_orderkey % 7 AS int), 1) END AS CURRENT_ENERGY_RATING,
    CASE o_orderkey % 5 WHEN 0 THEN 'unknown' ELSE cast(cast(o_orderdate AS date) AS string) END AS INSPECTION_DATE,
    cast(cast(o_orderdate AS date) AS string) AS LODGEMENT_DATE
FROM {orders}"""


@check("domestic_cleanup", f"""
WITH dated AS (SELECT LMK_KEY, REPORT_TYPE, CURRENT_ENERGY_RATING,
    try_cast(INSPECTION_DATE AS date) AS INSPECTION_DATE,
    try_cast(LODGEMENT_DATE AS date) AS LODGEMENT_DATE FROM ({_PAGES})),
numbered AS (SELECT *, row_number() OVER (PARTITION BY LMK_KEY
    ORDER BY CURRENT_ENERGY_RATING IS NULL, LODGEMENT_DATE DESC, REPORT_TYPE) AS nth FROM dated)
SELECT * EXCLUDE (nth) FROM numbered WHERE nth = 1 AND CURRENT_ENERGY_RATING IS NOT NULL
""", texts=["INSPECTION_DATE", "LODGEMENT_DATE"])
def domestic_cleanup(spark, sf_dir):
    """P10, D2, D7, F6 (T18: a rated copy is preferred)."""
    return transform_epc_domestic(apply_names(derive(spark, sf_dir, _PAGES), hyphen_lower))


@check("non_domestic_cleanup", """
SELECT 'N' || cast(o_orderkey AS string) AS lmk_key, o_custkey AS uprn,
    try_cast(CASE o_orderkey % 4 WHEN 0 THEN 'n/a' ELSE cast(o_orderkey % 150 AS string) END AS integer) AS asset_rating,
    try_cast(cast(o_totalprice AS decimal(12,2)) AS decimal(10,2)) AS standard_emissions,
    cast(o_orderdate AS date) AS lodgement_date
FROM {orders}
""", doubles=["standard_emissions"], texts=["lodgement_date"])
def non_domestic_cleanup(spark, sf_dir):
    """P10, D6, D2; all 41 columns are typed, five of them are compared."""
    orders = table(spark, sf_dir, "orders")
    text = {
        "lmk-key": F.concat(F.lit("N"), F.col("o_orderkey").cast("string")),
        "uprn": F.col("o_custkey").cast("string"),
        "asset-rating": F.when(F.col("o_orderkey") % 4 == 0, "n/a").otherwise(
            (F.col("o_orderkey") % 150).cast("string")
        ),
        "standard-emissions": F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
        "lodgement-date": F.col("o_orderdate").cast("date").cast("string"),
    }
    pages = orders.select([
        text.get(hyphen_lower(name), F.lit(None).cast("string")).alias(hyphen_lower(name))
        for name in NON_DOMESTIC_CERTIFICATES.fieldNames()
    ])
    typed = transform_epc_nondomestic(pages.unionByName(pages))
    return apply_names(
        typed.select("LMK_KEY", "UPRN", "ASSET_RATING", "STANDARD_EMISSIONS", "LODGEMENT_DATE"),
        str.lower,
    )


@check("lookup_consolidation", """
SELECT DISTINCT o_custkey AS lsoa21cd, cast(o_orderkey % 40 AS double) AS share FROM {orders}
UNION SELECT c_custkey, c_acctbal FROM {customer}
""")
def lookup_consolidation(spark, sf_dir):
    """U2, P7, D1: pages whose types differ."""
    first = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("LSOA21CD"), (F.col("o_orderkey") % 40).alias("SHARE")
    )
    second = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("LSOA21CD"), F.col("c_acctbal").alias("SHARE")
    )
    return consolidate_lookups([first, second])


@check("small_areas", f"""
{_with(postcodes=inputs.POSTCODES, lookup=inputs.LOOKUP)}
SELECT DISTINCT lsoa21cd FROM postcodes WHERE lad25cd IN
    (SELECT ladcd FROM lookup WHERE cauthnm = '{REGION}')
""")
def small_areas(spark, sf_dir):
    """J6, A6."""
    codes = region_codes(derive(spark, sf_dir, inputs.LOOKUP), REGION)
    return small_area_codes(
        derive(spark, sf_dir, inputs.POSTCODES), codes, "lsoa21cd", "lad25cd"
    )
