"""Domain-shaped inputs derived from the test tables.

Each text is a SELECT both engines run unchanged, so a query and its SQL twin start from
the same rows.  The awkward cases of the domain are in them: NULL and repeated keys, ties,
postcodes without a match, all spellings of age bands and tenure.
"""

AGE_BAND = """CASE o_orderkey % 9
    WHEN 0 THEN 'England and Wales: ' || cast(1900 + o_orderkey % 90 AS string) || '-'
        || cast(1907 + o_orderkey % 93 AS string)
    WHEN 1 THEN cast(1900 + o_orderkey % 90 AS string) || ' - 1999'
    WHEN 2 THEN 'England and Wales: before ' || cast(1890 + o_orderkey % 20 AS string)
    WHEN 3 THEN 'England and Wales: ' || cast(2007 + o_orderkey % 6 AS string) || ' onwards'
    WHEN 4 THEN cast(1850 + o_orderkey % 160 AS string)
    WHEN 5 THEN 'NO DATA!'
    WHEN 6 THEN ''
    WHEN 7 THEN '1930-1949'
    ELSE NULL END"""

TENURE_TEXT = """CASE o_orderkey % 8
    WHEN 0 THEN 'owner-occupied'
    WHEN 1 THEN 'Owner-occupied'
    WHEN 2 THEN 'Rented (social)'
    WHEN 3 THEN 'rental (social)'
    WHEN 4 THEN 'rental (private)'
    WHEN 5 THEN 'Rented (private)'
    WHEN 6 THEN 'Owner-Occupied'
    ELSE NULL END"""

MONTH_START = "make_date(year(o_orderdate), month(o_orderdate), 1)"

DOMESTIC = f"""SELECT
    'K' || cast(o_orderkey AS string) AS LMK_KEY,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'U' || cast(o_custkey AS string) END AS UPRN,
    'P' || cast(o_custkey AS string) AS POSTCODE,
    'A' || cast((o_custkey + o_orderkey % 2) % 25 AS string) AS LOCAL_AUTHORITY,
    'Authority ' || cast((o_custkey + o_orderkey % 2) % 25 AS string) AS LOCAL_AUTHORITY_LABEL,
    o_orderpriority AS PROPERTY_TYPE,
    o_orderstatus AS TRANSACTION_TYPE,
    {TENURE_TEXT} AS TENURE,
    {AGE_BAND} AS CONSTRUCTION_AGE_BAND,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE {MONTH_START} END AS LODGEMENT_DATETIME,
    cast(o_orderdate AS date) AS LODGEMENT_DATE,
    'Walls ' || o_orderpriority AS WALLS_DESCRIPTION,
    'Roof ' || o_orderpriority AS ROOF_DESCRIPTION,
    CASE o_orderstatus WHEN 'F' THEN 'Good' ELSE 'Poor' END AS WALLS_ENERGY_EFF,
    CASE o_orderstatus WHEN 'O' THEN 'Good' ELSE 'Average' END AS ROOF_ENERGY_EFF,
    'Boiler ' || cast(o_orderkey % 13 AS string) AS MAINHEAT_DESCRIPTION,
    CASE o_orderkey % 3 WHEN 0 THEN 'Good' ELSE 'Poor' END AS MAINHEAT_ENERGY_EFF,
    CASE o_orderkey % 4 WHEN 0 THEN 'mains gas' ELSE 'electricity' END AS MAIN_FUEL,
    CASE o_orderkey % 5 WHEN 0 THEN 'Y' ELSE 'N' END AS SOLAR_WATER_HEATING_FLAG,
    substr('ABCDEFG', cast(1 + o_orderkey % 7 AS int), 1) AS CURRENT_ENERGY_RATING,
    substr('ABCDEFG', cast(1 + o_orderkey % 5 AS int), 1) AS POTENTIAL_ENERGY_RATING,
    cast(o_totalprice AS decimal(10,2)) AS CO2_EMISSIONS_CURRENT,
    cast(cast(o_orderkey % 1000 AS decimal(10,2)) AS decimal(10,2)) AS CO2_EMISSIONS_POTENTIAL,
    cast(cast(o_orderkey % 77 AS decimal(10,2)) AS decimal(10,2)) AS CO2_EMISS_CURR_PER_FLOOR_AREA,
    cast(o_orderkey % 9 AS double) AS NUMBER_HABITABLE_ROOMS,
    cast(o_orderkey % 8 AS double) AS NUMBER_HEATED_ROOMS,
    cast(o_orderkey % 60 AS double) AS PHOTO_SUPPLY,
    cast(cast(20 + o_orderkey % 300 AS decimal(10,2)) AS decimal(10,2)) AS TOTAL_FLOOR_AREA,
    'B' || cast(o_orderkey % 5000 AS string) AS BUILDING_REFERENCE_NUMBER,
    CASE o_orderkey % 3 WHEN 0 THEN 'Detached' WHEN 1 THEN 'Mid-Terrace' ELSE NULL END AS BUILT_FORM
FROM {{orders}}"""

NON_DOMESTIC = f"""SELECT
    'N' || cast(o_orderkey AS string) AS LMK_KEY,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END AS UPRN,
    'P' || cast(o_custkey AS string) AS POSTCODE,
    'A' || cast((o_custkey + o_orderkey % 2) % 25 AS string) AS LOCAL_AUTHORITY,
    'B' || cast(o_orderkey % 5000 AS string) AS BUILDING_REFERENCE_NUMBER,
    cast(o_orderkey % 150 AS int) AS ASSET_RATING,
    substr('ABCDEFG', cast(1 + o_orderkey % 7 AS int), 1) AS ASSET_RATING_BAND,
    o_orderpriority AS PROPERTY_TYPE,
    'Constituency ' || cast(o_custkey % 60 AS string) AS CONSTITUENCY,
    o_orderstatus AS TRANSACTION_TYPE,
    cast(o_totalprice AS decimal(10,2)) AS STANDARD_EMISSIONS,
    cast(cast(o_orderkey % 50 AS decimal(10,2)) AS decimal(10,2)) AS TYPICAL_EMISSIONS,
    cast(cast(o_orderkey % 40 AS decimal(10,2)) AS decimal(10,2)) AS TARGET_EMISSIONS,
    cast(cast(o_orderkey % 30 AS decimal(10,2)) AS decimal(10,2)) AS BUILDING_EMISSIONS,
    cast(1 + o_orderkey % 5 AS string) AS BUILDING_LEVEL,
    CASE o_orderkey % 6 WHEN 0 THEN 'solar' ELSE NULL END AS RENEWABLE_SOURCES,
    {MONTH_START} AS LODGEMENT_DATETIME,
    cast(o_orderdate AS date) AS LODGEMENT_DATE
FROM {{orders}}"""

POSTCODES = """SELECT
    'P' || cast(c_custkey AS string) AS pcds,
    'A' || cast(c_nationkey AS string) AS lad25cd,
    'W' || cast(c_custkey % 300 AS string) AS wd25cd,
    'L' || cast(c_custkey % 400 AS string) AS lsoa21cd,
    'M' || cast(c_custkey % 80 AS string) AS msoa21cd,
    'O' || cast(c_custkey % 380 AS string) AS lsoa11cd,
    'Q' || cast(c_custkey % 70 AS string) AS msoa11cd,
    CASE WHEN c_custkey % 11 = 0 THEN NULL
        ELSE cast(51.25 AS double) + cast(c_custkey % 450 AS double) / cast(1000 AS double) END AS lat,
    CASE WHEN c_custkey % 11 = 0 THEN NULL
        ELSE cast(c_custkey * 7 % 1100 AS double) / cast(1000 AS double) - cast(3.2 AS double) END AS long,
    c_custkey % 7000 AS north1m,
    c_custkey % 6000 AS east1m,
    cast(1 + c_custkey % 32844 AS int) AS imd20ind,
    c_mktsegment AS oac11
FROM {customer} WHERE c_custkey % 10 <> 3"""

TENURE = """SELECT
    'Area ' || cast(c_custkey % 400 AS string) AS lsoa_name,
    'L' || cast(c_custkey % 400 AS string) AS lsoa21cd,
    count(*) AS total_all_households,
    cast(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS bigint) AS owned,
    cast(sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END) AS bigint) AS social_rented,
    cast(sum(CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END) AS bigint) AS private_rented
FROM {customer} WHERE c_custkey % 400 <> 17 GROUP BY c_custkey % 400"""

DEPRIVATION = """SELECT
    'O' || cast(c_custkey % 380 AS string) AS lsoa11cd,
    max(c_custkey) AS index_of_multiple_deprivation_imd_rank,
    cast(1 + min(c_custkey) % 10 AS int) AS index_of_multiple_deprivation_imd_decile
FROM {customer} WHERE c_custkey % 380 <> 19 GROUP BY c_custkey % 380"""

LOOKUP = """SELECT
    'A' || cast(n_nationkey AS string) AS ladcd, n_name AS ladnm,
    'C' || cast(n_regionkey AS string) AS cauthcd, r_name AS cauthnm
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey <> 24"""

EMISSIONS = """SELECT
    'England' AS region_country,
    'Tier ' || cast(o_custkey % 5 AS string) AS second_tier_authority,
    'Authority ' || cast(o_custkey % 25 AS string) AS local_authority,
    'A' || cast(o_custkey % 25 AS string) AS local_authority_code,
    cast(year(o_orderdate) AS int) AS calendar_year,
    cast(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN cast(o_totalprice AS decimal(12,2)) END) AS double) AS industry_gas,
    cast(sum(CASE WHEN o_orderpriority = '2-HIGH' AND o_custkey % 25 <> 3 THEN cast(o_totalprice AS decimal(12,2)) END) AS double) AS industry_total,
    cast(sum(CASE WHEN o_orderpriority = '3-MEDIUM' AND o_custkey % 25 <> 4 THEN cast(o_totalprice AS decimal(12,2)) END) AS double) AS total_other,
    cast(sum(CASE WHEN o_orderpriority = '5-LOW' THEN cast(o_totalprice AS decimal(12,2)) END) AS double) AS lulucf_net_emissions,
    cast(sum(cast(o_totalprice AS decimal(12,2))) AS decimal(22,2)) AS grand_total,
    cast(sum(CASE WHEN o_custkey % 25 = 5 THEN 0 ELSE o_custkey % 900 END) AS decimal(22,2)) AS population_000s_mid_year_estimate,
    cast(count(*) AS double) AS per_capita_emissions_t_co2e,
    cast(o_custkey % 25 AS double) AS area_km2,
    cast(max(o_totalprice) AS double) AS emissions_per_km2_kt_co2e
FROM {orders} GROUP BY o_custkey % 25, o_custkey % 5, year(o_orderdate)"""

SUBSECTORS = """SELECT
    'England' AS country, 'E92' AS country_code, 'Region ' || cast(o_custkey % 9 AS string) AS region,
    'Tier ' || cast(o_custkey % 5 AS string) AS second_tier_authority,
    'Authority ' || cast(o_custkey % 25 AS string) AS local_authority,
    'A' || cast(o_custkey % 25 AS string) AS local_authority_code,
    cast(year(o_orderdate) AS int) AS calendar_year,
    o_orderpriority AS la_ghg_sector, o_orderstatus AS la_ghg_sub_sector,
    o_totalprice AS territorial_emissions_kt_co2e
FROM {orders}"""
