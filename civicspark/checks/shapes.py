"""Pivots and unpivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.checks.registry import check, derive, table
from civicspark.operators.filters import flag_matching
from civicspark.operators.reshape import pivot_unique, unpivot_not_null
from civicspark.plans.emissions import deprivation_wide, tenure_wide

_WIDE = """SELECT l_suppkey, l_returnflag,
    cast(sum(CASE WHEN l_linestatus = 'F' THEN cast(l_quantity AS decimal(12,2)) END) AS double) AS f_total,
    cast(sum(CASE WHEN l_linestatus = 'O' THEN cast(l_quantity AS decimal(12,2)) END) AS double) AS open_qty,
    cast(nullif(max(l_linenumber), 7) AS double) AS lulucf_net_emissions
FROM {lineitem} GROUP BY l_suppkey, l_returnflag"""


@check("unpivot_not_null", f"""
SELECT *, regexp_matches(sector, '_total$|lulucf_net_emissions') AS total_bool FROM (
    UNPIVOT ({_WIDE}) ON COLUMNS(* EXCLUDE (l_suppkey, l_returnflag)) INTO NAME sector VALUE amount)
""")
def unpivot_to_long(spark, sf_dir):
    """R3, F8."""
    long = unpivot_not_null(
        derive(spark, sf_dir, _WIDE), ["l_suppkey", "l_returnflag"], "sector", "amount"
    )
    return flag_matching(long, "sector", "_total$|lulucf_net_emissions", "total_bool")


_COUNTS = "SELECT user_id, event_type, count(*) AS n FROM {events} GROUP BY user_id, event_type"
_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@check("pivot_one", f"SELECT user_id, {', '.join(
    f"max(n) FILTER (event_type = '{t}') AS {t}" for t in _EVENT_TYPES
)} FROM ({_COUNTS}) GROUP BY user_id")
def pivot_one(spark, sf_dir):
    """R1 with given labels."""
    return pivot_unique(
        derive(spark, sf_dir, _COUNTS), ["user_id"], "event_type", "n", _EVENT_TYPES
    )


_TENURE_LONG = """SELECT 'Area ' || cast(c_custkey AS string) AS GEOGRAPHY_NAME,
    'L' || cast(c_custkey AS string) AS GEOGRAPHY_CODE,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Owned' WHEN '2-HIGH' THEN 'Social rented'
        WHEN '3-MEDIUM' THEN 'Private rented' ELSE 'Total: All households' END AS C2021_TENURE_9_NAME,
    1 AS C2021_TENURE_9_SORTORDER, count(*) AS OBS_VALUE
FROM {customer} JOIN {orders} ON c_custkey = o_custkey GROUP BY 1, 2, 3"""


@check("tenure_wide", f"""
SELECT GEOGRAPHY_NAME AS lsoa_name, GEOGRAPHY_CODE AS lsoa21cd,
    max(OBS_VALUE) FILTER (C2021_TENURE_9_NAME = 'Owned') AS owned,
    max(OBS_VALUE) FILTER (C2021_TENURE_9_NAME = 'Social rented') AS social_rented,
    max(OBS_VALUE) FILTER (C2021_TENURE_9_NAME = 'Private rented') AS private_rented,
    max(OBS_VALUE) FILTER (C2021_TENURE_9_NAME = 'Total: All households') AS total_all_households
FROM ({_TENURE_LONG}) GROUP BY 1, 2
""")
def tenure_to_wide(spark, sf_dir):
    """R1, P12, P14; the labels are looked up."""
    return tenure_wide(derive(spark, sf_dir, _TENURE_LONG))


_INDICES_LONG = """SELECT 'O' || cast(l_suppkey AS string) AS FeatureCode, 2019 AS DateCode,
    CASE l_linestatus WHEN 'F' THEN 'Rank' ELSE 'Decile ' END AS Measurement, 'u' AS Units,
    cast(max(l_orderkey) AS double) AS Value,
    CASE l_returnflag WHEN 'A' THEN 'a. Index of Multiple Deprivation (IMD)'
        WHEN 'N' THEN 'b. Income Deprivation Domain'
        ELSE 'j. Income Deprivation Affecting Older People Index (IDAOPI)' END AS domain
FROM {lineitem} GROUP BY l_suppkey, l_linestatus, l_returnflag"""


@check("deprivation_wide", f"SELECT FeatureCode AS lsoa11cd, {', '.join(
    f"max(Value) FILTER (domain LIKE '{letter}.%' AND trim(Measurement) = '{measure}') AS {name}_{measure.lower()}"
    for letter, name in (
        ('a', 'index_of_multiple_deprivation_imd'), ('b', 'income_deprivation_domain'),
        ('j', 'income_deprivation_affecting_older_people_index_idaopi'),
    )
    for measure in ('Rank', 'Decile')
)} FROM ({_INDICES_LONG}) GROUP BY 1")
def deprivation_to_wide(spark, sf_dir):
    """R2, P11-P15; published names come out of the joint labels."""
    return deprivation_wide(
        derive(spark, sf_dir, _INDICES_LONG).withColumnRenamed("domain", "Indices of Deprivation")
    )
