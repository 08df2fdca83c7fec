"""Scalar expressions, geometry text, names and layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.checks.inputs import AGE_BAND, TENURE_TEXT
from civicspark.checks.registry import check, derive, table
from civicspark.functions.geometry import first_point, make_point, point_text
from civicspark.functions.names import (
    apply_names, clean_names, get_rename_dict, remove_numbers, upper_underscore,
)
from civicspark.functions.scalars import (
    clean_tenure, construction_epoch, date_parts, nominal_construction_year, point_label,
)
from civicspark.operators.chunks import chunk_codes, chunk_filters
from civicspark.operators.columns import (
    add_chained, drop_if_present, join_side_by_side, rename_strict, select_by_regex,
    select_layout, unnest,
)
from civicspark.plans.certificates import make_zipfile_list
from civicspark.plans.geography import add_geometry_column_from_wkt, small_area_chunks
from civicspark.streaming.periods import next_period

_BANDS = f"SELECT o_orderkey, {AGE_BAND} AS band FROM {{orders}}"
# No match gives empty text, which casts to NULL, so the first rule that applies wins.
_YEAR = r"""coalesce(
    cast(round((try_cast(regexp_extract(band, '(\d{4})-(\d{4})', 1) AS integer)
        + try_cast(regexp_extract(band, '(\d{4})-(\d{4})', 2) AS integer)) / 2.0) AS integer),
    try_cast(regexp_extract(band, 'before (\d{4})', 1) AS integer),
    try_cast(regexp_extract(band, '(\d{4}) onwards', 1) AS integer),
    try_cast(regexp_extract(band, '(\d{4})', 1) AS integer))"""
# Epochs by their first and last year, and the spellings of each tenure.
_EPOCHS = (("Before 1900", None, 1899), ("1900 - 1930", 1900, 1930), ("1930 to present", 1931, None))
_TENURES_OF = (
    ("owner-occupied", "Owner occupied"), ("Owner-occupied", "Owner occupied"),
    ("Rented (social)", "Social rented"), ("rental (social)", "Social rented"),
    ("rental (private)", "Private rented"), ("Rented (private)", "Private rented"),
)


def _sql_value(value) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_sql_value, row)) + ")" for row in rows)


_EPOCH = f"""coalesce((SELECT name FROM (VALUES {_values(_EPOCHS)}) AS e(name, low, high)
    WHERE built >= coalesce(low, built) AND built <= coalesce(high, built)), 'Unknown')"""
_CATEGORY = f"""(SELECT category FROM (VALUES {_values(_TENURES_OF)}) AS t(spelling, category)
    WHERE spelling = tenure)"""


@check("age_band_year", f"""
WITH b AS ({_BANDS}), y AS (SELECT *, {_YEAR} AS built FROM b)
SELECT *, {_EPOCH} AS epoch FROM y
""")
def age_band_year(spark, sf_dir):
    """C1, C2, C4-C6, C12, P18."""
    return add_chained(
        derive(spark, sf_dir, _BANDS),
        [("built", nominal_construction_year("band")), ("epoch", construction_epoch("built"))],
    )


_TENURES = f"SELECT o_orderkey, {TENURE_TEXT} AS tenure FROM {{orders}}"


@check("synonym_map", f"""
SELECT *, {_CATEGORY} AS category FROM ({_TENURES})
""")
def synonym_map(spark, sf_dir):
    """Exact and case-sensitive."""
    return derive(spark, sf_dir, _TENURES).withColumn("category", clean_tenure("tenure"))


@check("date_parts", """
SELECT event_id, cast(date_part('day', ts) AS int) AS ts_day,
    cast(date_part('month', ts) AS int) AS ts_month, cast(date_part('year', ts) AS int) AS ts_year
FROM {events}
""")
def parts_of_dates(spark, sf_dir):
    """C7."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    parted = events.withColumns(date_parts("ts", "ts_")).drop("ts")
    return apply_names(parted, str.lower)


_PLACES = """SELECT c_custkey,
    CASE WHEN c_custkey % 7 = 0 THEN NULL
        ELSE cast(c_custkey % 90 AS double) + cast(0.25 AS double) END AS lat,
    CASE WHEN c_custkey % 5 = 0 THEN NULL
        WHEN c_custkey % 11 = 0 THEN cast(c_custkey AS double) / cast(10000000 AS double)
        WHEN c_custkey % 13 = 0 THEN cast(0 AS double) - cast(c_custkey AS double) * cast(1234567.75 AS double)
        ELSE cast(c_custkey % 50 AS double) / cast(8 AS double) - cast(3 AS double) END AS long
FROM {customer}"""
# The shortest digits, in plain notation: 6.27e-05 is written out, a final .0 left away.
_NUMBER = r"""CASE WHEN contains(cast({0} AS varchar), 'e-') THEN
    CASE WHEN {0} < 0 THEN '-0.' ELSE '0.' END
    || repeat('0', cast(split_part(cast({0} AS varchar), 'e-', 2) AS int) - 1)
    || regexp_replace(split_part(cast({0} AS varchar), 'e-', 1), '[.-]', '', 'g')
    ELSE regexp_replace(cast({0} AS varchar), '\.0$', '') END"""


@check("geo_point_text", f"""
SELECT c_custkey, concat('{{', lat, ', ', long, '}}') AS label,
    CASE WHEN lat IS NOT NULL AND long IS NOT NULL THEN
        'POINT (' || {_NUMBER.format('long')} || ' ' || {_NUMBER.format('lat')} || ')' END AS point
FROM ({_PLACES})
""")
def geo_point_text(spark, sf_dir):
    """NULL parts are empty in the label but make the point NULL."""
    places = derive(spark, sf_dir, _PLACES)
    return places.select(
        "c_custkey", point_label("lat", "long").alias("label"),
        point_text(make_point("long", "lat")).alias("point"),
    )


_RINGS = """SELECT l_orderkey, l_linenumber, l_quantity AS x, l_tax AS y, CASE l_linenumber % 3
    WHEN 0 THEN 'POINT (' || cast(l_quantity AS string) || ' ' || cast(l_tax AS string) || ')'
    WHEN 1 THEN 'POLYGON ((' || cast(l_quantity AS string) || ' ' || cast(l_tax AS string)
        || ', 9 1, 9 9, 0 0), (1 1, 2 2, 1 2))'
    ELSE 'MULTIPOLYGON (((' || cast(l_quantity AS string) || ' ' || cast(l_tax AS string)
        || ', 9 1, 9 9)), ((1 1, 2 2, 1 2), (3 3, 4 4)))' END AS wkt
FROM {lineitem}"""


@check("wkt_parse", f"""
SELECT l_orderkey, l_linenumber, x, y,
    CASE l_linenumber % 3 WHEN 0 THEN 'POINT' WHEN 1 THEN 'POLYGON' ELSE 'MULTIPOLYGON' END AS kind,
    cast(CASE l_linenumber % 3 WHEN 2 THEN 2 ELSE 1 END AS int) AS polygons,
    cast(CASE l_linenumber % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS int) AS rings,
    cast(CASE l_linenumber % 3 WHEN 0 THEN 1 WHEN 1 THEN 7 ELSE 8 END AS int) AS points
FROM ({_RINGS})
""")
def wkt_parse(spark, sf_dir):
    """Coordinates read back from text, with the nesting they had."""
    parsed = add_geometry_column_from_wkt(derive(spark, sf_dir, _RINGS), "wkt")
    rings = F.flatten("geom.parts")
    return parsed.select(
        "l_orderkey", "l_linenumber", first_point("geom")["x"].alias("x"),
        first_point("geom")["y"].alias("y"), F.col("geom.kind").alias("kind"),
        F.size("geom.parts").alias("polygons"), F.size(rings).alias("rings"),
        F.size(F.flatten(rings)).alias("points"),
    )


_AREAS = """SELECT 'A' || cast(p_partkey AS string) AS ladcd, CASE p_partkey % 4
    WHEN 0 THEN p_name || ', City of' WHEN 1 THEN 'St. ' || p_name
    WHEN 2 THEN p_brand || '  ' || p_type ELSE p_name END AS ladnm FROM {part}"""


@check("slug_url", f"""
SELECT 'https://files.example/' || 'domestic' || '-' || ladcd || '-'
    || regexp_replace(ladnm, ', |\\. | ', '-', 'g') || '.zip' AS url, ladcd FROM ({_AREAS})
""")
def slug_url(spark, sf_dir):
    """C13, C14."""
    return make_zipfile_list(derive(spark, sf_dir, _AREAS), "https://files.example/", "domestic")


@check("next_period", """
SELECT cast(year(d) AS int) AS year, cast(month(d) AS int) AS month
FROM (SELECT max(cast(o_orderdate AS date)) + INTERVAL 1 MONTH AS d FROM {orders})
""")
def next_reporting_period(spark, sf_dir):
    """C15, I1."""
    return next_period(table(spark, sf_dir, "orders"), "o_orderdate")


@check("code_chunks", """
WITH codes AS (SELECT DISTINCT 'L' || cast(o_custkey AS string) AS code FROM {orders}),
numbered AS (SELECT code, (row_number() OVER (ORDER BY code) - 1) // 100 AS chunk FROM codes)
SELECT chunk, count(*) AS n_codes, string_agg(code, ',' ORDER BY code) AS codes
FROM numbered GROUP BY chunk
""")
def code_chunks(spark, sf_dir):
    """All codes in order, a hundred to a chunk."""
    codes = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("L"), F.col("o_custkey").cast("string")).alias("lsoa21cd")
    )
    return small_area_chunks(codes).drop("members")


@check("chunk_clauses", """
WITH codes AS (SELECT DISTINCT 'P' || cast(l_partkey AS string) AS code FROM {lineitem}),
numbered AS (SELECT code, (row_number() OVER (ORDER BY code) - 1) // 250 AS chunk FROM codes)
SELECT chunk, 'partcd IN (' || string_agg('''' || code || '''', ', ' ORDER BY code) || ')' AS clause
FROM numbered GROUP BY chunk
""")
def chunk_clauses(spark, sf_dir):
    """The membership clause of each chunk."""
    codes = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("code")
    )
    return chunk_filters(chunk_codes(codes, "code", 250, separator="|"), "partcd").select("chunk", "clause")


@check("select_by_regex", """
SELECT COLUMNS('^c_n|key|^n_') FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
""")
def columns_by_regex(spark, sf_dir):
    """P5: partial matches over both sides of a join."""
    joined = join_side_by_side(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
        [("c_nationkey", "n_nationkey")],
    )
    return select_by_regex(joined, "^c_n|key|^n_")


@check("rename_layout", """
SELECT l_orderkey AS lmk_key, l_suppkey AS local_authority, l_returnflag AS tenure,
    l_extendedprice AS co2_emissions_current, l_shipdate AS "date" FROM {lineitem}
""")
def rename_layout(spark, sf_dir):
    """P1, P2."""
    return select_layout(table(spark, sf_dir, "lineitem"), {
        "lmk_key": "l_orderkey", "local_authority": "l_suppkey", "tenure": "l_returnflag",
        "co2_emissions_current": "l_extendedprice", "date": "l_shipdate",
    })


@check("clean_column_names", """
SELECT p_partkey AS partcd, p_name AS brand_name, p_brand AS brand_code_uk, p_size AS size_m2,
    p_type AS kinds FROM {part}
""")
def clean_column_names(spark, sf_dir):
    """P7-P10, P12, P14, P15."""
    ugly = table(spark, sf_dir, "part").toDF(
        "PART21CD", "Brand Name", "Brand-Code (UK)", "Kind's", "Size/m2", "ObjectId"
    )
    ugly = drop_if_present(ugly, "ObjectId", "GlobalID")
    cleaned = clean_names(ugly, strip_underscores=True)
    renamed = rename_strict(cleaned, {"part21cd": remove_numbers("PART21CD")})
    shouted = apply_names(renamed, upper_underscore)
    return shouted.withColumnsRenamed(get_rename_dict(shouted))


@check("clashing_names", """
SELECT p_partkey AS value_1, p_size AS value_2, p_retailprice AS value, p_name AS size FROM {part}
""")
def clashing_names(spark, sf_dir):
    """Names that become alike are numbered, the last keeps the bare name."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_name")
    clashing = parts.toDF("Value", "VALUE", "value", "Size")
    return clashing.toDF(*get_rename_dict(clashing).values())


@check("unnest_structs", """
SELECT c_custkey, c_name AS name, c_acctbal AS x, cast(c_nationkey AS double) AS y FROM {customer}
""")
def unnest_structs(spark, sf_dir):
    """P16."""
    nested = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.lit("g").alias("GlobalID")).alias("attributes"),
        F.struct(
            F.col("c_acctbal").alias("x"), F.col("c_nationkey").cast("double").alias("y")
        ).alias("geometry"),
    )
    return unnest(nested, "attributes", "geometry", drop=["GlobalID"])
