"""Building certificates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions.geometry import make_point, point_text
from civicspark.functions.names import apply_names, upper_underscore
from civicspark.functions.scalars import (
    bulk_archive_url, clean_tenure, construction_epoch, date_parts, nominal_construction_year,
    point_label, require_certificate_type,
)
from civicspark.operators.columns import add_chained, join_side_by_side, select_layout
from civicspark.operators.filters import Box, in_box, in_codes, not_null
from civicspark.operators.joins import enrich, enrich_dimension, latest_per_key, lookup_join
from civicspark.operators.quality import (
    cast_to_schema, distinct_by_key, missing_columns, parse_date_if_text, require_columns,
)
from civicspark.operators.sets import union_all
from civicspark.plans.geography import region_codes
from civicspark.schemas import NON_DOMESTIC_CERTIFICATES
from civicspark.sources.files import read_certificate_pages
from civicspark.sources.keyed import KeyedTable
from civicspark.sources.sinks import replace_table, upsert_by_key
from civicspark.streaming.periods import next_period_value, period_after

# Postcode columns the domestic view shows, in order.
POSTCODE_COLUMNS = (
    "lsoa21cd", "msoa21cd", "lsoa11cd", "msoa11cd", "lat", "long", "north1m", "east1m",
    "geom_text", "imd20ind", "pcds",
)

# Domestic publication layout, published name: view column.
DOMESTIC_LAYOUT = {
    "lmk_key": "LMK_KEY",
    "uprn": "UPRN",
    "local_authority": "LOCAL_AUTHORITY",
    "property_type": "PROPERTY_TYPE",
    "transaction_type": "TRANSACTION_TYPE",
    "tenure": "TENURE_CLEAN",
    "walls_description": "WALLS_DESCRIPTION",
    "roof_description": "ROOF_DESCRIPTION",
    "walls_energy_eff": "WALLS_ENERGY_EFF",
    "roof_energy_eff": "ROOF_ENERGY_EFF",
    "mainheat_description": "MAINHEAT_DESCRIPTION",
    "mainheat_energy_eff": "MAINHEAT_ENERGY_EFF",
    "main_fuel": "MAIN_FUEL",
    "solar_water_heating_flag": "SOLAR_WATER_HEATING_FLAG",
    "construction_age_band": "CONSTRUCTION_AGE_BAND",
    "current_energy_rating": "CURRENT_ENERGY_RATING",
    "potential_energy_rating": "POTENTIAL_ENERGY_RATING",
    "co2_emissions_current": "CO2_EMISSIONS_CURRENT",
    "co2_emissions_potential": "CO2_EMISSIONS_POTENTIAL",
    "co2_emiss_curr_per_floor_area": "CO2_EMISS_CURR_PER_FLOOR_AREA",
    "number_habitable_rooms": "NUMBER_HABITABLE_ROOMS",
    "number_heated_rooms": "NUMBER_HEATED_ROOMS",
    "photo_supply": "PHOTO_SUPPLY",
    "total_floor_area": "TOTAL_FLOOR_AREA",
    "building_reference_number": "BUILDING_REFERENCE_NUMBER",
    "built_form": "BUILT_FORM",
    "lsoa21cd": "lsoa21cd",
    "msoa21cd": "msoa21cd",
    "lat": "lat",
    "long": "long",
    "imd20ind": "index_of_multiple_deprivation_imd_rank",
    "total": "total_all_households",
    "owned": "owned",
    "social_rented": "social_rented",
    "private_rented": "private_rented",
    "date": "LODGEMENT_DATE",
    "year": "LODGEMENT_YEAR",
    "month": "LODGEMENT_MONTH",
    "n_imd_decile": "index_of_multiple_deprivation_imd_decile",
    "n_nominal_construction_date": "NOMINAL_CONSTRUCTION_YEAR",
    "construction_epoch": "CONSTRUCTION_EPOCH",
    "ladnm": "LOCAL_AUTHORITY_LABEL",
    "geo_point_2d": "geo_point_2d",
}

# Non-domestic publication layout, published name: view column.
NON_DOMESTIC_LAYOUT = {
    "uprn": "UPRN",
    "lmk_key": "LMK_KEY",
    "building_reference_number": "BUILDING_REFERENCE_NUMBER",
    "asset_rating": "ASSET_RATING",
    "asset_rating_band": "ASSET_RATING_BAND",
    "property_type": "PROPERTY_TYPE",
    "local_authority": "LOCAL_AUTHORITY",
    "constituency": "CONSTITUENCY",
    "transaction_type": "TRANSACTION_TYPE",
    "standard_emissions": "STANDARD_EMISSIONS",
    "typical_emissions": "TYPICAL_EMISSIONS",
    "target_emissions": "TARGET_EMISSIONS",
    "building_emissions": "BUILDING_EMISSIONS",
    "building_level": "BUILDING_LEVEL",
    "renewable_sources": "RENEWABLE_SOURCES",
    "date": "LODGEMENT_DATE",
    "year": "LODGEMENT_YEAR",
    "month": "LODGEMENT_MONTH",
    "ladcd": "ladcd",
    "ladnm": "ladnm",
    "cauthcd": "cauthcd",
    "cauthnm": "cauthnm",
    "lsoa21cd": "lsoa21cd",
    "lat": "lat",
    "long": "long",
    "geo_point_2d": "geo_point_2d",
}


def make_zipfile_list(
    lookup: DataFrame, base_url: str, cert_type: str = "domestic"
) -> DataFrame:
    """C14: (url, ladcd) of each authority's bulk archive."""
    require_certificate_type(cert_type)
    require_columns(lookup, ["ladnm", "ladcd"])
    url = bulk_archive_url(base_url, cert_type, F.col("ladcd"), F.col("ladnm"))
    return lookup.select(url.alias("url"), "ladcd")


def transform_epc_domestic(raw: DataFrame) -> DataFrame:
    """Published names, one row per key, real dates, no row without a rating.

    Of several rows with one key, one that has a rating is kept, and of those the latest
    lodged, so no key is lost to an unrated copy.
    """
    named = apply_names(raw, upper_underscore)
    require_columns(named, ["LMK_KEY", "INSPECTION_DATE", "LODGEMENT_DATE", "CURRENT_ENERGY_RATING"])
    dated = parse_date_if_text(named, "INSPECTION_DATE", "LODGEMENT_DATE")
    order = [F.col("CURRENT_ENERGY_RATING").isNull(), F.col("LODGEMENT_DATE").desc_nulls_last()]
    if not missing_columns(dated, ["LODGEMENT_DATETIME"]):
        order.append(F.col("LODGEMENT_DATETIME").desc_nulls_last())
    return not_null(distinct_by_key(dated, "LMK_KEY", order), "CURRENT_ENERGY_RATING")


def transform_epc_nondomestic(raw: DataFrame) -> DataFrame:
    """Published names, declared types (a misfit becomes NULL), one row per key."""
    typed = cast_to_schema(apply_names(raw, upper_underscore), NON_DOMESTIC_CERTIFICATES)
    return distinct_by_key(typed, "LMK_KEY", [F.col("LODGEMENT_DATETIME").desc_nulls_last()])


def certificate_updates(pages: Sequence[DataFrame]) -> DataFrame:
    """Landed pages as one frame under the table's names, ready for an upsert."""
    return apply_names(union_all(pages), upper_underscore)


def refresh_certificate_table(
    spark: SparkSession,
    root: str,
    landed: str,
    cert_type: str = "domestic",
    la_codes: DataFrame | Sequence[str] | None = None,
    to_period: tuple[int, int] | None = None,
    multi_line: bool = True,
) -> KeyedTable:
    """Bring a keyed certificate table up to date from landed pages, in place.

    Pages are taken from the month after the latest date in the table's own record, so the
    table is not scanned for it, and only the buckets of updated keys are rewritten.
    """
    table = KeyedTable.open(spark, root)
    if table.state.high_water is None:
        raise ValueError(f"{root} keeps no date to go on from")
    start = period_after(date.fromisoformat(table.state.high_water))
    pages = read_certificate_pages(
        spark, landed, cert_type, from_period=start, to_period=to_period, multi_line=multi_line
    )
    if la_codes is not None:
        pages = in_codes(pages, "local-authority", la_codes)
    return table.upsert(certificate_updates([pages]), ["LODGEMENT_DATETIME"])


def refresh_certificates(
    spark: SparkSession,
    base: DataFrame,
    landed: str,
    target: str,
    cert_type: str = "domestic",
    la_codes: DataFrame | Sequence[str] | None = None,
    published: DataFrame | None = None,
    published_date: str = "date",
    to_period: tuple[int, int] | None = None,
) -> DataFrame:
    """Bring a certificate table up to date from landed pages, written to a new path.

    Pages are taken from the month after the latest published date (of ``published``, or
    of the table's own lodgement dates) to ``to_period``, by default the previous month.
    """
    start = (
        next_period_value(base, "LODGEMENT_DATE")
        if published is None
        else next_period_value(published, published_date)
    )
    pages = read_certificate_pages(
        spark, landed, cert_type, from_period=start, to_period=to_period
    )
    if la_codes is not None:
        pages = in_codes(pages, "local-authority", la_codes)
    updates = certificate_updates([pages])
    return replace_table(
        upsert_by_key(base, updates, "LMK_KEY", ["LODGEMENT_DATETIME"]), target
    )


def domestic_enriched_view(
    certificates: DataFrame,
    postcodes: DataFrame,
    tenure: DataFrame,
    deprivation: DataFrame,
    clash: str = "drop",
) -> DataFrame:
    """V3: the latest certificates of each property with derived and area columns.

    Derived columns are computed for the rows that are left.  Tenure and deprivation are attached to the postcodes first, so the certificates are
    shuffled for the latest-per-property step and for one enrichment, not for three.
    """
    derived = add_chained(
        latest_per_key(certificates, "UPRN", "LODGEMENT_DATETIME"),
        [
            ("NOMINAL_CONSTRUCTION_YEAR", nominal_construction_year("CONSTRUCTION_AGE_BAND")),
            ("CONSTRUCTION_EPOCH", construction_epoch("NOMINAL_CONSTRUCTION_YEAR")),
            ("TENURE_CLEAN", clean_tenure("TENURE")),
            *date_parts("LODGEMENT_DATETIME").items(),
        ],
    )
    if missing_columns(postcodes, ["geom"]):
        postcodes = postcodes.withColumn("geom", make_point("long", "lat"))
    places = postcodes.withColumn("geom_text", point_text("geom")).select(*POSTCODE_COLUMNS)
    areas = enrich_dimension(
        places,
        [(tenure, "lsoa21cd", "lsoa21cd"), (deprivation, "lsoa11cd", "lsoa11cd")],
        clash,
    )
    return enrich(derived, areas, "POSTCODE", "pcds", clash)


def domestic_region_view(
    enriched: DataFrame, lookup: DataFrame, region: str, box: Box = Box()
) -> DataFrame:
    """V4: V3 within one region and box.  The property's latest certificate is chosen among
    all its certificates first; Spark still moves both filters to the scans' side of the
    joins, where they cannot change that choice."""
    return in_box(in_codes(enriched, "LOCAL_AUTHORITY", region_codes(lookup, region)), box)


def domestic_publication_view(region_view: DataFrame) -> DataFrame:
    """V5: V4 in the published layout."""
    labelled = region_view.withColumn("geo_point_2d", point_label("lat", "long"))
    return select_layout(labelled, DOMESTIC_LAYOUT)


def non_domestic_view(
    certificates: DataFrame, lookup: DataFrame, postcodes: DataFrame, region: str
) -> DataFrame:
    """V6: latest non-domestic certificates of one region with authority and place."""
    latest = latest_per_key(certificates, "UPRN", "LODGEMENT_DATETIME")
    regional = in_codes(latest, "LOCAL_AUTHORITY", region_codes(lookup, region))
    with_authority = join_side_by_side(regional, lookup, [("LOCAL_AUTHORITY", "ladcd")])
    places = postcodes.select("pcds", "lsoa21cd", "lat", "long")
    placed = lookup_join(with_authority, places, "POSTCODE", "pcds").drop("pcds")
    return placed.withColumns(date_parts("LODGEMENT_DATETIME"))


def non_domestic_publication_view(view: DataFrame, box: Box = Box()) -> DataFrame:
    """V7: V6 within the box, in the published layout."""
    labelled = in_box(view, box).withColumn("geo_point_2d", point_label("lat", "long"))
    return select_layout(labelled, NON_DOMESTIC_LAYOUT)
