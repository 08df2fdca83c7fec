"""Emissions, traffic, deprivation and tenure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions.names import apply_names, clean_names, space_underscore
from civicspark.operators.aggregates import ratio_of_sums
from civicspark.operators.columns import drop_strict, join_side_by_side, rename_strict
from civicspark.operators.filters import (
    differs, flag_matching, in_codes, in_codes_of_first_column, latest_period,
)
from civicspark.operators.joins import lookup_join
from civicspark.operators.quality import distinct_by_key, distinct_rows, require_columns
from civicspark.operators.reshape import indicator_name, pivot_joint, pivot_unique, unpivot_not_null

Codes = DataFrame | Sequence[str] | None

# Names an authority-code column may have, in order of preference.
LA_CODE_COLUMNS = (
    "LA Code", "Local Authority Code", "LA_Code", "ladcd", "local_authority_code",
)

# Columns of the wide emissions table that are not sectors.
EMISSIONS_KEEP = (
    "region_country", "second_tier_authority", "local_authority", "local_authority_code",
    "calendar_year", "population_000s_mid_year_estimate", "per_capita_emissions_t_co2e",
    "area_km2", "grand_total", "emissions_per_km2_kt_co2e",
)

# Columns of the long emissions table, in order.
EMISSIONS_LONG = (
    "region_country", "local_authority", "local_authority_code", "calendar_year",
    "population_000s_mid_year_estimate", "per_capita_emissions_t_co2e", "area_km2",
    "emissions_per_km2_kt_co2e", "sector", "total_bool", "grand_total", "emissions_kt_co2e",
    "cauthcd", "cauthnm",
)

# Fixed value: sectors that are totals; land use is one without being named so.
TOTAL_SECTORS = "_total$|lulucf_net_emissions"

# Columns the sub-sector view leaves out.
SUBSECTOR_HIDDEN = (
    "country", "country_code", "region", "ladcd", "ladnm", "second_tier_authority",
)


def transform_ghg_emissions(raw: DataFrame, la_codes: Codes = None) -> DataFrame:
    """Distinct rows, on request only of some authorities."""
    if la_codes is not None:
        raw = in_codes_of_first_column(raw, LA_CODE_COLUMNS, la_codes)
    return distinct_rows(raw)


def transform_dft_lookup(raw: DataFrame, la_codes: Codes = None) -> DataFrame:
    """Authority ids of the latest year of the whole input, then of some authorities.

    An authority without a row in that year is not in the result.
    """
    require_columns(raw, ["local_authority_id", "local_authority_code", "year"])
    latest = latest_period(raw, "year").select(
        F.col("local_authority_id").alias("dft_la_id"),
        F.col("local_authority_code").alias("ladcd"),
        "year",
    )
    return latest if la_codes is None else in_codes(latest, "ladcd", la_codes)


def transform_imd_2025(raw: DataFrame, lsoa_codes: Codes = None) -> DataFrame:
    """One row per small area, on request only of some areas."""
    if "lsoa21_code" not in raw.columns:
        raise ValueError(f"'lsoa21_code' column not found among {raw.columns}")
    if lsoa_codes is not None:
        raw = in_codes(raw, "lsoa21_code", lsoa_codes)
    return distinct_by_key(raw, "lsoa21_code")


def deprivation_wide(
    raw: DataFrame, labels: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """2019 indices, long to one row per small area and one column per
    (indicator, measurement).  Pass the pairs to spare the job that looks them up."""
    named = rename_strict(apply_names(raw, space_underscore), {"featurecode": "lsoa11cd"})
    return pivot_joint(
        drop_strict(named, ["datecode", "units"]),
        ["lsoa11cd"], ["indices_of_deprivation", "measurement"], "value",
        labels, indicator_name,
    )


def tenure_wide(raw: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Census tenure, long to one row per small area and one column per tenure."""
    wide = pivot_unique(
        raw, ["GEOGRAPHY_NAME", "GEOGRAPHY_CODE"], "C2021_TENURE_9_NAME", "OBS_VALUE", labels
    )
    return rename_strict(
        clean_names(wide), {"geography_name": "lsoa_name", "geography_code": "lsoa21cd"}
    )


def subsector_emissions_view(emissions: DataFrame, lookup: DataFrame) -> DataFrame:
    """V2: emissions of authorities in a combined authority, less the hidden columns."""
    joined = join_side_by_side(emissions, lookup, [("local_authority_code", "ladcd")])
    return drop_strict(joined, SUBSECTOR_HIDDEN)


def per_capita_emissions_view(
    emissions: DataFrame, lookup: DataFrame, exclude_la: str | None = None
) -> DataFrame:
    """V8: emissions per head by combined authority and year, a ratio of sums.

    The excluded authority, and any without a name, is left out of both sums.
    """
    members = lookup if exclude_la is None else differs(lookup, "ladnm", exclude_la)
    joined = lookup_join(
        emissions.select(
            "local_authority_code", "calendar_year", "grand_total",
            "population_000s_mid_year_estimate",
        ),
        members.select("ladcd", "cauthnm"), "local_authority_code", "ladcd",
    )
    rates = ratio_of_sums(
        joined, ["calendar_year", "cauthnm"], "grand_total",
        "population_000s_mid_year_estimate", "per_cap",
    )
    return rates.select("calendar_year", F.col("cauthnm").alias("area"), "per_cap")


def emissions_long_table(emissions: DataFrame, lookup: DataFrame) -> DataFrame:
    """V9: one row per authority, year and sector that has a value, totals flagged.

    The lookup is joined before the unpivot, which multiplies the rows by the sectors.
    """
    sectors = [c for c in emissions.columns if c.lower() not in EMISSIONS_KEEP]
    members = lookup.select("ladcd", "cauthcd", "cauthnm")
    joined = lookup_join(emissions, members, "local_authority_code", "ladcd")
    long = unpivot_not_null(
        joined, [*EMISSIONS_KEEP, "cauthcd", "cauthnm"], "sector", "emissions_kt_co2e",
        sectors, "double",
    )
    flagged = flag_matching(long, "sector", TOTAL_SECTORS, "total_bool")
    return flagged.select(*EMISSIONS_LONG)
