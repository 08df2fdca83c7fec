"""Declared schemas.  Column names and types are fixed values, in their published order."""

from __future__ import annotations

from pyspark.sql import types as T

from civicspark.functions.names import hyphen_lower
from civicspark.functions.scalars import require_certificate_type

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(10, 2),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(listing: str) -> T.StructType:
    """Schema from ``name type, name type``; needs no session, unlike a DDL string."""
    pairs = [entry.strip().rsplit(" ", 1) for entry in listing.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Domestic certificates, 93 columns; every decimal is (10, 2).
DOMESTIC_CERTIFICATES = _struct("""
    LMK_KEY string, ADDRESS1 string, ADDRESS2 string, ADDRESS3 string, POSTCODE string,
    BUILDING_REFERENCE_NUMBER string, CURRENT_ENERGY_RATING string,
    POTENTIAL_ENERGY_RATING string, CURRENT_ENERGY_EFFICIENCY int,
    POTENTIAL_ENERGY_EFFICIENCY int, PROPERTY_TYPE string, BUILT_FORM string,
    INSPECTION_DATE date, LOCAL_AUTHORITY string, CONSTITUENCY string, COUNTY string,
    LODGEMENT_DATE date, TRANSACTION_TYPE string, ENVIRONMENT_IMPACT_CURRENT int,
    ENVIRONMENT_IMPACT_POTENTIAL int, ENERGY_CONSUMPTION_CURRENT double,
    ENERGY_CONSUMPTION_POTENTIAL double, CO2_EMISSIONS_CURRENT decimal,
    CO2_EMISS_CURR_PER_FLOOR_AREA decimal, CO2_EMISSIONS_POTENTIAL decimal,
    LIGHTING_COST_CURRENT double, LIGHTING_COST_POTENTIAL double,
    HEATING_COST_CURRENT double, HEATING_COST_POTENTIAL double,
    HOT_WATER_COST_CURRENT double, HOT_WATER_COST_POTENTIAL double,
    TOTAL_FLOOR_AREA decimal, ENERGY_TARIFF string, MAINS_GAS_FLAG string,
    FLOOR_LEVEL string, FLAT_TOP_STOREY string, FLAT_STOREY_COUNT decimal,
    MAIN_HEATING_CONTROLS string, MULTI_GLAZE_PROPORTION double, GLAZED_TYPE string,
    GLAZED_AREA string, EXTENSION_COUNT int, NUMBER_HABITABLE_ROOMS double,
    NUMBER_HEATED_ROOMS double, LOW_ENERGY_LIGHTING int, NUMBER_OPEN_FIREPLACES int,
    HOTWATER_DESCRIPTION string, HOT_WATER_ENERGY_EFF string, HOT_WATER_ENV_EFF string,
    FLOOR_DESCRIPTION string, FLOOR_ENERGY_EFF string, FLOOR_ENV_EFF string,
    WINDOWS_DESCRIPTION string, WINDOWS_ENERGY_EFF string, WINDOWS_ENV_EFF string,
    WALLS_DESCRIPTION string, WALLS_ENERGY_EFF string, WALLS_ENV_EFF string,
    SECONDHEAT_DESCRIPTION string, SHEATING_ENERGY_EFF string, SHEATING_ENV_EFF string,
    ROOF_DESCRIPTION string, ROOF_ENERGY_EFF string, ROOF_ENV_EFF string,
    MAINHEAT_DESCRIPTION string, MAINHEAT_ENERGY_EFF string, MAINHEAT_ENV_EFF string,
    MAINHEATCONT_DESCRIPTION string, MAINHEATC_ENERGY_EFF string, MAINHEATC_ENV_EFF string,
    LIGHTING_DESCRIPTION string, LIGHTING_ENERGY_EFF string, LIGHTING_ENV_EFF string,
    MAIN_FUEL string, WIND_TURBINE_COUNT double, HEAT_LOSS_CORRIDOR string,
    UNHEATED_CORRIDOR_LENGTH decimal, FLOOR_HEIGHT decimal, PHOTO_SUPPLY double,
    SOLAR_WATER_HEATING_FLAG string, MECHANICAL_VENTILATION string, PROPERTY_ADDRESS string,
    LOCAL_AUTHORITY_LABEL string, CONSTITUENCY_LABEL string, POSTTOWN string,
    CONSTRUCTION_AGE_BAND string, LODGEMENT_DATETIME timestamp, TENURE string,
    FIXED_LIGHTING_OUTLETS_COUNT double, LOW_ENERGY_FIXED_LIGHT_COUNT double, UPRN string,
    UPRN_SOURCE string, REPORT_TYPE int
""")

# Non-domestic certificates, 41 columns.
NON_DOMESTIC_CERTIFICATES = _struct("""
    LMK_KEY string, ADDRESS1 string, ADDRESS2 string, ADDRESS3 string, POSTCODE string,
    BUILDING_REFERENCE_NUMBER string, ASSET_RATING int, ASSET_RATING_BAND string,
    PROPERTY_TYPE string, INSPECTION_DATE date, LOCAL_AUTHORITY string,
    CONSTITUENCY string, COUNTY string, LODGEMENT_DATE date, TRANSACTION_TYPE string,
    NEW_BUILD_BENCHMARK string, EXISTING_STOCK_BENCHMARK string, BUILDING_LEVEL string,
    MAIN_HEATING_FUEL string, OTHER_FUEL_DESC string, SPECIAL_ENERGY_USES string,
    RENEWABLE_SOURCES string, FLOOR_AREA int, STANDARD_EMISSIONS decimal,
    TARGET_EMISSIONS decimal, TYPICAL_EMISSIONS decimal,
    BUILDING_EMISSIONS decimal, AIRCON_PRESENT string,
    AIRCON_KW_RATING decimal, ESTIMATED_AIRCON_KW_RATING decimal,
    AC_INSPECTION_COMMISSIONED int, BUILDING_ENVIRONMENT string, ADDRESS string,
    LOCAL_AUTHORITY_LABEL string, CONSTITUENCY_LABEL string, POSTTOWN string,
    LODGEMENT_DATETIME timestamp, PRIMARY_ENERGY_VALUE int, UPRN bigint,
    UPRN_SOURCE string, REPORT_TYPE int
""")

# Postcode directory columns whose type must not be inferred.
POSTCODE_OVERRIDES = {
    "ruc11ind": "string",
    "ruc21ind": "string",
    "north1m": "bigint",
    "ssr95cd": "string",
}

# Older postcode directory, 53 columns.
POSTCODES = _struct("""
    pcd string, pcd2 string, pcds string, dointr int, doterm int, oscty string, ced string,
    oslaua string, osward string, parish string, usertype int, oseast1m int, osnrth1m int,
    osgrdind int, oshlthau string, nhser string, ctry string, rgn string, streg string,
    pcon string, eer string, teclec string, ttwa string, pct string, itl string,
    statsward string, oa01 string, casward string, npark string, lsoa01 string,
    msoa01 string, ur01ind string, oac01 string, oa11 string, lsoa11 string, msoa11 string,
    wz11 string, sicbl string, bua11 string, buasd11 string, ru11ind string, oac11 string,
    lat double, long double, lep1 string, lep2 string, pfa string, imd int, calncv string,
    icb string, oa21 string, lsoa21 string, msoa21 string
""")

# Combined-authority to local-authority lookup.
AUTHORITY_LOOKUP = _struct(
    "ladcd string, ladnm string, cauthcd string, cauthnm string"
)

# Census tenure, long form.
TENURE_LONG = _struct("""
    GEOGRAPHY_NAME string, GEOGRAPHY_CODE string, C2021_TENURE_9_NAME string,
    C2021_TENURE_9_SORTORDER int, OBS_VALUE bigint
""")

# Deprivation indices, long form.
DEPRIVATION_LONG = _struct("""
    FeatureCode string, DateCode int, Measurement string, Units string, Value double,
    Indices of Deprivation string
""")


def certificate_schema(cert_type: str) -> T.StructType:
    """Table schema of a certificate type."""
    domestic = require_certificate_type(cert_type) == "domestic"
    return DOMESTIC_CERTIFICATES if domestic else NON_DOMESTIC_CERTIFICATES


def page_schema(cert_type: str) -> T.StructType:
    """The same columns under the hyphenated names landed pages carry."""
    return T.StructType(
        [
            T.StructField(hyphen_lower(field.name), field.dataType)
            for field in certificate_schema(cert_type).fields
        ]
    )
