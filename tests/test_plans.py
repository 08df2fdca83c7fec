"""V1-V28, I1-I3."""

import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from civicspark.operators.filters import Box
from civicspark.plans.certificates import (
    DOMESTIC_LAYOUT, NON_DOMESTIC_LAYOUT, certificate_updates, domestic_enriched_view,
    domestic_publication_view, domestic_region_view, make_zipfile_list,
    non_domestic_publication_view, non_domestic_view, refresh_certificates, transform_epc_domestic,
    transform_epc_nondomestic,
)
from civicspark.plans.emissions import (
    EMISSIONS_LONG, deprivation_wide, emissions_long_table, per_capita_emissions_view,
    subsector_emissions_view, tenure_wide, transform_dft_lookup, transform_ghg_emissions,
    transform_imd_2025,
)
from civicspark.plans.etl import RunReport, build_tables, extract_all, run_full_etl
from civicspark.plans.geography import (
    add_geometry_column, add_geometry_column_from_wkt, consolidate_lookups, get_ca_la_codes,
    region_centroids, simple_geography_view, small_area_chunks, small_area_codes,
    transform_ca_la_lookup, transform_lsoa_pwc,
)
from civicspark.plans.views import VIEWS, Region, create_all_views
from civicspark.schemas import DOMESTIC_CERTIFICATES, NON_DOMESTIC_CERTIFICATES, page_schema
from civicspark.streaming.periods import (
    next_period, next_period_value, previous_month, three_months_back,
)
from civicspark.streaming.refresh import refresh_table
from tests.conftest import rows_of

EXTRA = {"ladcd": "E06000024", "ladnm": "Two", "cauthcd": "E47000009", "cauthnm": "Region A"}


# Geography


def test_v11_lookup(raw_lookup):
    clean = transform_ca_la_lookup(raw_lookup)
    assert clean.columns == ["ladcd", "ladnm", "cauthcd", "cauthnm"]
    assert clean.count() == 3
    extended = transform_ca_la_lookup(raw_lookup.drop("ObjectId"), [EXTRA])
    assert extended.where("ladcd = 'E06000024'").count() == 1
    assert transform_ca_la_lookup(raw_lookup, [EXTRA, EXTRA]).count() == 5


def test_v12_centroids(spark, raw_centroids):
    clean = transform_lsoa_pwc(raw_centroids.union(raw_centroids))
    assert clean.columns == ["lsoa21cd", "lsoa21nm", "x", "y", "geometry"]
    assert clean.count() == 3
    with pytest.raises(ValueError, match="Required geometry columns"):
        transform_lsoa_pwc(raw_centroids.drop("X"))


def test_v13_codes(spark, lookup):
    assert rows_of(get_ca_la_codes(lookup)) == [("E06000022",), ("E06000023",), ("E06000025",)]
    with pytest.raises(ValueError, match="'ladcd' column not found"):
        get_ca_la_codes(lookup.drop("ladcd"))


def test_v1_geography_columns_of_both_sides(spark, lookup):
    postcodes = spark.createDataFrame(
        [("P1", "E06000023", "L1", 51.5, -2.5, "x"), ("P2", "E06000022", "L2", 51.5, -2.5, "x")],
        "pcds string, lad25cd string, lsoa21cd string, lat double, long double, oac string",
    )
    view = simple_geography_view(postcodes, lookup, "Region A")
    assert view.columns == ["pcds", "lad25cd", "lsoa21cd", "lat", "long", "ladcd", "ladnm"]
    assert rows_of(view) == [("P1", "E06000023", "L1", 51.5, -2.5, "E06000023", "One")]


def test_v21_v22_small_areas(spark):
    first = spark.createDataFrame([("L1", "A1", 1), ("L1", "A1", 1)], "LSOA21CD string, LAD24CD string, N int")
    second = spark.createDataFrame([("L2", "A1", 1.5), ("L3", "A2", 2.0)], "LSOA21CD string, LAD24CD string, N double")
    both = consolidate_lookups([first, second])
    assert rows_of(both) == [("L1", "A1", 1.0), ("L2", "A1", 1.5), ("L3", "A2", 2.0)]
    codes = small_area_codes(both, ["A1"])
    assert rows_of(codes) == [("L1",), ("L2",)]
    assert rows_of(small_area_chunks(codes, size=1).select("codes")) == [("L1",), ("L2",)]
    centroids = spark.createDataFrame([("L1", 0.5), ("L9", 0.5)], "lsoa21cd string, x double")
    assert rows_of(region_centroids(centroids, codes)) == [("L1", 0.5)]


def test_v27_v28_geometry_columns(spark, raw_centroids):
    named = spark.createDataFrame([(-2.5, 51.5)], "longitude double, latitude double")
    placed = add_geometry_column(named, "longitude", "latitude", "location")
    again = add_geometry_column(placed, "longitude", "latitude", "location")
    assert again.columns == ["longitude", "latitude", "location"]
    assert tuple(again.first()["location"]) == (-2.5, 51.5)
    shaped = add_geometry_column_from_wkt(raw_centroids, "GEOMETRY")
    assert shaped.first()["geom"]["parts"][0][0][0]["x"] == -2.5879
    with pytest.raises(ValueError):
        add_geometry_column(named)


# Emissions, traffic, deprivation, tenure


def test_v14_emissions(spark, emissions):
    assert transform_ghg_emissions(emissions.union(emissions)).count() == 4
    assert transform_ghg_emissions(emissions, ["E06000023", "E06000024"]).count() == 2
    for name in ("ladcd", "local_authority_code", "Local Authority Code"):
        renamed = emissions.withColumnRenamed("LA Code", name)
        assert transform_ghg_emissions(renamed, ["E06000023"]).count() == 1


def test_v15_traffic(spark, traffic):
    latest = transform_dft_lookup(traffic)
    assert latest.columns == ["dft_la_id", "ladcd", "year"]
    assert rows_of(latest) == [(801, "E06000023", 2023), (802, "E06000024", 2023), (803, "E06000025", 2023)]
    assert transform_dft_lookup(traffic, ["E99999999"]).count() == 0
    with pytest.raises(ValueError, match="Missing required columns"):
        transform_dft_lookup(traffic.select("year"))


def test_t10_authority_without_the_latest_year_is_gone(spark, traffic):
    older = traffic.where("NOT (local_authority_id = 801 AND year = 2023)")
    assert transform_dft_lookup(older, ["E06000023"]).count() == 0


def test_v16_deprivation(spark, deprivation):
    assert transform_imd_2025(deprivation.union(deprivation)).count() == 4
    assert transform_imd_2025(deprivation).columns == deprivation.columns
    codes = deprivation.limit(2).select("lsoa21_code")
    assert transform_imd_2025(deprivation, codes).count() == 2
    with pytest.raises(ValueError, match="'lsoa21_code' column not found"):
        transform_imd_2025(deprivation.drop("lsoa21_code"))


def test_v19_published_names(spark):
    rows = [
        ("L1", 2019, measure, "u", value, "a. Index of Multiple Deprivation (IMD)")
        for measure, value in (("Rank", 100.0), ("Decile", 3.0))
    ]
    raw = spark.createDataFrame(rows, (
        "FeatureCode string, DateCode int, Measurement string, Units string, Value double, "
        "`Indices of Deprivation` string"
    ))
    wide = deprivation_wide(raw)
    assert set(wide.columns) == {
        "lsoa11cd", "index_of_multiple_deprivation_imd_rank", "index_of_multiple_deprivation_imd_decile",
    }
    assert wide.first()["index_of_multiple_deprivation_imd_rank"] == 100.0


def test_v20_tenure(spark):
    rows = [
        ("Area 1", "L1", "Total: All households", 1, 12), ("Area 1", "L1", "Owned", 2, 7),
        ("Area 2", "L2", "Total: All households", 1, 5),
    ]
    raw = spark.createDataFrame(rows, (
        "GEOGRAPHY_NAME string, GEOGRAPHY_CODE string, C2021_TENURE_9_NAME string, "
        "C2021_TENURE_9_SORTORDER int, OBS_VALUE bigint"
    ))
    wide = tenure_wide(raw)
    assert sorted(wide.columns) == ["lsoa21cd", "lsoa_name", "owned", "total_all_households"]
    assert rows_of(wide.select("lsoa21cd", "owned", "total_all_households")) == [("L1", 7, 12), ("L2", None, 5)]
    with pytest.raises(PySparkException, match="more than one value"):
        tenure_wide(raw.union(raw)).collect()


WIDE_EMISSIONS = (
    "region_country string, second_tier_authority string, local_authority string, "
    "local_authority_code string, calendar_year int, industry_gas double, industry_total double, "
    "lulucf_net_emissions double, grand_total double, population_000s_mid_year_estimate double, "
    "per_capita_emissions_t_co2e double, area_km2 double, emissions_per_km2_kt_co2e double"
)


@pytest.fixture
def wide_emissions(spark):
    return spark.createDataFrame([
        ("E", "T", "One", "E06000023", 2021, 1.0, None, -0.5, 10.0, 4.0, 2.5, 1.0, 10.0),
        ("E", "T", "Three", "E06000025", 2021, 2.0, 3.0, None, 20.0, 1.0, 20.0, 1.0, 20.0),
        ("E", "T", "Five", "E06000022", 2021, 2.0, 3.0, 1.0, 30.0, 0.0, 0.0, 1.0, 30.0),
        ("E", "T", "Else", "E99", 2021, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0),
    ], WIDE_EMISSIONS)


def test_v8_per_capita_is_a_ratio_of_sums(wide_emissions, lookup):
    assert rows_of(per_capita_emissions_view(wide_emissions, lookup)) == [
        (2021, "Region A", 6.0), (2021, "Region B", None),
    ]
    without = per_capita_emissions_view(wide_emissions, lookup, "Three")
    assert rows_of(without) == [(2021, "Region A", 2.5), (2021, "Region B", None)]


def test_v9_long_emissions(wide_emissions, lookup):
    long = emissions_long_table(wide_emissions, lookup)
    assert long.columns == list(EMISSIONS_LONG)
    got = long.select("local_authority", "sector", "total_bool", "emissions_kt_co2e", "cauthcd")
    assert rows_of(got) == sorted([
        ("One", "industry_gas", False, 1.0, "C1"), ("One", "lulucf_net_emissions", True, -0.5, "C1"),
        ("Three", "industry_gas", False, 2.0, "C1"), ("Three", "industry_total", True, 3.0, "C1"),
        ("Five", "industry_gas", False, 2.0, "C2"), ("Five", "industry_total", True, 3.0, "C2"),
        ("Five", "lulucf_net_emissions", True, 1.0, "C2"),
    ], key=repr)


def test_v2_hidden_columns(spark, lookup):
    raw = spark.createDataFrame(
        [("E", "E92", "R", "T", "E06000023", 1.0)],
        "country string, country_code string, region string, second_tier_authority string, "
        "local_authority_code string, kt double",
    )
    assert subsector_emissions_view(raw, lookup).columns == ["local_authority_code", "kt", "cauthcd", "cauthnm"]
    with pytest.raises(ValueError, match="country_code"):
        subsector_emissions_view(raw.drop("country_code"), lookup)


# Certificates


def certificate(spark, schema, rows):
    """Rows given as dicts; whatever they leave out is NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.fieldNames()) for r in rows], schema)


def dom(key, uprn="u1", la="E06000023", stamp=datetime(2024, 1, 1), postcode="P1", **more):
    return {
        "LMK_KEY": key, "UPRN": uprn, "LOCAL_AUTHORITY": la, "LODGEMENT_DATETIME": stamp,
        "LODGEMENT_DATE": stamp.date() if stamp else None, "POSTCODE": postcode, **more,
    }


@pytest.fixture
def areas(spark):
    postcodes = spark.createDataFrame(
        [("P1", "L1", "M1", "O1", "Q1", 51.5, -2.5, 1, 2, 3), ("P2", "L2", "M1", "O2", "Q1", 50.0, -2.5, 1, 2, 3),
         ("P3", "L9", "M1", "O9", "Q1", None, None, 1, 2, 3)],
        "pcds string, lsoa21cd string, msoa21cd string, lsoa11cd string, msoa11cd string, lat double, "
        "long double, north1m bigint, east1m bigint, imd20ind int",
    )
    tenure = spark.createDataFrame(
        [("Area", "L1", 10, 5, 3, 2)],
        "lsoa_name string, lsoa21cd string, total_all_households bigint, owned bigint, "
        "social_rented bigint, private_rented bigint",
    )
    index = spark.createDataFrame(
        [("O1", 100.0, 3.0)],
        "lsoa11cd string, index_of_multiple_deprivation_imd_rank double, index_of_multiple_deprivation_imd_decile double",
    )
    return postcodes, tenure, index


def test_v3_v4_v5_domestic(spark, areas, lookup):
    newer = datetime(2024, 3, 5)
    certificates = certificate(spark, DOMESTIC_CERTIFICATES, [
        dom("old"), dom("tie-a", stamp=newer, CONSTRUCTION_AGE_BAND="1983-1990", TENURE="rental (social)"),
        dom("tie-b", stamp=newer, la="E06000022"),
        dom("moved-old", "u2"), dom("moved-new", "u2", la="E06000022", stamp=newer),
        dom("no-uprn", None), dom("no-stamp", "u3", stamp=None),
        dom("no-place", "u4", postcode="P9"), dom("outside", "u5", postcode="P2"),
        dom("no-coordinates", "u6", postcode="P3"),
    ])
    enriched = domestic_enriched_view(certificates, *areas)
    assert len(enriched.columns) == 93 + 6 + 11 + 5 + 2
    kept = {r["LMK_KEY"]: r for r in enriched.collect()}
    assert set(kept) == {"tie-a", "tie-b", "moved-new", "no-place", "outside", "no-coordinates"}
    first = kept["tie-a"]
    assert (first["NOMINAL_CONSTRUCTION_YEAR"], first["CONSTRUCTION_EPOCH"]) == (1987, "1930 to present")
    assert first["TENURE_CLEAN"] == "Social rented"
    assert (first["LODGEMENT_DAY"], first["LODGEMENT_MONTH"], first["LODGEMENT_YEAR"]) == (5, 3, 2024)
    assert (first["geom_text"], first["owned"]) == ("POINT (-2.5 51.5)", 5)
    assert kept["no-place"]["pcds"] is None and kept["no-coordinates"]["geom_text"] is None

    regional = domestic_region_view(enriched, lookup, "Region A")
    assert [r["LMK_KEY"] for r in regional.collect()] == ["tie-a"]
    published = domestic_publication_view(regional)
    assert published.columns == list(DOMESTIC_LAYOUT) and len(published.columns) == 43
    row = published.first()
    assert (row["geo_point_2d"], row["imd20ind"], row["total"], row["date"]) == (
        "{51.5, -2.5}", 100.0, 10, date(2024, 3, 5),
    )
    wider = domestic_region_view(enriched, lookup, "Region A", Box(south=49.0))
    assert sorted(r["LMK_KEY"] for r in wider.collect()) == ["outside", "tie-a"]


def test_t8_clashing_area_columns(spark, areas):
    certificates = certificate(spark, DOMESTIC_CERTIFICATES, [dom("a")])
    both = domestic_enriched_view(certificates, *areas, clash="suffix")
    assert "lsoa21cd_1" in both.columns and "lsoa11cd_1" in both.columns


def test_v6_v7_non_domestic(spark, areas, lookup):
    def row(key, uprn, la="E06000023", stamp=datetime(2024, 1, 1), postcode="P1"):
        return {
            "LMK_KEY": key, "UPRN": uprn, "LOCAL_AUTHORITY": la, "LODGEMENT_DATETIME": stamp,
            "LODGEMENT_DATE": stamp.date(), "POSTCODE": postcode,
        }

    certificates = certificate(spark, NON_DOMESTIC_CERTIFICATES, [
        row("old", 1), row("new", 1, stamp=datetime(2024, 2, 2)), row("elsewhere", 2, la="E06000022"),
        row("no-place", 3, postcode="P9"), row("outside", 4, postcode="P2"), row("keyless", None),
    ])
    view = non_domestic_view(certificates, lookup, areas[0], "Region A")
    assert len(view.columns) == 41 + 4 + 3 + 3
    assert sorted(r["LMK_KEY"] for r in view.collect()) == ["new", "outside"]
    published = non_domestic_publication_view(view)
    assert published.columns == list(NON_DOMESTIC_LAYOUT) and len(published.columns) == 26
    assert rows_of(published.select("lmk_key", "ladnm", "month", "geo_point_2d")) == [
        ("new", "One", 2, "{51.5, -2.5}")
    ]


def test_v17_domestic_cleanup(spark):
    pages = spark.createDataFrame([
        ("k1", None, "2024-01-31", "2024-02-01"), ("k1", "C", "bad", "2024-01-01"),
        ("k1", "D", "2024-01-01", "2024-01-15"), ("k2", None, "2024-01-01", "2024-01-01"),
        ("k3", "A", "", "x"),
    ], "`lmk-key` string, `current-energy-rating` string, `inspection-date` string, `lodgement-date` string")
    clean = transform_epc_domestic(pages)
    assert clean.columns == ["LMK_KEY", "CURRENT_ENERGY_RATING", "INSPECTION_DATE", "LODGEMENT_DATE"]
    assert rows_of(clean) == [
        ("k1", "D", date(2024, 1, 1), date(2024, 1, 15)), ("k3", "A", None, None),
    ]
    with pytest.raises(ValueError, match="LMK_KEY"):
        transform_epc_domestic(pages.drop("lmk-key"))


def test_v18_non_domestic_cleanup(spark):
    names = page_schema("non-domestic").fieldNames()
    values = {"lmk-key": "k1", "asset-rating": "n/a", "uprn": "12", "standard-emissions": "1.25"}
    pages = spark.createDataFrame(
        [tuple(values.get(n) for n in names)] * 2, ", ".join(f"`{n}` string" for n in names)
    )
    clean = transform_epc_nondomestic(pages)
    assert clean.schema == NON_DOMESTIC_CERTIFICATES
    assert clean.select("LMK_KEY", "ASSET_RATING", "UPRN").collect() == [("k1", None, 12)]


def test_c14_bulk_list(spark, raw_lookup):
    lookup = transform_ca_la_lookup(raw_lookup)
    assert rows_of(make_zipfile_list(lookup, "https://x/")) == [
        ("https://x/domestic-E06000022-Five.zip", "E06000022"),
        ("https://x/domestic-E06000023-One-City-of.zip", "E06000023"),
        ("https://x/domestic-E06000025-St-Three.zip", "E06000025"),
    ]
    with pytest.raises(ValueError):
        make_zipfile_list(lookup, "https://x/", "other")
    with pytest.raises(ValueError, match="ladnm"):
        make_zipfile_list(lookup.drop("ladnm"), "https://x/")


# Views, periods, refresh, runs


def test_v10_registry_reports_what_it_cannot_build(spark, wide_emissions, lookup):
    report = create_all_views(spark, {"emissions": wide_emissions, "ca_la": lookup}, Region("Region A"))
    assert report.created == ["per_cap_emissions_ca_national_vw", "ca_emissions_evidence_long_tbl"]
    assert len(report.failed) == len(VIEWS) - 2
    assert spark.sql("SELECT count(*) FROM ca_emissions_evidence_long_tbl").first()[0] == 7
    with pytest.raises(KeyError):
        create_all_views(spark, {}, Region("Region A"), skip_errors=False)


def test_i1_next_period(spark):
    df = spark.createDataFrame([(date(2023, 12, 31),), (date(2022, 1, 1),), (None,)], "date date")
    assert rows_of(next_period(df, "date")) == [(2024, 1)]
    assert next_period_value(df.where("date < '2023-01-01'"), "date") == (2022, 2)
    with pytest.raises(PySparkException, match="no date published"):
        next_period(df.where("false"), "date").collect()


def test_i2_default_periods():
    assert previous_month(date(2024, 1, 15)) == (2023, 12)
    assert previous_month(date(2024, 12, 1)) == (2024, 11)
    assert three_months_back(date(2024, 2, 1)) == (2024, 1)
    assert three_months_back(date(2024, 9, 1)) == (2024, 6)


def test_v23_updates_take_table_names(spark):
    a = spark.createDataFrame([("k1", 1)], "`lmk-key` string, `report-type` int")
    b = spark.createDataFrame([(2, "k2")], "`report-type` int, `lmk-key` string")
    assert rows_of(certificate_updates([a, b])) == [("k1", 1), ("k2", 2)]


def test_v23_refresh_from_the_next_month_on(spark, tmp_path):
    base = certificate(spark, DOMESTIC_CERTIFICATES, [
        dom("k1", stamp=datetime(2024, 1, 20), TENURE="old"), dom("k2", stamp=datetime(2024, 1, 5), TENURE="old"),
    ])
    names = page_schema("domestic").fieldNames()
    rows = [
        {"lmk-key": k, "local-authority": la, "lodgement-date": d, "tenure": "new"}
        for k, la, d in (
            ("k1", "A1", "2024-02-01"), ("k3", "A1", "2024-03-31"), ("k4", "A2", "2024-02-01"),
            ("k5", "A1", "2024-01-31"), ("k6", "A1", "2024-04-01"),
        )
    ]
    lines = [",".join(names)] + [",".join(r.get(n, "") for n in names) for r in rows]
    land(tmp_path, "pages", "\n".join(lines) + "\n", "csv")
    fresh = refresh_certificates(
        spark, base, str(tmp_path / "pages"), str(tmp_path / "new"), la_codes=["A1"], to_period=(2024, 3)
    )
    assert fresh.schema.fieldNames() == DOMESTIC_CERTIFICATES.fieldNames()
    assert rows_of(fresh.select("LMK_KEY", "TENURE")) == [("k1", "new"), ("k2", "old"), ("k3", "new")]


def test_i3_each_file_is_taken_in_once(spark, tmp_path):
    base = spark.createDataFrame([("k1", "old", 1), ("k2", "old", 1)], "LMK_KEY string, V string, LODGED int")
    page = spark.createDataFrame([], "`lmk-key` string, v string, lodged int").schema
    paths = [str(tmp_path / n) for n in ("landed", "updates", "checkpoint")]
    (tmp_path / "landed").mkdir()

    def run(n):
        return refresh_table(spark, base, paths[0], page, paths[1], paths[2], str(tmp_path / f"t{n}"), order=["LODGED"])

    assert rows_of(run(0)) == rows_of(base)
    (tmp_path / "landed/1.csv").write_text("lmk-key,v,lodged\nk2,new,5\nk2,newer,6\nk3,new,2\n")
    first = [("k1", "old", 1), ("k2", "newer", 6), ("k3", "new", 2)]
    assert rows_of(run(1)) == first
    assert rows_of(run(2)) == first
    (tmp_path / "landed/2.csv").write_text("lmk-key,v,lodged\nk3,later batch,1\n")
    assert rows_of(run(3)) == [*first[:2], ("k3", "later batch", 1)]
    assert len(list((tmp_path / "updates").glob("batch_id=*"))) == 2
    refreshed = spark.read.parquet(str(tmp_path / "t1"))
    onward = refresh_table(
        spark, refreshed, paths[0], page, paths[1], paths[2], str(tmp_path / "t4"),
        order=["LODGED"], after_batch=0,
    )
    assert rows_of(onward) == rows_of(spark.read.parquet(str(tmp_path / "t3")))


def land(root, name, text, suffix):
    (root / name).mkdir(parents=True, exist_ok=True)
    (root / name / f"1.{suffix}").write_text(text)


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"

    def features(name, rows):
        land(root, name, json.dumps({"features": rows}), "json")

    point = {"x": -2.5, "y": 51.5}
    for layer in ("lsoa_2021_pwc", "lsoa_2021_boundaries", "lsoa_2011_boundaries"):
        features(layer, [{"attributes": {"LSOA21CD": c, "GlobalID": "g"}, "geometry": point} for c in ("L1", "L2", "L2")])
    for layer in ("lsoa_2021_lookups", "lsoa_2011_lookups"):
        features(layer, [{"attributes": {"LSOA21CD": "L1", "LAD24CD": "A1"}}])
    features("ca_la_lookup", [{"attributes": {
        "ObjectId": 1, "LAD25CD": "A1", "LAD25NM": "One", "CAUTH25CD": "C1", "CAUTH25NM": "Region A"}}])
    land(root, "ca_boundaries_2025", json.dumps({"features": [{"properties": {"CAUTH25CD": "C1"}, "geometry": {
        "type": "Polygon", "coordinates": [[[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]}}]}), "geojson")
    land(root, "dft_traffic", "local_authority_id,local_authority_code,year\n1,A1,2022\n1,A1,2023\n2,A2,2023\n", "csv")
    land(root, "ghg_emissions", "Local Authority Code,kt\nA1,1\nA1,1\nA2,2\n", "csv")
    land(root, "imd_2025", "lsoa21_code,imd\nL1,1\nL2,2\nL3,3\n", "csv")
    names = page_schema("domestic").fieldNames()
    rows = [
        {"lmk-key": k, "local-authority": la, "lodgement-date": d, "current-energy-rating": "C"}
        for k, la, d in (("k1", "A1", "2024-02-03"), ("k2", "A2", "2024-02-03"), ("k3", "A1", "2023-01-01"))
    ]
    lines = [",".join(names)] + [",".join(r.get(n, "") for n in names) for r in rows]
    land(root, "epc_domestic", "\n".join(lines) + "\n", "csv")
    return root


def counts(report):
    return {r["table_name"]: r["n_rows"] for r in report.inventory().collect()}


def test_v24_full_run(spark, landing, tmp_path):
    report = run_full_etl(
        spark, str(landing), str(tmp_path / "w"), download_epc=True, epc_from_date=(2024, 1),
        today=date(2024, 4, 1),
    )
    assert report.failed == []
    assert counts(report) == {
        "ca_la_lookup": 1, "lsoa_2021_pwc": 2, "ghg_emissions": 1, "dft_la_lookup": 1,
        "imd_2025": 2, "epc_domestic": 1, "epc_nondomestic": 0,
    }
    assert report.tables["lsoa_2021_pwc"].first()["geom"]["x"] == -2.5


def test_v24_without_geography_nothing_is_filtered(spark, landing, tmp_path):
    report = run_full_etl(
        spark, str(landing), str(tmp_path / "w"), skip_arcgis=True, sample_mode=True, sample_size=2,
        download_epc=True, default_la_codes=["A2"], epc_from_date=(2024, 1), today=date(2024, 4, 1),
    )
    assert counts(report) == {
        "ghg_emissions": 1, "dft_la_lookup": 1, "imd_2025": 2, "epc_domestic": 1, "epc_nondomestic": 0,
    }
    assert report.tables["epc_domestic"].first()["LMK_KEY"] == "k2"


def test_t28_step_policies(spark, landing, tmp_path):
    (landing / "lsoa_2021_lookups/1.json").unlink()
    with pytest.raises(PySparkException):
        extract_all(spark, str(landing), str(tmp_path / "a"))
    tolerant = extract_all(spark, str(landing), str(tmp_path / "b"), tolerant=True)
    assert [name for name, _ in tolerant.failed] == ["lsoa_2021_lookups"]
    (landing / "dft_traffic/1.csv").write_text("year\n2023\n")
    report = run_full_etl(spark, str(landing), str(tmp_path / "c"), skip_arcgis=True)
    assert [name for name, _ in report.failed] == ["dft_la_lookup"]
    assert "dft_la_lookup" not in report.tables and "imd_2025" in report.tables


def test_v26_build_checks_keys_and_builds_views(spark, areas, lookup, wide_emissions, tmp_path):
    postcodes, tenure, index = areas
    inputs = {
        "postcodes": postcodes.withColumn("lad25cd", F.lit("E06000023")), "tenure": tenure,
        "imd_lsoa": index, "ca_la": lookup, "emissions": wide_emissions,
        "epc_domestic": certificate(spark, DOMESTIC_CERTIFICATES, [dom("a")]),
        "epc_nondom": certificate(spark, NON_DOMESTIC_CERTIFICATES, [{"LMK_KEY": "n", "UPRN": 1}]),
        "lsoa_poly_2021": spark.createDataFrame(
            [("L1", "POLYGON ((0 0, 1 1, 0 0))")], "lsoa21cd string, geometry string"),
    }
    built = build_tables(spark, inputs, str(tmp_path / "w"), Region("Region A"))
    assert [name for name, _ in built.views.failed] == ["ca_la_ghg_emissions_sub_sector_ods_vw"]
    assert built.views.views["epc_domestic_ods_vw"].count() == 1
    assert built.tables["postcodes"].where("pcds = 'P1'").first()["geom"]["y"] == 51.5
    assert built.tables["lsoa_poly_2021"].first()["geom"]["kind"] == "POLYGON"
    twice = {"tenure": tenure.union(tenure)}
    with pytest.raises(ValueError, match="Duplicate values for key"):
        build_tables(spark, twice, str(tmp_path / "w2"), Region("Region A"))
    with pytest.raises(ValueError, match="Unknown tables"):
        build_tables(spark, {"other": tenure}, str(tmp_path / "w3"), Region("Region A"))


def test_run_report_keeps_going_only_where_told():
    report = RunReport()
    report.run("a", "skip", lambda: 1 / 0)
    assert report.failed == [("a", "ZeroDivisionError: division by zero")]
    with pytest.raises(ZeroDivisionError):
        report.run("a", "fail", lambda: 1 / 0)
