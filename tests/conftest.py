"""One Spark session for all tests, and small literal frames."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from civicspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "civicspark-tests", "local[4]", 4,
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            # Short plans, run once each: the quick compiler is enough.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


# Codes, ids, years, deciles and names of the columns, as FIXTURES.md lists them.
LA_CODES = ("E06000023", "E06000024", "E06000025")
DFT_IDS = (801, 802, 803)
LSOA_CODES = ("E01014533", "E01014534", "E01014535", "E01014536")
DECILES = (5, 6, 4, 8)
# Everything below is made up.


@pytest.fixture
def traffic(spark):
    rows = [
        (dft_id, code, f"Place {dft_id}", year, 7 * dft_id, "NW", year + dft_id)
        for year in (2022, 2023) for dft_id, code in zip(DFT_IDS, LA_CODES, strict=True)
    ]
    return spark.createDataFrame(rows, (
        "local_authority_id bigint, local_authority_code string, local_authority_name string, "
        "year bigint, count_point_id bigint, direction_of_travel string, all_motor_vehicles bigint"
    ))


@pytest.fixture
def emissions(spark):
    rows = [(code, f"Place {code}", 2019, 0.5 * n, "all") for n, code in enumerate((*LA_CODES, "E06000099"))]
    return spark.createDataFrame(
        rows, "`LA Code` string, `Local Authority` string, Year bigint, CO2_kt double, Sector string"
    )


@pytest.fixture
def deprivation(spark):
    rows = [
        (code, f"Area {n}", 0.25 * n, 11 * n + 1, decile)
        for n, (code, decile) in enumerate(zip(LSOA_CODES, DECILES, strict=True))
    ]
    return spark.createDataFrame(
        rows, "lsoa21_code string, lsoa21_name string, imd_score double, imd_rank bigint, imd_decile bigint"
    )


@pytest.fixture
def raw_lookup(spark):
    rows = [
        (1, "E06000023", "One, City of", "E47000009", "Region A"),
        (2, "E06000025", "St. Three", "E47000009", "Region A"),
        (3, "E06000022", "Five", "E47000010", "Region B"),
    ]
    return spark.createDataFrame(
        rows, "ObjectId bigint, LADCD21 string, LADNM21 string, CAUTHCD21 string, CAUTHNM21 string"
    )


@pytest.fixture
def lookup(spark):
    rows = [
        ("E06000023", "One", "C1", "Region A"), ("E06000025", "Three", "C1", "Region A"),
        ("E06000022", "Five", "C2", "Region B"),
    ]
    return spark.createDataFrame(rows, "ladcd string, ladnm string, cauthcd string, cauthnm string")


@pytest.fixture
def raw_centroids(spark):
    places = ((-2.5879, 51.125), (0.5, 50.25), (1.75, 52.0))  # the first longitude is looked for
    rows = [
        (code, f"Area {n}", x, y, f"POINT ({x} {y})")
        for n, (code, (x, y)) in enumerate(zip(LSOA_CODES, places, strict=False))
    ]
    return spark.createDataFrame(rows, "LSOA21CD string, LSOA21NM string, X double, Y double, GEOMETRY string")


def rows_of(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
