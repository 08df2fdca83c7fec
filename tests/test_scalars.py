"""C1-C15 and the filters F1-F9."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from civicspark.functions.geometry import first_point, make_point, number_text, parse_wkt, point_text
from civicspark.functions.scalars import (
    clean_tenure, concat_nulls_empty, construction_epoch, date_parts, half_up_int,
    nominal_construction_year, plain_number, point_label, require_certificate_type,
)
from civicspark.operators.filters import (
    Box, differs, equals, flag_matching, in_box, in_codes, in_codes_of_first_column, in_months,
    latest_period, not_null,
)
from tests.conftest import rows_of


@pytest.mark.parametrize("band, year, epoch", [
    ("England and Wales: 1983-1990", 1987, "1930 to present"),
    ("England and Wales: 2003-2006", 2005, "1930 to present"),
    ("1950 - 1966", 1950, "1930 to present"),
    ("England and Wales: before 1900", 1900, "1900 - 1930"),
    ("before 1899", 1899, "Before 1900"),
    ("England and Wales: 2012 onwards", 2012, "1930 to present"),
    ("1875", 1875, "Before 1900"),
    ("1930", 1930, "1900 - 1930"),
    ("NO DATA!", None, "Unknown"),
    ("", None, "Unknown"),
    (None, None, "Unknown"),
])
def test_c1_c2_age_band(spark, band, year, epoch):
    df = spark.createDataFrame([(band,)], "band string").withColumn(
        "year", nominal_construction_year("band")
    )
    got = df.select("year", construction_epoch("year")).first()
    assert tuple(got) == (year, epoch)


@pytest.mark.parametrize("text, want", [
    ("owner-occupied", "Owner occupied"), ("Owner-occupied", "Owner occupied"),
    ("Rented (social)", "Social rented"), ("rental (social)", "Social rented"),
    ("rental (private)", "Private rented"), ("Rented (private)", "Private rented"),
    ("Owner-Occupied", None), ("unknown", None), (None, None),
])
def test_c3_tenure(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean_tenure("t")).first()[0] == want


def test_c6_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(1986.5,), (1985.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(half_up_int(F.col("x"))).collect()] == [1987, 1986, -3]


def test_c7_date_parts(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 23, 59),), (None,)], "t timestamp")
    got = df.select(*[c.alias(n) for n, c in date_parts("t").items()])
    assert got.columns == ["LODGEMENT_DAY", "LODGEMENT_MONTH", "LODGEMENT_YEAR"]
    assert rows_of(got) == [(29, 2, 2024), (None, None, None)]


def test_c8_null_counts_as_empty(spark):
    df = spark.createDataFrame([(51.5, None), (None, None), (51.5, -2.25)], "lat double, long double")
    assert sorted(r[0] for r in df.select(point_label("lat", "long")).collect()) == [
        "{, }", "{51.5, -2.25}", "{51.5, }",
    ]
    assert df.select(concat_nulls_empty(F.lit(None), F.lit("a"))).first()[0] == "a"


def test_c8_numbers_in_plain_notation(spark):
    values = [1e-4, 1.2345678901234567e-4, 9.999e-4, 6.27e-5, 0.001, 12345678.75, 1e7, -3.3e15, 1.5e16, 9007199254740993.0, 1e22, 2.5e-310, 1e-9, 0.0, -0.5, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    # Python prints doubles by the same rule: the shortest digits, plain from 1e-4 to 1e16.
    want = [None if v is None else repr(v) for v in values]
    assert [r[0] for r in df.select(plain_number("v")).collect()] == want
    tiny = spark.createDataFrame([(6.27e-5,), (-1.5e-9,), (1e22,), (-2.5e17,), (3.0,)], "v double")
    assert [r[0] for r in tiny.select(number_text(F.col("v"))).collect()] == [
        "0.0000627", "-0.0000000015", "1" + "0" * 22, "-25" + "0" * 16, "3"]


def test_c9_c11_points(spark):
    df = spark.createDataFrame(
        [(1, -2.0, 51.4545), (2, 0.0, 1e-5), (3, None, 5.0), (4, -3.3089999999999997, 350000.0)],
        "id int, x double, y double",
    )
    got = {r["id"]: r["t"] for r in df.select("id", point_text(make_point("x", "y")).alias("t")).collect()}
    assert got == {
        1: "POINT (-2 51.4545)", 2: "POINT (0 0.00001)", 3: None,
        4: "POINT (-3.3089999999999997 350000)",
    }


@pytest.mark.parametrize("text, kind, parts", [
    ("POINT (-2.5 51.25)", "POINT", [[[(-2.5, 51.25)]]]),
    ("point(1 2)", "POINT", [[[(1.0, 2.0)]]]),
    ("POLYGON ((0 0, 4 0, 4 4, 0 0))", "POLYGON", [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]]]),
    ("POLYGON((0 0,4 0,0 0),(1 1,2 2,1 1))", "POLYGON",
     [[[(0.0, 0.0), (4.0, 0.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]]),
    ("MULTIPOLYGON (((0 0, 1 1)), ((2 2, 3 3), (4 4, 5 5)))", "MULTIPOLYGON",
     [[[(0.0, 0.0), (1.0, 1.0)]], [[(2.0, 2.0), (3.0, 3.0)], [(4.0, 4.0), (5.0, 5.0)]]]),
    ("LINESTRING (0 0, 1e2 -1.5E-3)", "LINESTRING", [[[(0.0, 0.0), (100.0, -0.0015)]]]),
    ("POINT Z (1 2 3)", "POINT Z", [[[(1.0, 2.0)]]]),
    ("POINT (.5 -.25)", "POINT", [[[(0.5, -0.25)]]]),
    ("POINT (+1. 002.)", "POINT", [[[(1.0, 2.0)]]]),
    ("MULTIPOINT (1 2, 3 4)", "MULTIPOINT", [[[(1.0, 2.0), (3.0, 4.0)]]]),
    ("MULTIPOINT ((1 2), (3 4))", "MULTIPOINT", [[[(1.0, 2.0), (3.0, 4.0)]]]),
    ("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "MULTILINESTRING",
     [[[(0.0, 0.0), (1.0, 1.0)], [(2.0, 2.0), (3.0, 3.0)]]]),
    ("POINT EMPTY", "POINT", []),
    ("multipolygon z empty", "MULTIPOLYGON Z", []),
    ("GEOMETRYCOLLECTION (POINT (1 2), POINT EMPTY, POLYGON ((0 0, 1 1, 0 0)))", "GEOMETRYCOLLECTION",
     [[[(1.0, 2.0)]], [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]]),
    ("GEOMETRYCOLLECTION EMPTY", "GEOMETRYCOLLECTION", []),
    ("GEOMETRYCOLLECTION (GEOMETRYCOLLECTION (POINT (1 2), MULTIPOLYGON (((0 0, 1 1)), ((2 2, 3 3)))), POINT (5 6))",
     "GEOMETRYCOLLECTION", [[[(1.0, 2.0)]], [[(0.0, 0.0), (1.0, 1.0)]], [[(2.0, 2.0), (3.0, 3.0)]], [[(5.0, 6.0)]]]),
    ("GEOMETRYCOLLECTION (MULTIPOINT ((1 2), (3 4)), GEOMETRYCOLLECTION EMPTY)", "GEOMETRYCOLLECTION", [[[(1.0, 2.0), (3.0, 4.0)]]]),
    ("GEOMETRYCOLLECTION (POINT EMPTY)", "GEOMETRYCOLLECTION", []),
    ("POLYGONZM ((0 0 1 1,\n\t4 0 1 1), (1 1 0 0))", "POLYGONZM", [[[(0.0, 0.0), (4.0, 0.0)], [(1.0, 1.0)]]]),
    ("multilinestring m ((0 0 1), (2 2 1))", "MULTILINESTRING M", [[[(0.0, 0.0)], [(2.0, 2.0)]]]),
])
def test_c10_wkt(spark, text, kind, parts):
    geom = spark.createDataFrame([(text,)], "t string").select(parse_wkt("t").alias("g")).first()["g"]
    assert geom["kind"] == kind
    assert [[[tuple(p) for p in ring] for ring in polygon] for polygon in geom["parts"]] == parts


def test_c10_text_that_is_no_geometry(spark):
    df = spark.createDataFrame([(None,), ("",), ("no geometry",), ("POINT 1 2)",), ("EMPTY POINT",)], "t string")
    assert [r[0] for r in df.select(parse_wkt("t")).collect()] == [None] * 5
    assert df.select(first_point(parse_wkt("t"))).first()[0] is None


@pytest.mark.parametrize("text", [
    "POINT (1)", "POINT (1 x)", "POINT (1 2", "POINT (1 2))", "POLYGON (0 0, 1 1)", "POINT ((1 2))",
    "LINESTRING (1 2,, 3 4)", "LINESTRING (1 2,)", "LINESTRING ()", "POLYGON ((0 0, 1 1) (2 2, 3 3))", "POINT (1 2) (3 4)",
    "MULTIPOLYGON ((0 0, 1 1))", "POINT (1 2), POINT (3 4)", "(1 2)", "POINT (1-2 3)", "POINT (nan 2)", "POINT (1 2) EMPTY",
])
def test_c10_malformed_text_has_null_parts(spark, text):
    geom = spark.createDataFrame([(text,)], "t string").select(parse_wkt("t").alias("g")).first()["g"]
    assert geom["parts"] is None


def test_c10_texts_of_a_batch_do_not_meet(spark):
    texts = ["POINT (1 2)", "1 2", None, "POINT (3", "4 5)", "", "POLYGON ((0 0, 1 1), (2 2, 3 3))", "x", "POINT EMPTY", "POINT (6 7)"] * 40
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(parse_wkt("t")).collect()]
    alone = [spark.createDataFrame([(t,)], "t string").select(parse_wkt("t")).first()[0] for t in texts[:10]]
    assert got == alone * 40
    long = "MULTIPOLYGON (" + ", ".join(f"(({i} 0, 1 {i}), (2 2, 3 3))" for i in range(20000)) + ")"
    parts = spark.createDataFrame([(long,)], "t string").select(parse_wkt("t").alias("g")).first()["g"]["parts"]
    assert len(parts) == 20000 and [tuple(p) for p in parts[-1][0]] == [(19999.0, 0.0), (1.0, 19999.0)]
    assert spark.createDataFrame([], "t string").select(parse_wkt("t")).collect() == []


def test_c14_certificate_type():
    assert require_certificate_type("non-domestic") == "non-domestic"
    with pytest.raises(ValueError, match="Invalid cert_type"):
        require_certificate_type("industrial")


def test_f1_f2_null_is_neither_equal_nor_different(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows_of(equals(df, "v", "a")) == [("a",)]
    assert rows_of(differs(df, "v", "a")) == [("b",)]
    assert rows_of(not_null(df, "v")) == [("a",), ("b",)]


def test_f3_box_includes_its_edges(spark):
    box = Box()
    rows = [
        (1, box.west, 51.5), (2, box.east, 51.5), (3, -2.5, box.south), (4, -2.5, box.north),
        (5, box.west - 1e-9, 51.5), (6, -2.5, box.north + 1e-9), (7, None, 51.5), (8, -2.5, None),
    ]
    df = spark.createDataFrame(rows, "id int, long double, lat double")
    assert [r[0] for r in rows_of(in_box(df).select("id"))] == [1, 2, 3, 4]


def test_f4_codes_as_list_and_as_frame(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "code string")
    codes = spark.createDataFrame([("b",), ("b",), ("z",)], "ladcd string")
    assert rows_of(in_codes(df, "code", ["b", "z"])) == [("b",), ("b",)]
    assert rows_of(in_codes(df, "code", codes)) == [("b",), ("b",)]
    assert rows_of(in_codes(df, "code", [])) == []


def test_f5_latest_period_of_the_whole_input(traffic):
    latest = latest_period(traffic, "year")
    assert {r["year"] for r in latest.collect()} == {2023}
    with pytest.raises(ValueError, match="Missing required"):
        latest_period(traffic, "no_such_year")


def test_f7_first_matching_column(emissions, caplog):
    found = in_codes_of_first_column(emissions, ["ladcd", "LA Code"], ["E06000023"])
    assert found.count() == 1
    passed = in_codes_of_first_column(emissions, ["nothing"], ["E06000023"])
    assert passed.count() == 4
    assert "Code column not found" in caplog.text


def test_f8_pattern_is_a_partial_match(spark):
    df = spark.createDataFrame([("waste_total",), ("lulucf_net_emissions",), ("total_gas",)], "s string")
    assert rows_of(flag_matching(df, "s", "_total$|lulucf_net_emissions", "total_bool")) == [
        ("lulucf_net_emissions", True), ("total_gas", False), ("waste_total", True),
    ]


def test_f9_month_range(spark):
    days = [date(2023, 10, 31), date(2023, 11, 1), date(2024, 1, 31), date(2024, 2, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert rows_of(in_months(df, "d", (2023, 11), (2024, 1))) == [
        (date(2023, 11, 1),), (date(2024, 1, 31),),
    ]
