"""S1-S18 and K1-K6 on small files."""

import json
import zipfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from civicspark.schemas import (
    DOMESTIC_CERTIFICATES, NON_DOMESTIC_CERTIFICATES, POSTCODES, certificate_schema, page_schema,
)
from civicspark.sources.archives import (
    archive_members, arrow_uri, only_csv_under_data, read_zipped_csv,
)
from civicspark.sources.files import (
    infer_csv_schema, read_certificate_pages, read_csv, read_csv_inferred, read_csv_lenient,
    read_features, read_geojson, read_landed_csv, read_postcodes,
)
from civicspark.sources.sinks import (
    export_csv, export_tables, read_codes, replace_table, upsert_by_key, write_codes,
)
from tests.conftest import rows_of

SCHEMA = "A string, B int, C date"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_schemas_are_complete():
    assert len(DOMESTIC_CERTIFICATES) == 93 and len(NON_DOMESTIC_CERTIFICATES) == 41
    assert len(POSTCODES) == 53
    assert DOMESTIC_CERTIFICATES["UPRN"].dataType.simpleString() == "string"
    assert NON_DOMESTIC_CERTIFICATES["UPRN"].dataType.simpleString() == "bigint"
    assert DOMESTIC_CERTIFICATES["TOTAL_FLOOR_AREA"].dataType.simpleString() == "decimal(10,2)"
    assert page_schema("domestic").fieldNames()[0] == "lmk-key"
    with pytest.raises(ValueError):
        certificate_schema("other")


def test_s1_quotes_line_breaks_and_empty_fields(spark, tmp_path):
    put(tmp_path / "in/a.csv", 'A,B,C\n"say ""hi""\nthere","1","2020-01-31"\n"","",""\n')
    put(tmp_path / "in/b.csv", "A,B,C\n")
    assert rows_of(read_csv(spark, str(tmp_path / "in/*.csv"), SCHEMA)) == [
        ('say "hi"\nthere', 1, date(2020, 1, 31)), (None, None, None),
    ]


def test_s1_header_in_another_order_fails(spark, tmp_path):
    put(tmp_path / "in/a.csv", "B,A,C\n1,x,2020-01-31\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path / "in"), SCHEMA).collect()


def test_s2_overridden_codes_keep_their_zeros(spark, tmp_path):
    put(tmp_path / "in/a.csv", "pcds,ruc11ind,north1m,lat\nAB1 1AA,01,12,51.5\nAB1 1AB,02,13,\n")
    df = read_postcodes(spark, str(tmp_path / "in"))
    assert df.dtypes == [("pcds", "string"), ("ruc11ind", "string"), ("north1m", "bigint"), ("lat", "double")]
    assert rows_of(df) == [("AB1 1AA", "01", 12, 51.5), ("AB1 1AB", "02", 13, None)]
    inferred = infer_csv_schema(spark, str(tmp_path / "in"))
    assert inferred["ruc11ind"].dataType.simpleString() == "int"
    assert rows_of(read_csv_inferred(spark, str(tmp_path / "in")))[0][1] == 1


def test_s4_bad_cell_is_null_and_row_stays(spark, tmp_path):
    put(tmp_path / "in/a.csv", "A,B,C\nx,bad,2020-99-99\ny,2,2020-01-02\n")
    assert rows_of(read_csv_lenient(spark, str(tmp_path / "in"), SCHEMA)) == [
        ("x", None, None), ("y", 2, date(2020, 1, 2)),
    ]


def test_s11_row_limit(spark, tmp_path):
    put(tmp_path / "in/a.csv", "x\n" + "\n".join(str(i) for i in range(50)) + "\n")
    assert read_landed_csv(spark, str(tmp_path / "in"), 10).count() == 10
    assert read_landed_csv(spark, str(tmp_path / "in")).count() == 50


def page_of(rows):
    """One landed page: header and rows with key, authority and lodgement date."""
    names = page_schema("domestic").fieldNames()
    values = {"lmk-key": 0, "local-authority": 1, "lodgement-date": 2, "total-floor-area": 3}
    lines = [",".join(names)]
    for row in rows:
        lines.append(",".join(f'"{row[values[n]]}"' if n in values else '""' for n in names))
    return "\n".join(lines) + "\n"


def test_s5_s14_every_row_of_every_page(spark, tmp_path):
    put(tmp_path / "p/1.csv", page_of([("k1", "A1", "2024-01-31", "10.50"), ("k2", "A1", "2024-02-01", "2.00")]))
    put(tmp_path / "p/2.csv", page_of([("k3", "A2", "2024-02-10", "1"), ("k4", "A1", "2024-03-01", "1")]))
    put(tmp_path / "p/3.csv", page_of([]))
    path = str(tmp_path / "p")
    pages = read_certificate_pages(spark, path)
    assert pages.count() == 4 and len(pages.columns) == 93
    assert {r["lmk-key"]: r["total-floor-area"] for r in pages.collect()}["k1"] == Decimal("10.50")

    def keys(**kwargs):
        return [r[0] for r in rows_of(read_certificate_pages(spark, path, **kwargs).select("`lmk-key`"))]

    assert keys(local_authority="A1") == ["k1", "k2", "k4"]
    assert keys(from_period=(2024, 2), to_period=(2024, 2)) == ["k2", "k3"]
    assert keys(local_authority=["A1", "A2"], from_period=(2024, 2), to_period=(2024, 3)) == ["k2", "k3", "k4"]


def test_s5_bad_cell_and_missing_path(spark, tmp_path):
    good, bad = str(tmp_path / "good.csv"), str(tmp_path / "bad.csv")
    put(tmp_path / "good.csv", page_of([("k1", "A1", "2024-01-31", "10.50")]))
    put(tmp_path / "bad.csv", page_of([("k2", "A1", "2024-02-01", "n/a")]))
    for multi_line in (True, False):
        pages = read_certificate_pages(spark, [good, str(tmp_path / "none.csv")], multi_line=multi_line)
        assert [r["lmk-key"] for r in pages.collect()] == ["k1"]
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
            read_certificate_pages(spark, [good, bad], multi_line=multi_line).collect()


@pytest.mark.parametrize("line", ["1,xx,a", "2,3,b,extra", "3,4"])
def test_s1_lines_that_do_not_fit_fail(spark, tmp_path, line):
    put(tmp_path / "t.csv", f"k,n,t\n0,1,z\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path / "t.csv"), "k int, n int, t string").collect()


def test_s14_nothing_landed_and_bad_type(spark, tmp_path):
    empty = read_certificate_pages(spark, str(tmp_path / "none"), "non-domestic")
    assert empty.count() == 0 and len(empty.columns) == 41
    with pytest.raises(ValueError, match="Invalid cert_type"):
        read_certificate_pages(spark, str(tmp_path), "other")


def test_s7_s8_feature_pages(spark, tmp_path):
    def feature(code, **geometry):
        out = {"attributes": {"LSOA21CD": code, "GlobalID": "g"}}
        return {**out, "geometry": geometry} if geometry else out

    for i, codes in enumerate((["E1", "E2"], ["E3"], [])):
        put(tmp_path / f"xy/{i}.json", json.dumps({"features": [feature(c, x=1.5, y=51.0) for c in codes]}, indent=1))
        put(tmp_path / f"flat/{i}.json", json.dumps({"features": [feature(c) for c in codes]}))
    placed = read_features(spark, str(tmp_path / "xy"))
    assert placed.columns == ["LSOA21CD", "x", "y"]
    assert rows_of(placed) == [("E1", 1.5, 51.0), ("E2", 1.5, 51.0), ("E3", 1.5, 51.0)]
    assert rows_of(read_features(spark, str(tmp_path / "flat"), with_geometry=False)) == [("E1",), ("E2",), ("E3",)]


def test_s10_geojson(spark, tmp_path):
    shape = {"type": "Polygon", "coordinates": [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]}
    put(tmp_path / "b/1.geojson", json.dumps({
        "type": "FeatureCollection",
        "features": [{"type": "Feature", "properties": {"CAUTH25CD": "E47"}, "geometry": shape}],
    }, indent=2))
    assert rows_of(read_geojson(spark, str(tmp_path / "b"))) == [("E47", "Polygon", shape["coordinates"])]


def put_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)


ZIP_SCHEMA = certificate_schema("domestic")


def small(*names):
    from pyspark.sql import types as T

    return T.StructType([ZIP_SCHEMA[n] for n in names])


def test_s15_zip_members(spark, tmp_path):
    put_zip(tmp_path / "z/E01.zip", {
        "certificates.csv": 'POSTCODE,LMK_KEY,CURRENT_ENERGY_EFFICIENCY\n"AB1 ""x""\n1AA",k1,70\n,k2,bad\n',
        "recommendations.csv": "x\n1\n",
    })
    put_zip(tmp_path / "z/E02.zip", {"certificates.csv": "LMK_KEY,POSTCODE,CURRENT_ENERGY_EFFICIENCY\nk3,P,1\n"})
    put_zip(tmp_path / "z/E03.zip", {"readme.txt": "nothing"})
    put_zip(tmp_path / "z/E04.zip", {"certificates.csv": ""})
    schema = small("LMK_KEY", "POSTCODE", "CURRENT_ENERGY_EFFICIENCY")
    got = read_zipped_csv(spark, str(tmp_path / "z"), schema, batch_rows=1, partitions=2)
    assert got.schema["CURRENT_ENERGY_EFFICIENCY"].dataType.simpleString() == "int"
    assert rows_of(got) == [
        ("E01", "k1", 'AB1 "x"\n1AA', 70), ("E01", "k2", None, None), ("E02", "k3", "P", 1),
    ]


@pytest.mark.parametrize("members", [
    {"certificates.csv": "LMK_KEY\nk1\n"},
    {"certificates.csv": "LMK_KEY,POSTCODE\nk1\n"},
])
def test_s15_missing_column_or_ragged_line_fails(spark, tmp_path, members):
    put_zip(tmp_path / "z/E01.zip", members)
    with pytest.raises(PySparkException):
        read_zipped_csv(spark, str(tmp_path / "z"), small("LMK_KEY", "POSTCODE")).collect()


def test_s15_corrupt_archive_fails(spark, tmp_path):
    put(tmp_path / "z/E01.zip", "not a zip")
    with pytest.raises(PySparkException, match="BadZipFile"):
        read_zipped_csv(spark, str(tmp_path / "z"), small("LMK_KEY")).collect()


def test_s16_single_csv_directly_under_data(spark, tmp_path):
    put_zip(tmp_path / "z/onspd.zip", {
        "Data/postcodes.csv": "LMK_KEY\nk1\n", "Data/multi/part.csv": "x\n", "Docs/notes.csv": "x\n",
    })
    got = read_zipped_csv(spark, str(tmp_path / "z"), small("LMK_KEY"), only_csv_under_data)
    assert rows_of(got) == [("onspd", "k1")]
    with pytest.raises(FileNotFoundError):
        only_csv_under_data(["Data/sub/a.csv"])
    with pytest.raises(ValueError, match="Multiple"):
        only_csv_under_data(["Data/a.csv", "Data/b.csv"])


def test_k1_replaces_and_k3_k4_k6(spark, tmp_path, lookup):
    path = str(tmp_path / "t")
    replace_table(lookup, path)
    assert rows_of(replace_table(lookup.limit(1), path)) == rows_of(lookup.limit(1))
    blanks = spark.createDataFrame([(" a ", 'q"uote', "two\nlines"), (None, "x", "y")], "a string, b string, c string")
    export_csv(blanks, str(tmp_path / "csv"))
    assert rows_of(read_csv(spark, str(tmp_path / "csv"), blanks.schema)) == rows_of(blanks)
    paths = export_tables({"l": lookup}, str(tmp_path / "all"))
    assert spark.read.parquet(paths["l"]).count() == 3
    write_codes(lookup, "ladcd", str(tmp_path / "codes"))
    assert rows_of(read_codes(spark, str(tmp_path / "codes"), "ladcd")) == rows_of(lookup.select("ladcd"))


def test_k5_upsert(spark):
    base = spark.createDataFrame(
        [("k1", "old", 1), ("k2", "old", 1), (None, "keyless", 1)], "LMK_KEY string, v string, lodged int"
    )
    updates = spark.createDataFrame(
        [(5, "first", "k2"), (6, "last", "k2"), (2, "new", "k3"), (3, "keyless too", None), (4, "keyless three", None)],
        "lodged int, v string, LMK_KEY string",
    )
    want = [
        ("k1", "old", 1), ("k2", "last", 6), ("k3", "new", 2), (None, "keyless three", 4),
        (None, "keyless too", 3), (None, "keyless", 1),
    ]
    merged = upsert_by_key(base, updates, "LMK_KEY", ["lodged"])
    assert merged.columns == base.columns
    assert rows_of(merged) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="Missing required"):
        upsert_by_key(base, updates.drop("v"), "LMK_KEY", ["lodged"])


def test_s15_fields_of_any_length_strict_types_and_skipped_archives(spark, tmp_path):
    long = "x" * 1_200_000
    put_zip(tmp_path / "z/E01.zip", {"certificates.csv": f'LMK_KEY,POSTCODE\n"{long}",P\n'})
    put_zip(tmp_path / "z/E02.zip", {"readme.txt": "nothing"})
    got = read_zipped_csv(spark, str(tmp_path / "z"), small("LMK_KEY", "POSTCODE"), strict=True)
    assert rows_of(got) == [("E01", long, "P")]
    listed = archive_members(spark, str(tmp_path / "z"))
    assert sorted((r.path.rsplit("/", 1)[1], r.member) for r in listed.collect()) == [
        ("E01.zip", "certificates.csv"), ("E02.zip", None),
    ]
    put_zip(tmp_path / "y/E01.zip", {"certificates.csv": "LMK_KEY,CURRENT_ENERGY_EFFICIENCY\nk1,bad\n"})
    schema = small("LMK_KEY", "CURRENT_ENERGY_EFFICIENCY")
    assert rows_of(read_zipped_csv(spark, str(tmp_path / "y"), schema)) == [("E01", "k1", None)]
    with pytest.raises(PySparkException, match="CURRENT_ENERGY_EFFICIENCY is no int: bad"):
        read_zipped_csv(spark, str(tmp_path / "y"), schema, strict=True).collect()


def test_s15_stores_are_named_as_arrow_names_them():
    assert arrow_uri("file:/a/b.zip") == "file:///a/b.zip"
    assert arrow_uri("s3a://bucket/a.zip") == "s3://bucket/a.zip"
    assert arrow_uri("hdfs://host:8020/a.zip") == "hdfs://host:8020/a.zip"
