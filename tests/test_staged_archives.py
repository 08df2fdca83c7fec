"""Archives staged as Parquet: what is opened when, and what a read returns."""

import os

import pytest
from pyspark.errors import PySparkException

from civicspark.sources.archives import only_csv_under_data, read_staged_csv, read_zipped_csv
from tests.conftest import rows_of
from tests.test_files import put_zip, small

SCHEMA = ("LMK_KEY", "CURRENT_ENERGY_EFFICIENCY")


def land(folder, name, text, member="certificates.csv"):
    put_zip(folder / name, {member: text})


@pytest.fixture
def places(tmp_path):
    land(tmp_path / "z", "E01.zip", "CURRENT_ENERGY_EFFICIENCY,LMK_KEY\n70,k1\n,k2\n")
    land(tmp_path / "z", "E02.zip", "nothing", "readme.txt")
    land(tmp_path / "z", "E03.zip", "LMK_KEY,CURRENT_ENERGY_EFFICIENCY\nk3,5\n")
    return tmp_path / "z", str(tmp_path / "stage")


def read(spark, places, **more):
    return read_staged_csv(spark, str(places[0]), places[1], small(*SCHEMA), **more)


FIRST = [("E01", "k1", 70), ("E01", "k2", None), ("E03", "k3", 5)]


def test_second_read_opens_no_archive(spark, places):
    got = read(spark, places)
    assert rows_of(got) == FIRST == rows_of(read_zipped_csv(spark, str(places[0]), small(*SCHEMA), strict=True))
    assert got.schema["CURRENT_ENERGY_EFFICIENCY"].dataType.simpleString() == "int"
    for path in places[0].glob("*.zip"):  # as long and as old as before, but no archive any more
        stat = path.stat()
        path.write_bytes(b"x" * stat.st_size)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert rows_of(read(spark, places)) == FIRST


def test_new_and_replaced_archives_are_read(spark, places):
    read(spark, places)
    land(places[0], "E01.zip", "LMK_KEY,CURRENT_ENERGY_EFFICIENCY\nk9,9\n")
    os.utime(places[0] / "E01.zip", (2e9, 2e9))
    land(places[0], "E04.zip", "LMK_KEY,CURRENT_ENERGY_EFFICIENCY\nk4,4\n")
    (places[0] / "E03.zip").unlink()
    assert rows_of(read(spark, places)) == [("E01", "k9", 9), ("E04", "k4", 4)]


def test_a_run_that_died_before_the_list_is_repeated(spark, places, tmp_path):
    read(spark, places)
    for file in (tmp_path / "stage/archives").glob("*"):
        file.unlink()
    (tmp_path / "stage/archives").rmdir()
    assert rows_of(read(spark, places)) == FIRST


def test_strict_unless_told_and_named_by_archive(spark, tmp_path):
    places = tmp_path / "z", str(tmp_path / "stage")
    land(places[0], "E01.zip", "LMK_KEY,CURRENT_ENERGY_EFFICIENCY\nk1,bad\n")
    with pytest.raises(PySparkException, match="CURRENT_ENERGY_EFFICIENCY is no int: bad"):
        read(spark, places).collect()
    assert rows_of(read(spark, places, strict=False)) == [("E01", "k1", None)]
    land(places[0], "E07.zip", 'LMK_KEY,CURRENT_ENERGY_EFFICIENCY\n"' + "x" * 5000 + '",1\n')
    with pytest.raises(PySparkException, match="certificates.csv of .*E07.zip"):
        read(spark, places, block_bytes=1000)
    assert len(rows_of(read(spark, places, strict=False))) == 2


def test_other_members_and_nothing_landed(spark, tmp_path):
    land(tmp_path / "d", "onspd.zip", "LMK_KEY\nk1\n", "Data/postcodes.csv")
    got = read_staged_csv(spark, str(tmp_path / "d"), str(tmp_path / "s"), small("LMK_KEY"), only_csv_under_data)
    assert rows_of(got) == [("onspd", "k1")]
    land(tmp_path / "e", "E02.zip", "nothing", "readme.txt")
    assert read_staged_csv(spark, str(tmp_path / "e"), str(tmp_path / "s2"), small("LMK_KEY")).collect() == []
    assert read_staged_csv(spark, str(tmp_path / "e"), str(tmp_path / "s2"), small("LMK_KEY")).collect() == []
