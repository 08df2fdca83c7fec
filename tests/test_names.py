"""P7-P13."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from civicspark.functions.names import (
    apply_names, clean_column_name, clean_names, get_rename_dict, hyphen_lower, number_duplicates,
    remove_numbers, snake_name, space_underscore, upper_underscore,
)
from civicspark.operators.reshape import indicator_name, joint_label


@pytest.mark.parametrize("name, want", [
    ("LSOA21CD", "lsoacd"), ("TEST123XYZ", "testxyz"), ("UPPERCASE", "uppercase"),
    ("MixedCase123", "mixedcase"), ("hello", "hello"), ("12345", ""), ("", ""),
])
def test_p8_remove_numbers(name, want):
    assert remove_numbers(name) == want


@pytest.mark.parametrize("name, want", [
    ('"{lsoa,feature}"', "oafeature"), ('"{test,value}"', "stvalue"), ("lsoa21cd", "lsoa21cd"),
    ("lsoa_code", "lsoa_code"), ('"test"', "st"), ("{test}", "st"),
])
def test_p11_clean_column_name(name, want):
    assert clean_column_name(name) == want


@pytest.mark.parametrize("name, strip, want", [
    ("LA GHG Sector", False, "la_ghg_sector"), ("CO2 emissions (kt)", True, "co2_emissions_kt"),
    ("CO2 emissions (kt)", False, "co2_emissions_kt_"), ("Owner's share", False, "owners_share"),
    ("a--b / c", False, "a_b_c"), ("_lead_", True, "lead"),
])
def test_p12_snake_name(name, strip, want):
    assert snake_name(name, strip) == want


def test_p9_last_duplicate_stays_bare():
    assert number_duplicates(["col", "col", "col"]) == ["col_1", "col_2", "col"]
    assert number_duplicates(["a", "a", "a_1"]) == ["a_1", "a", "a_1_1"]


@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=9))
def test_p9_numbers_count_up_to_the_bare_last(names):
    for name in set(names):
        mine = [new for old, new in zip(names, number_duplicates(names)) if old == name]
        assert mine == [f"{name}_{n}" for n in range(1, len(mine))] + [name]


def test_p9_rename_dict(spark):
    df = spark.createDataFrame([(1, 2)], "LSOA21CD int, LSOA21NM int")
    assert get_rename_dict(df) == {"LSOA21CD": "lsoa21cd", "LSOA21NM": "lsoa21nm"}
    assert get_rename_dict(df, rm_numbers=True) == {"LSOA21CD": "lsoacd", "LSOA21NM": "lsoanm"}


def test_p10_p13_spellings():
    assert upper_underscore("lmk-key") == "LMK_KEY"
    assert hyphen_lower("LMK_KEY") == "lmk-key"
    assert space_underscore("Indices of Deprivation") == "indices_of_deprivation"


def test_t20_joint_label_to_published_name():
    label = joint_label("a. Index of Multiple Deprivation (IMD)", "Rank")
    assert label == '{"a. Index of Multiple Deprivation (IMD)","Rank"}'
    assert indicator_name(label) == "index_of_multiple_deprivation_imd_rank"
    assert indicator_name(joint_label("a. Index of Multiple Deprivation (IMD)", "Decile ")) == (
        "index_of_multiple_deprivation_imd_decile"
    )


def test_p7_names_that_end_up_alike_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "LSOA11CD int, LSOA21CD int")
    with pytest.raises(ValueError, match="Duplicate column names"):
        apply_names(df, remove_numbers)
    assert clean_names(df).columns == ["lsoa11cd", "lsoa21cd"]
