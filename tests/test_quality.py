"""D1-D8 and R1-R3."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.operators.quality import (
    assert_unique, cast_to_schema, count_rows_of, distinct_by_key, distinct_rows, duplicate_keys,
    parse_date_if_text, require_columns, warn_if_empty,
)
from civicspark.operators.reshape import pivot_joint, pivot_unique, unpivot_not_null
from tests.conftest import rows_of


def test_d1_row_distinct(spark):
    df = spark.createDataFrame([("E1", -2.58), ("E1", -2.58), ("E2", None), ("E2", None)], "k string, x double")
    assert distinct_rows(df).count() == 2


def test_d2_survivor_does_not_depend_on_partitioning(spark):
    rows = [("a", i, f"v{i % 3}") for i in range(50)] + [(None, 1, "x"), (None, 0, "y")]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    for parts in (1, 5, 13):
        shuffled = df.repartition(parts, F.rand(parts))
        assert rows_of(distinct_by_key(shuffled, "k", [F.desc("n")])) == [("a", 49, "v1"), (None, 1, "x")]
        assert rows_of(distinct_by_key(shuffled, "k")) == [("a", 0, "v0"), (None, 0, "y")]


def test_d2_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    plan = distinct_by_key(df, "k", ["n"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_d4_lists_what_is_missing(spark):
    df = spark.createDataFrame([(1,)], "Year int")
    require_columns(df, ["year"])
    with pytest.raises(ValueError, match=r"\['code'\]"):
        require_columns(df, ["year", "code"])


def test_d5_null_keys_are_exempt(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    assert rows_of(duplicate_keys(df, "k")) == [("a", 2)]
    assert_unique(df.where("k IS NULL OR k = 'b'"), "k")
    with pytest.raises(ValueError, match="'a'"):
        assert_unique(df, "k")


def test_d6_lenient_cast(spark):
    df = spark.createDataFrame(
        [("1", "2.50", "2024-02-30"), ("x", "123456789.99", "2024-02-29")], "a string, b string, c string"
    )
    schema = T.StructType([
        T.StructField("c", T.DateType()), T.StructField("a", T.IntegerType()),
        T.StructField("b", T.DecimalType(10, 2)),
    ])
    typed = cast_to_schema(df, schema)
    assert typed.columns == ["c", "a", "b"]
    assert rows_of(typed) == [(None, 1, Decimal("2.50")), (date(2024, 2, 29), None, None)]


def test_d7_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-31", date(2020, 1, 1)), ("31/01/2024", None), ("", None), (None, None)], "t string, d date"
    )
    got = parse_date_if_text(df, "t", "d")
    assert dict(got.dtypes) == {"t": "date", "d": "date"}
    assert [r["t"] for r in got.collect()] == [date(2024, 1, 31), None, None, None]


def test_d8_count_rides_along(spark, traffic, caplog):
    observed, rows = count_rows_of(traffic.where("year = 1900"), "none")
    observed.write.format("noop").mode("overwrite").save()
    assert warn_if_empty(rows, "no rows left - check codes") == 0
    assert "no rows left" in caplog.text


LONG = [("L1", "owned", 5), ("L1", "rented", 2), ("L2", "owned", 7), ("L3", "rented", None)]


def test_r1_pivot(spark):
    df = spark.createDataFrame(LONG, "area string, tenure string, n bigint")
    want = [("L1", 5, 2), ("L2", 7, None), ("L3", None, None)]
    assert rows_of(pivot_unique(df, ["area"], "tenure", "n", ["owned", "rented"])) == want
    looked_up = pivot_unique(df, ["area"], "tenure", "n")
    assert looked_up.columns == ["area", "owned", "rented"]
    assert rows_of(looked_up) == want


def test_r1_cell_claimed_twice_is_an_error(spark):
    df = spark.createDataFrame([*LONG, ("L1", "owned", 5)], "area string, tenure string, n bigint")
    with pytest.raises(PySparkException, match="more than one value for label owned"):
        pivot_unique(df, ["area"], "tenure", "n", ["owned", "rented"]).collect()


def test_r2_joint_pivot_makes_only_pairs_that_occur(spark):
    rows = [("L1", "a", "Rank", 1.0), ("L1", "b", "Decile", 2.0), ("L2", "a", "Rank", 3.0)]
    df = spark.createDataFrame(rows, "area string, i string, m string, v double")
    wide = pivot_joint(df, ["area"], ["i", "m"], "v")
    assert wide.columns == ["area", '{"a","Rank"}', '{"b","Decile"}']
    given = pivot_joint(df, ["area"], ["i", "m"], "v", [("b", "Decile"), ("a", "Rank")])
    assert given.columns == ["area", '{"b","Decile"}', '{"a","Rank"}']
    assert rows_of(given) == [("L1", 2.0, 1.0), ("L2", None, 3.0)]


def test_r3_null_cells_give_no_row(spark):
    df = spark.createDataFrame([("a", 1, None, 2.5), ("b", None, None, None)], "k string, x int, y double, z double")
    long = unpivot_not_null(df, ["k"], "sector", "value", value_type="double")
    assert rows_of(long) == [("a", "x", 1.0), ("a", "z", 2.5)]
    with pytest.raises(ValueError, match="Missing required"):
        unpivot_not_null(df, ["k"], "sector", "value", ["x", "nope"])


def test_d5_digests_that_collide_are_told_apart(spark):
    rows = [("a", 1), ("b", 1), ("a", 1), ("c", 2), (None, 1), (None, 1), ("c", 3), ("", 0), ("", 0)]
    df = spark.createDataFrame(rows, "k string, n int")
    for digest in (F.xxhash64, lambda *c: F.lit(7)):  # the second gives every key the same digest
        assert rows_of(duplicate_keys(df, "k", digest=digest)) == [("", 2), ("a", 2), ("c", 2)]
        assert rows_of(duplicate_keys(df, "k", "n", digest=digest)) == [("", 0, 2), ("a", 1, 2)]
    assert rows_of(duplicate_keys(df, "n")) == [(0, 2), (1, 5)]
    assert duplicate_keys(df.limit(0), "k").collect() == []


def test_d5_whole_texts_are_not_shuffled(spark, tmp_path):
    spark.createDataFrame([(f"{i % 900} " + "long text " * 50,) for i in range(1000)], "t string").write.parquet(str(tmp_path / "t"))
    found = duplicate_keys(spark.read.parquet(str(tmp_path / "t")), "t")
    assert found.count() == 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The one side that is counted by digest, and the duplicates that are left.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_d2_without_an_order_nothing_is_sorted_by_the_rest(spark):
    rows = [("hot", i % 50, None if i % 7 else "x") for i in range(3000)] + [(None, 3, "b"), (None, None, "c"), ("k", 1, None)]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    found = distinct_by_key(df.repartition(8), "k")
    assert found.schema == df.schema
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_min" in plan.split("Exchange hashpartitioning")[-1]  # one row a key and task is shuffled
    want = [("hot", 0, None), ("k", 1, None), (None, None, "c")]
    for shuffled in (df, df.orderBy(F.rand(3)).repartition(5)):
        assert rows_of(distinct_by_key(shuffled, "k")) == sorted(want, key=repr)
    odd = df.withColumn("m", F.create_map(F.lit("a"), F.col("n")))
    assert rows_of(distinct_by_key(odd, "k").drop("m")) == sorted(want, key=repr)
