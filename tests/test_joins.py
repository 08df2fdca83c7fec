"""Results, and plan shapes where they matter."""

import random

import pytest
from pyspark.sql import functions as F

from civicspark.operators.aggregates import ratio_of_sums
from civicspark.operators.chunks import chunk_codes, chunk_filters, number_in_order
from civicspark.operators.columns import (
    add_chained, add_columns, drop_if_present, drop_strict, join_side_by_side, rename_strict,
    select_by_regex, select_layout, unnest,
)
from civicspark.operators.joins import (
    enrich, enrich_dimension, latest_per_key, lookup_join, semi_join_codes,
)
from civicspark.operators.reshape import pivot_unique
from civicspark.operators.sets import append_rows, first_rows, first_rows_by, table_counts, union_all
from tests.conftest import rows_of


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables beyond the broadcast threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


CERTIFICATES = [
    ("k1", "u1", 1, "A"), ("k2", "u1", 5, "B"), ("k3", "u1", 5, "A"),
    ("k4", "u2", 3, "A"), ("k5", None, 9, "A"), ("k6", "u3", None, "A"),
    ("k7", "u4", 2, "A"), ("k8", "u4", 1, "A"),
]


@pytest.fixture
def certificates(spark):
    return spark.createDataFrame(CERTIFICATES, "lmk string, uprn string, lodged int, la string")


def test_j3_ties_stay_and_nulls_vanish(certificates):
    latest = latest_per_key(certificates, "uprn", "lodged")
    assert [r[0] for r in rows_of(latest)] == ["k2", "k3", "k4", "k7"]
    assert latest.columns == certificates.columns


def test_j3_filters_apply_after_the_choice(certificates):
    """u1's older certificate under another authority must not come back."""
    latest = latest_per_key(certificates, "uprn", "lodged").where("la = 'A'")
    assert [r[0] for r in rows_of(latest)] == ["k3", "k4", "k7"]


def test_j3_against_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (i, rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.choice([None, *range(6)]))
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "id int, k string, ts int")
    best = {}
    for _, k, ts in rows:
        if k is not None and ts is not None:
            best[k] = max(best.get(k, ts), ts)
    want = sorted((r for r in rows if r[1] in best and r[2] == best[r[1]]), key=repr)
    assert rows_of(latest_per_key(df, "k", "ts")) == want


def test_j3_spreads_a_hot_key_over_its_stamps(certificates, no_broadcast):
    """Rows are shuffled once, on (key, stamp); the maximum is combined before its shuffle."""
    plan = plan_of(latest_per_key(certificates, "uprn", "lodged"))
    assert "Window" not in plan
    assert "partial_max" in plan
    assert plan.count("Exchange hashpartitioning(uprn") == 2
    row_side = plan.split("Exchange hashpartitioning(uprn")[1]
    assert "lodged" in row_side.split("ENSURE_REQUIREMENTS")[0]


def test_j3_region_filter_reaches_the_rows_not_the_maximum(spark, certificates, tmp_path, no_broadcast):
    certificates.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    plan = latest_per_key(stored, "uprn", "lodged").where("la = 'A'")
    text = plan_of(plan)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert sum("EqualTo(la,A)" in line for line in scans) == 1
    assert any("ReadSchema: struct<uprn:string,lodged:int>" in line for line in scans)


def test_j3_hot_key_and_stamp_is_split(spark, no_broadcast):
    """A third of all rows tie at one key's latest stamp; the join splits them over tasks."""
    hot = spark.range(40000).selectExpr("id", "'hot' AS k", "9 AS ts")
    cold = spark.range(80000).selectExpr("id", "'k' || id % 5000 AS k", "cast(id % 7 AS int) AS ts")
    df = hot.union(cold).withColumn("payload", F.md5(F.col("id").cast("string")))
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        latest = latest_per_key(df, "k", "ts")
        rows = latest.collect()
        plan = latest._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan
    assert sum(r["k"] == "hot" for r in rows) == 40000


def test_j1_small_lookup_is_broadcast_large_one_is_not(spark, certificates, lookup, tmp_path):
    lookup.write.parquet(str(tmp_path / "l"))
    stored = spark.read.parquet(str(tmp_path / "l"))
    joined = lookup_join(certificates, stored, "la", "ladcd")
    assert "BroadcastHashJoin" in plan_of(joined)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan_of(lookup_join(certificates, stored, "la", "ladcd"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_j2_chain_equals_joins_one_by_one(spark):
    facts = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p9"), (4, None)], "id int, postcode string")
    postcodes = spark.createDataFrame([("p1", "l1", "o1"), ("p2", "l2", None)], "pcds string, lsoa21cd string, lsoa11cd string")
    tenure = spark.createDataFrame([("l1", 10)], "lsoa21cd string, owned int")
    index = spark.createDataFrame([("o1", 5), ("o2", 6)], "lsoa11cd string, rank int")
    places = enrich_dimension(
        postcodes, [(tenure, "lsoa21cd", "lsoa21cd"), (index, "lsoa11cd", "lsoa11cd")]
    )
    got = enrich(facts, places, "postcode", "pcds")
    step = enrich(facts, postcodes, "postcode", "pcds")
    step = enrich(enrich(step, tenure, "lsoa21cd", "lsoa21cd"), index, "lsoa11cd", "lsoa11cd")
    assert got.columns == step.columns
    assert rows_of(got) == rows_of(step)
    assert rows_of(got)[2:] == [(3, "p9", None, None, None, None, None), (4, None, None, None, None, None, None)]


def test_j5_semi_join_does_not_multiply(spark, certificates):
    codes = spark.createDataFrame([("A",), ("A",), (None,)], "code string")
    assert semi_join_codes(certificates, "la", codes).count() == 7


def test_p6_clashing_names(spark):
    left = spark.createDataFrame([("a", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 2)], "K string, V int")
    assert join_side_by_side(left, right, [("k", "K")]).columns == ["k", "v"]
    both = join_side_by_side(left, right, [("k", "k")], clash="suffix")
    assert both.columns == ["k", "v", "K_1", "V_1"]
    assert rows_of(both) == [("a", 1, "a", 2)]
    with pytest.raises(ValueError, match="clash"):
        join_side_by_side(left, right, [("k", "k")], clash="both")


def test_p5_partial_match_in_column_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "lat int, flat int, pcds int, other int")
    assert select_by_regex(df, "^pcd|lat").columns == ["lat", "flat", "pcds"]
    with pytest.raises(ValueError, match="No column"):
        select_by_regex(df, "^zzz")


def test_p1_p3_p4_p14_layouts(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` int, C int")
    assert select_layout(df, {"x": "A B", "date": "C"}).columns == ["x", "date"]
    for action in (
        lambda: select_layout(df, {"x": "missing"}),
        lambda: drop_strict(df, ["missing"]),
        lambda: rename_strict(df, {"missing": "x"}),
    ):
        with pytest.raises(ValueError, match="Missing required columns"):
            action()
    assert drop_strict(df, ["C"]).columns == ["A B"]
    assert drop_if_present(df, "C", "missing").columns == ["A B"]


def test_p16_p17_p18(spark):
    df = spark.createDataFrame([(1, (2, 3))], "id int, s struct<x:int,y:int>")
    assert unnest(df, "s", drop=["y"]).columns == ["id", "x"]
    once = add_columns(df, {"d": F.col("id") + 1})
    assert rows_of(add_columns(once, {"d": F.col("id") + 1})) == rows_of(once)
    chained = add_chained(df, [("a", F.col("id") + 1), ("b", F.col("a") * 10)])
    assert chained.first()["b"] == 20


def test_a3_ratio_of_sums_and_zero_denominator(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 6.0), ("b", 1.0, 0.0)], "k string, n double, d double")
    assert rows_of(ratio_of_sums(df, ["k"], "n", "d", "r")) == [("a", 0.5), ("b", None)]


def test_u1_u2_union(spark):
    ints = spark.createDataFrame([(1, "a")], "x int, k string")
    doubles = spark.createDataFrame([("b", 2.5)], "k string, x double")
    both = union_all([ints, doubles])
    assert dict(both.dtypes)["x"] == "double"
    assert rows_of(both) == [(1.0, "a"), (2.5, "b")]
    with pytest.raises(ValueError):
        union_all([])


def test_u3_append_needs_the_same_columns(spark, lookup):
    extra = {"ladcd": "E9", "ladnm": "Nine", "cauthcd": "C1", "cauthnm": "Region A"}
    assert append_rows(lookup, [extra]).count() == 4
    assert append_rows(lookup, []).count() == 3
    with pytest.raises(ValueError, match="differ"):
        append_rows(lookup, [{"ladcd": "E9"}])


def test_k7_and_o1(spark, lookup, traffic):
    counts = table_counts({"traffic": traffic, "lookup": lookup})
    assert [tuple(r) for r in counts.collect()] == [("lookup", 3), ("traffic", 6)]
    assert first_rows(traffic, 2).count() == 2
    assert first_rows(traffic, None).count() == 6
    top = first_rows_by(traffic, 2, F.desc("all_motor_vehicles"))
    assert [r["all_motor_vehicles"] for r in top.collect()] == [2023 + 803, 2023 + 802]


def test_c16_numbers_and_chunks(spark):
    codes = [f"E{i:05d}" for i in range(1234)]
    shuffled = codes[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(c,) for c in shuffled], "code string").repartition(7)
    numbered = number_in_order(df, "code")
    assert [r["code"] for r in numbered.orderBy("position").collect()] == codes
    assert [r["position"] for r in numbered.orderBy("position").collect()] == list(range(1234))
    chunks = chunk_codes(df.union(df), "code", 100).orderBy("chunk").collect()
    assert [r["n_codes"] for r in chunks] == [100] * 12 + [34]
    assert ",".join(r["codes"] for r in chunks) == ",".join(codes)
    clause = chunk_filters(chunk_codes(df.where("code < 'E00002'"), "code"), "lsoa21cd").first()["clause"]
    assert clause == "lsoa21cd IN ('E00000', 'E00001')"


def test_c16_quotes_and_other_separators(spark):
    codes = spark.createDataFrame([("a,b",), ("c'd",), ("e|f",)], "code string")
    clause = chunk_filters(chunk_codes(codes, "code", separator="|"), "x").first()["clause"]
    assert clause == "x IN ('a,b', 'c''d', 'e|f')"


def test_r1_unlisted_label_fails_and_one_shuffle(spark):
    long = spark.createDataFrame([(1, "a", 5), (1, "zz", 6)], "k int, label string, v int")
    with pytest.raises(Exception, match="unlisted label zz"):
        pivot_unique(long, ["k"], "label", "v", ["a"]).collect()
    wide = pivot_unique(long, ["k"], "label", "v", ["a", "zz"])
    assert [tuple(r) for r in wide.collect()] == [(1, 5, 6)]
    assert wide._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1
