"""Keyed tables: what an upsert rewrites, what the record keeps, and what a crash leaves."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civicspark.plans.certificates import refresh_certificate_table
from civicspark.schemas import DOMESTIC_CERTIFICATES
from civicspark.session import remove_scratch, scratch_path
from civicspark.sources.keyed import BUCKET, KeyedTable
from civicspark.sources.sinks import export_csv
from civicspark.streaming.periods import period_after
from civicspark.streaming.refresh import refresh_keyed_table
from tests.conftest import rows_of

KIND = "k string, day date, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, day string, v int").withColumn("day", F.col("day").cast("date"))


def base(spark, n=40):
    return frame(spark, [(f"k{i}", "2024-01-31", i) for i in range(n)] + [(None, "2024-02-01", -1)] * 2)


def files_of(table):
    return {p.parent.name: {(f.name, f.stat().st_mtime_ns) for f in p.parent.glob("part-*")} for p in Path(table.data).glob(f"{BUCKET}=*/part-*")}


def values(table):
    return rows_of(table.read().select("k", F.col("day").cast("string"), "v"))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = KeyedTable.create(base(spark), str(tmp_path / "t"), "k", 8, "day")
    before = files_of(table)
    assert len(before) == 8
    table.upsert(frame(spark, [("k3", "2024-03-05", 300), ("k3", "2024-03-04", 299)]), ["day"])
    after = files_of(table)
    changed = {b for b in before if before[b] != after[b]}
    number = table.with_bucket(frame(spark, [("k3", None, 0)])).first()[BUCKET]
    assert changed == {f"{BUCKET}={number}"}
    want = [(f"k{i}", "2024-01-31", i) for i in range(40) if i != 3] + [("k3", "2024-03-05", 300)] + [(None, "2024-02-01", -1)] * 2
    assert values(table) == sorted(want, key=repr)
    assert table.state.high_water == "2024-03-05"


def test_plan_reads_touched_buckets_only(spark, tmp_path):
    table = KeyedTable.create(base(spark), str(tmp_path / "t"), "k", 8)
    plan = table.read([3])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan or f"PartitionFilters: [({BUCKET}" in plan


def test_rows_without_a_key_are_added_and_types_follow_the_table(spark, tmp_path):
    table = KeyedTable.create(base(spark, 3), str(tmp_path / "t"), ["k"], 4, "day")
    new = spark.createDataFrame([("7", None, "2025-01-01"), ("8", "k1", "2023-01-01")], "v string, k string, day string")
    table.upsert(new, ["v"])
    assert values(table) == sorted([("k0", "2024-01-31", 0), ("k1", "2023-01-01", 8), ("k2", "2024-01-31", 2),
                                    (None, "2024-02-01", -1), (None, "2024-02-01", -1), (None, "2025-01-01", 7)], key=repr)
    assert table.state.high_water == "2025-01-01"


def test_nothing_new_changes_nothing(spark, tmp_path):
    table = KeyedTable.create(base(spark, 5), str(tmp_path / "t"), "k", 4, "day")
    before, sequence = files_of(table), table.state.sequence
    table.upsert(frame(spark, []).limit(0), ["day"])
    assert files_of(table) == before and table.state.sequence == sequence
    again = KeyedTable.open(spark, str(tmp_path / "t"))
    assert again.state == table.state
    with pytest.raises(ValueError, match="There is a keyed table"):
        KeyedTable.create(base(spark, 5), str(tmp_path / "t"), "k", 4)
    with pytest.raises(ValueError, match="No keyed table"):
        KeyedTable.open(spark, str(tmp_path / "other"))


def test_empty_table_grows(spark, tmp_path):
    table = KeyedTable.create(spark.createDataFrame([], KIND), str(tmp_path / "t"), "k", 4, "day")
    assert table.read().count() == 0 and table.state.high_water is None
    table.upsert(base(spark, 2), ["day"])
    assert table.read().count() == 4


class Died(Exception):
    pass


@pytest.mark.parametrize("place", ["before the record", "after the record", "within the replacement"])
def test_a_run_that_died_is_repeated_harmlessly(spark, tmp_path, monkeypatch, place):
    root = str(tmp_path / "t")
    KeyedTable.create(base(spark, 20), root, "k", 4, "day")
    new = frame(spark, [(f"k{i}", "2024-04-01", 100 + i) for i in range(7)])
    table = KeyedTable.open(spark, root)

    def die(*args, **changes):
        raise Died

    with monkeypatch.context() as patch:
        if place == "before the record":
            patch.setattr(table, "_record", die)
        elif place == "after the record":
            patch.setattr(table, "_finish", die)
        else:  # the old files of a bucket are gone and the new ones not there yet
            patch.setattr(table, "_finish", lambda: (_drop_one_bucket(table), die()))
        with pytest.raises(Died):
            table.upsert(new, ["day"], last_batch=4)
    opened = KeyedTable.open(spark, root)
    assert opened.state.pending is None
    assert opened.state.last_batch == (-1 if place == "before the record" else 4)
    opened.upsert(new, ["day"], last_batch=4)
    want = [(f"k{i}", "2024-04-01", 100 + i) for i in range(7)] + [(f"k{i}", "2024-01-31", i) for i in range(7, 20)]
    assert values(opened) == sorted(want + [(None, "2024-02-01", -1)] * 2, key=repr)


def _drop_one_bucket(table):
    merged = table.spark.read.parquet(table.state.pending)
    number = merged.select(BUCKET).first()[0]
    folder = table.spark._jvm.org.apache.hadoop.fs.Path(f"{table.data}/{BUCKET}={number}")
    folder.getFileSystem(table.spark._jsc.hadoopConfiguration()).delete(folder, True)


def test_second_refresh_brings_back_no_old_row(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "t")
    schema = base(spark).schema
    KeyedTable.create(base(spark, 4), root, "k", 4, "day")

    def refresh():
        return refresh_keyed_table(spark, root, f"{landed}/run=*", schema, str(tmp_path / "u"), str(tmp_path / "c"), order=["day"])

    export_csv(frame(spark, [("k0", "2024-05-01", 50)]), f"{landed}/run=0")
    assert refresh().state.last_batch == 0
    KeyedTable.open(spark, root).upsert(frame(spark, [("k0", "2024-06-01", 60)]), ["day"])
    table = refresh()  # no new files: the old batch stays old
    assert ("k0", "2024-06-01", 60) in values(table)
    export_csv(frame(spark, [("k1", "2024-05-02", 51)]), f"{landed}/run=1")
    table = refresh()
    assert {("k0", "2024-06-01", 60), ("k1", "2024-05-02", 51)} <= set(values(table))
    assert (table.state.last_batch, table.state.high_water) == (1, "2024-06-01")


def test_certificates_go_on_after_the_recorded_month(spark, tmp_path):
    def certificates(rows):
        kept = dict(spark.createDataFrame([], DOMESTIC_CERTIFICATES).dtypes)
        named = spark.createDataFrame(rows, "LMK_KEY string, LOCAL_AUTHORITY string, LODGEMENT_DATE string")
        return named.select([(F.col(n) if n in named.columns else F.lit(None)).cast(t).alias(n) for n, t in kept.items()])

    root, landed = str(tmp_path / "t"), str(tmp_path / "pages")
    KeyedTable.create(certificates([("a", "E1", "2023-12-30"), ("b", "E1", "2023-11-01")]), root, "LMK_KEY", 4, "LODGEMENT_DATE")
    pages = certificates([("a", "E1", "2024-01-01"), ("c", "E1", "2023-12-31"), ("d", "E2", "2024-02-01"), ("e", "E1", "2024-03-01")])
    export_csv(pages.toDF(*[c.lower().replace("_", "-") for c in pages.columns]), landed)
    table = refresh_certificate_table(spark, root, landed, la_codes=["E1"], to_period=(2024, 2))
    assert rows_of(table.read().select("LMK_KEY", F.col("LODGEMENT_DATE").cast("string"))) == [("a", "2024-01-01"), ("b", "2023-11-01")]
    assert table.state.high_water == "2024-01-01"


def test_periods_and_scratch(spark):
    from datetime import date
    assert [period_after(date(2023, m, 9)) for m in (1, 11, 12)] == [(2023, 2), (2023, 12), (2024, 1)]
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_scratch(spark, path)
    assert not Path(path).exists()
    with pytest.raises(ValueError, match="shared folder"):
        remove_scratch(spark, "/somewhere/else")
