"""Stored schemas, drift by column, run counts, stable samples and partitioned certificates."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civicspark.checks import whole_runs
from civicspark.operators.sets import stable_rows
from civicspark.plans import etl
from civicspark.plans.etl import extract_all, run_full_etl
from civicspark.plans.geography import region_codes
from civicspark.operators.joins import semi_join_codes
from civicspark.sources import landed_schemas as ls
from civicspark.sources.sinks import replace_partitioned
from tests.conftest import rows_of


@pytest.fixture
def landing(tmp_path):
    def land(folder, text, name="1.csv"):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)

    land("dft_traffic", "local_authority_id,year,vehicles\n1,2023,5\n2,2023,6\n2,2022,7\n")
    land("ghg_emissions", "local_authority,year,kt\nX,2020,1.5\n")
    land("imd_2025", "lsoa21_code,decile\nL1,01\n")
    return tmp_path, land


def test_second_run_infers_nothing(spark, landing, tmp_path, monkeypatch):
    root, _ = landing
    first = extract_all(spark, str(root), str(tmp_path / "w"), geography=False)
    assert rows_of(first.inventory()) == [("dft_traffic", 3), ("ghg_emissions", 1), ("imd_2025", 1)]

    def never(*args, **kwargs):
        raise AssertionError("a schema was inferred")

    monkeypatch.setattr(ls, "infer_csv_schema", never)
    second = extract_all(spark, str(root), str(tmp_path / "w2"), geography=False)
    assert second.drift == []
    assert {n: t.schema for n, t in second.tables.items()} == {n: t.schema for n, t in first.tables.items()}
    assert rows_of(second.tables["dft_traffic"]) == rows_of(first.tables["dft_traffic"])


def test_drift_is_reported_by_column_and_taken(spark, landing, tmp_path):
    root, land = landing
    extract_all(spark, str(root), str(tmp_path / "w"), geography=False)
    land("dft_traffic", "year,local_authority_id,lorries\n2023,1,5\n")
    land("imd_2025", "lsoa21_code,decile\nL1,low\n")
    with pytest.raises(ls.SchemaDriftError, match="missing: vehicles; added: lorries; moved: local_authority_id, year"):
        extract_all(spark, str(root), str(tmp_path / "w"), geography=False, strict_schemas=True)
    report = extract_all(spark, str(root), str(tmp_path / "w"), geography=False)
    assert [str(d) for _, d in report.drift] == [
        "missing: vehicles; added: lorries; moved: local_authority_id, year", "retyped: decile: int -> string"]
    assert report.tables["dft_traffic"].columns == ["year", "local_authority_id", "lorries"]
    assert rows_of(report.tables["imd_2025"]) == [("L1", "low")]
    assert extract_all(spark, str(root), str(tmp_path / "w"), geography=False, strict_schemas=True).drift == []


def test_a_read_that_fails_for_another_reason_still_fails(spark, landing, tmp_path):
    root, land = landing
    extract_all(spark, str(root), str(tmp_path / "w"), geography=False)
    land("ghg_emissions", "local_authority,year,kt\nX,2020\n", "2.csv")  # a field is missing
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        extract_all(spark, str(root), str(tmp_path / "w"), geography=False)


def test_schema_of_pages(spark, tmp_path):
    def page(*attributes):
        return json.dumps({"features": [{"attributes": a, "geometry": {"x": 1.5}} for a in attributes]})

    landed, store = tmp_path / "layer", str(tmp_path / "store")
    landed.mkdir()
    (landed / "1.json").write_text(page({"code": "a", "n": 1}))
    kind = ls.json_schema_stored(spark, str(landed), store)
    assert ls.json_schema_stored(spark, str(landed), store) == kind
    (landed / "1.json").write_text(page({"code": "a"}))
    assert ls.json_schema_stored(spark, str(landed), store) == kind
    (landed / "1.json").write_text(page())
    assert ls.json_schema_stored(spark, str(landed), store) == kind
    (landed / "1.json").write_text(page({"code": "a", "colour": "red"}))
    with pytest.raises(ls.SchemaDriftError, match="added: features.attributes.colour"):
        ls.json_schema_stored(spark, str(landed), store)
    taken = []
    new = ls.json_schema_stored(spark, str(landed), store, on_drift=lambda *d: taken.append(d))
    assert len(taken) == 1 and "colour" in new.simpleString()
    with pytest.raises(ValueError, match="No schema"):
        ls.type_drift(spark, str(landed), str(tmp_path / "none"))


def test_sample_is_stable_and_leaves_full_tables_alone(spark, landing, tmp_path):
    root, _ = landing
    warehouse = str(tmp_path / "w")
    full = run_full_etl(spark, str(root), warehouse, skip_arcgis=True)
    before = rows_of(spark.read.parquet(f"{warehouse}/raw_data/dft_traffic"))
    run_full_etl(spark, str(root), warehouse, skip_arcgis=True, sample_mode=True, sample_size=2)
    assert rows_of(spark.read.parquet(f"{warehouse}/raw_data/dft_traffic")) == before
    assert spark.read.parquet(f"{warehouse}/sample/raw_data/dft_traffic").count() == 2
    assert set(full.rows) >= set(full.tables)
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("m"))
    assert rows_of(stable_rows(df, 7)) == rows_of(stable_rows(df.orderBy(F.rand()).repartition(9), 7))
    assert stable_rows(df, None) is df


def test_inventory_reads_no_table_again(spark, landing, tmp_path):
    root, _ = landing
    report = extract_all(spark, str(root), str(tmp_path / "w"), geography=False)
    plan = report.inventory()._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_regional_reads_open_their_own_folders_only(spark, lookup, tmp_path):
    rows = [(i, f"E0600002{i % 7}", float(i)) for i in range(70)] + [(70, None, 0.5), (71, "007", 0.5)]
    df = spark.createDataFrame(rows, "id int, LOCAL_AUTHORITY string, v double")
    table = replace_partitioned(df, str(tmp_path / "t"), "LOCAL_AUTHORITY")
    assert table.schema == df.schema
    assert rows_of(table) == rows_of(df)
    lookup.write.parquet(str(tmp_path / "lookup"))
    codes = region_codes(spark.read.parquet(str(tmp_path / "lookup")), "Region A")
    regional = semi_join_codes(table, "LOCAL_AUTHORITY", codes)
    assert "dynamicpruning" in regional._jdf.queryExecution().executedPlan().toString().lower()
    assert {r["LOCAL_AUTHORITY"] for r in regional.collect()} == {"E06000023", "E06000025"}
    assert etl.TABLE_PARTITIONS.keys() <= etl.TABLE_KEYS.keys()


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables here")
def test_regional_views_of_a_build_prune_the_certificates(spark):
    """The row side of the latest-per-property join is pruned by authority, its maximum is not."""
    built = whole_runs._full_build(spark, "/root/testdata/sf0.001")
    for view in ("epc_domestic_lep_vw", "epc_non_domestic_vw"):
        plan = built.views.views[view]._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "LOCAL_AUTHORITY" in line]
        pruned = ["dynamicpruningexpression(LOCAL_AUTHORITY" in line for line in scans]
        assert sorted(pruned) == [False, True], scans
