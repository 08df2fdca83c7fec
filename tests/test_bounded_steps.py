"""Steps of runs, builds and archive reads whose memory must not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from civicspark.checks.files import _land_csv
from civicspark.operators import quality
from civicspark.sources import archives
from civicspark.sources.sinks import GATHER_PARTITIONS, export_csv, gather_by, replace_partitioned
from tests.conftest import rows_of
from tests.test_files import put_zip


def test_rows_are_gathered_by_a_bounded_number_of_partitions(spark, tmp_path):
    df = spark.range(3000).select("id", F.when(F.col("id") % 11 > 0, F.concat(F.lit("A"), F.col("id") % 11)).alias("code"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "600")
    try:
        plan = gather_by(df, "code")._jdf.queryExecution().executedPlan().toString()
        assert rows_of(replace_partitioned(df, str(tmp_path / "t"), "code")) == rows_of(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert f", {GATHER_PARTITIONS})" in plan and "600" not in plan
    small = gather_by(df, "code")._jdf.queryExecution().executedPlan().toString()
    assert f", {before})" in small


def test_unique_texts_are_not_shuffled_whole(spark, monkeypatch):
    unique = spark.createDataFrame([("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    with monkeypatch.context() as patched:
        patched.setattr(quality, "duplicate_keys", lambda *_: pytest.fail("whole keys were compared"))
        quality.assert_unique(unique, "k")
        quality.assert_unique(unique.where("k IS NOT NULL"), "k", "n")
    for key in (("n",), ("n", "k")):
        with pytest.raises(ValueError, match="Duplicate values"):
            quality.assert_unique(unique.unionByName(unique), *key)


def test_blocks_stay_small_whatever_the_archive(tmp_path):
    rows = [(f"k{i}", f'text "{i}"\n' + "x" * 900) for i in range(6000)]
    rows[4321] = ("long", "y" * 3_000_000)
    quoted = "".join('{},"{}"\n'.format(k, t.replace('"', '""')) for k, t in rows)
    put_zip(tmp_path / "a.zip", {"certificates.csv": "k,t\n" + quoted})

    def read(n_bytes):
        return list(archives._text_batches(str(tmp_path / "a.zip"), ["t", "k"], archives.certificates_member, n_bytes))

    batches = read(archives.BLOCK_BYTES)
    assert [(r["k"], r["t"]) for b in batches for r in b.to_pylist()] == rows
    assert sorted(b.get_total_buffer_size() for b in batches[:3])[-1] < 2 * archives.USUAL_BLOCK_BYTES
    with pytest.raises(ValueError, match="certificates.csv of .*a.zip"):
        read(2 << 20)


def test_landed_lines_are_those_of_the_csv_writer(spark, tmp_path):
    df = spark.sql("""SELECT * FROM VALUES
        (1, 'plain', timestamp'2021-03-01 10:20:30.25', date'2021-03-01', 1.50BD, 1e10D, CAST(NULL AS string)),
        (2, 'a,b', NULL, NULL, NULL, 0.1D, NULL), (3, 'say "x"', timestamp'1999-12-31 00:00:00', NULL, 0.00BD, -0.5D, NULL),
        (4, '', NULL, NULL, 12BD, NULL, NULL), (NULL, ' edge ', NULL, NULL, NULL, NULL, NULL), (6, 'two\\nlines', NULL, NULL, 7BD, 2D, '')
        AS t(n, `a-b`, at, day, price, x, none)""").repartition(3)
    for land, name in ((export_csv, "old"), (_land_csv, "new")):
        land(df, str(tmp_path / name))
        land(df.where("n > 100"), str(tmp_path / f"{name}-none"))

    def lines(name):
        parts = [p.read_text() for p in (tmp_path / name).glob("part-*") if p.stat().st_size]
        assert parts and all(p.startswith("n,a-b,at,day,price,x,none\n") for p in parts)
        return sorted(line for p in parts for line in p.splitlines()[1:])

    assert lines("new") == lines("old")
    for gone in (["n"], ["day", "price"], ["x", "none"], ["a-b", "at", "none"]):
        blank = df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in gone})
        export_csv(blank, str(tmp_path / "old"))
        _land_csv(blank, str(tmp_path / "new"), gone)
        assert lines("new") == lines("old")
    assert lines("new-none") == lines("old-none") == []
