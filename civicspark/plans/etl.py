"""End-to-end runs (V24-V26): landed files -> raw tables -> clean tables -> views."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from civicspark.operators.aggregates import distinct_values
from civicspark.operators.columns import quoted
from civicspark.operators.filters import in_codes
from civicspark.operators.quality import assert_unique, count_rows_of, rows_counted, warn_if_none
from civicspark.operators.sets import stable_rows
from civicspark.plans.certificates import transform_epc_domestic, transform_epc_nondomestic
from civicspark.plans.emissions import (
    transform_dft_lookup, transform_ghg_emissions, transform_imd_2025,
)
from civicspark.plans.geography import (
    add_geometry_column, add_geometry_column_from_wkt, get_ca_la_codes, transform_ca_la_lookup,
    transform_lsoa_pwc,
)
from civicspark.plans.views import Region, ViewReport, create_all_views
from civicspark.sources.files import read_certificate_pages, read_features, read_geojson
from civicspark.sources.landed_schemas import (
    SchemaDrift, fail_on_drift, json_schema_stored, read_csv_stored, store_schema, type_drift,
)
from civicspark.sources.sinks import replace_partitioned, replace_table
from civicspark.streaming.periods import previous_month, three_months_back

log = logging.getLogger(__name__)

# Landed feature layers, and whether they carry point geometry.
FEATURE_LAYERS = {
    "lsoa_2021_boundaries": True,
    "lsoa_2011_boundaries": True,
    "lsoa_2021_pwc": True,
    "lsoa_2021_lookups": False,
    "lsoa_2011_lookups": False,
}
LOOKUP_LAYER = "ca_la_lookup"
BOUNDARIES = "ca_boundaries_2025"

# The open-data CSVs.
CSV_SOURCES = ("dft_traffic", "ghg_emissions", "imd_2025")

# Tables of the full build and their unique key, None where there is none.
TABLE_KEYS = {
    "lsoa_2021_pwc": "lsoa21cd",
    "lsoa_2021_lookup": "lsoa21cd",
    "lsoa_2011_lookup": None,
    "imd_lsoa": "lsoa11cd",
    "epc_domestic": "LMK_KEY",
    "epc_nondom": "LMK_KEY",
    "lsoa_poly_2021": "lsoa21cd",
    "lsoa_poly_2011": "lsoa11cd",
    "ghg_emissions": None,
    "emissions": None,
    "tenure": "lsoa21cd",
    "postcodes": "pcds",
    "postcode_lookup": None,
    "ca_la": None,
    "ca_boundaries_bgc": None,
    "la_all_mysoc": None,
    "ca_la_dft_lookup": "ladcd",
}

# Tables of the full build that regional views read by authority, and the column they use.
TABLE_PARTITIONS = {"epc_domestic": "LOCAL_AUTHORITY", "epc_nondom": "LOCAL_AUTHORITY"}

# How a table of the full build gets its geometry column.
TABLE_GEOMETRY: dict[str, Callable[[DataFrame], DataFrame]] = {
    "lsoa_2021_pwc": add_geometry_column,
    "postcodes": lambda df: add_geometry_column(df, "long", "lat"),
    "lsoa_poly_2021": add_geometry_column_from_wkt,
    "lsoa_poly_2011": add_geometry_column_from_wkt,
}


@dataclass
class RunReport:
    """Tables written (name -> frame over the written files), how many rows each took in, steps
    that were skipped, and sources that differ from their stored schema."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    failed: list[tuple[str, str]] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    drift: list[tuple[str, SchemaDrift]] = field(default_factory=list)

    def inventory(self) -> DataFrame:
        """K7: (table_name, n_rows) by name, as counted while the tables were written; no table is
        read again.  One row per table, so this is a handful of values."""
        spark = SparkSession.active()
        counts = [(name, self.rows[name]) for name in sorted(self.tables)]
        return spark.createDataFrame(counts, "table_name string, n_rows bigint").orderBy("table_name")

    def write(self, name: str, df: DataFrame, path: str) -> DataFrame:
        """Replace a table, taking its row count on the way."""
        observed, rows = count_rows_of(df, name)
        written = replace_table(observed, path)
        self.rows[name] = rows_counted(rows, written)
        return written

    def raise_if_failed(self) -> RunReport:
        """An error that lists the steps that were skipped, if any."""
        if self.failed:
            raise RuntimeError(f"steps failed: {self.failed}")
        return self

    def run(self, step: str, on_error: str, action: Callable[[], DataFrame | None]) -> None:
        """One step under its policy: ``fail`` raises, ``skip`` records and goes on."""
        try:
            written = action()
        except Exception as error:
            if on_error == "fail":
                raise
            log.warning("Step %s skipped: %s", step, error)
            self.failed.append((step, f"{type(error).__name__}: {error}"))
            return
        if written is not None:
            self.tables[step] = written


def _join_path(*parts: str) -> str:
    return "/".join(part.rstrip("/") for part in parts)


def extract_all(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    row_limit: int | None = None,
    geography: bool = True,
    tolerant: bool = False,
    multi_line: bool = True,
    schemas: str | None = None,
    strict_schemas: bool = False,
) -> RunReport:
    """Replace the raw tables by what has landed.

    ``tolerant`` skips the geography layers and the deprivation index when they fail;
    any other source that fails stops the run.  With ``multi_line=False`` JSON pages are
    one to a line and CSV fields hold no line breaks, so Spark can split large files.
    ``row_limit`` takes a stable sample of the CSVs (O1).  Schemas are kept below ``schemas``, by
    default beside the sources, and inferred once.  A source that differs from its schema is
    reported by column in ``drift`` and its new schema taken, or fails under ``strict_schemas``.
    """
    report = RunReport()
    optional = "skip" if tolerant else "fail"
    stores = schemas or _join_path(landing, "schemas")

    def raw(name: str) -> str:
        return _join_path(warehouse, "raw_data", name)

    def drifted(path: str, drift: SchemaDrift) -> None:
        if strict_schemas:
            fail_on_drift(path, drift)
        log.warning("%s differs from its stored schema - %s", path, drift)
        report.drift.append((path, drift))

    def page_schema_of(name: str) -> StructType:
        return json_schema_stored(spark, _join_path(landing, name), _join_path(stores, name), multi_line, drifted)

    def features(name: str, with_geometry: bool) -> DataFrame:
        rows = read_features(
            spark, _join_path(landing, name), with_geometry, schema=page_schema_of(name), multi_line=multi_line)
        return report.write(name, rows, raw(name))

    def boundaries() -> DataFrame:
        rows = read_geojson(spark, _join_path(landing, BOUNDARIES), page_schema_of(BOUNDARIES), multi_line)
        return report.write(BOUNDARIES, rows, raw(BOUNDARIES))

    def open_data(name: str) -> DataFrame:
        path, store = _join_path(landing, name), _join_path(stores, name)
        for again in (False, True):
            rows = read_csv_stored(spark, path, store, multi_line=multi_line, on_drift=drifted)
            try:
                return report.write(name, stable_rows(rows, row_limit), raw(name))
            except Exception:
                # A cell that does not fit: have the types of its column changed?
                drift, present = type_drift(spark, path, store, multi_line=multi_line)
                if again or not drift:
                    raise
                drifted(path, drift)
                store_schema(spark, present, store)

    if geography:
        for name, with_geometry in FEATURE_LAYERS.items():
            report.run(name, optional, lambda n=name, g=with_geometry: features(n, g))
        report.run(LOOKUP_LAYER, optional, lambda: features(LOOKUP_LAYER, False))
        report.run(BOUNDARIES, "fail", boundaries)
    for name in CSV_SOURCES:
        report.run(name, optional if name == "imd_2025" else "fail", lambda n=name: open_data(n))
    return report


def run_full_etl(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    download_epc: bool = False,
    epc_from_date: tuple[int, int] | None = None,
    sample_mode: bool = False,
    sample_size: int = 1000,
    skip_arcgis: bool = False,
    extra_la_rows: Sequence[Mapping] = (),
    default_la_codes: Sequence[str] | None = None,
    small_areas: DataFrame | None = None,
    today: date | None = None,
    multi_line: bool = True,
    schemas: str | None = None,
    strict_schemas: bool = False,
) -> RunReport:
    """Raw tables, then clean tables under ``transformed_data``.

    * ``sample_mode`` limits the open-data CSVs to ``sample_size`` rows, the same ones on every
      run, and lets geography and deprivation fail.  A sample has a root of its own, ``sample``
      below the warehouse, so it replaces no table of a full run.
    * ``skip_arcgis`` leaves geography out; emissions and traffic then keep all
      authorities, and certificates those of ``default_la_codes`` (all when None).
    * ``small_areas`` restricts the deprivation index; by default the areas that have a
      centroid do.
    * ``multi_line``, ``schemas`` and ``strict_schemas`` as for :func:`extract_all`.
    * Clean-ups of emissions, traffic, deprivation and certificates never stop the run.
    """
    if sample_mode:
        warehouse = _join_path(warehouse, "sample")
    extracted = extract_all(
        spark, landing, warehouse, sample_size if sample_mode else None,
        geography=not skip_arcgis, tolerant=sample_mode, multi_line=multi_line, schemas=schemas,
        strict_schemas=strict_schemas,
    )
    raw, report = extracted.tables, RunReport(failed=list(extracted.failed), drift=extracted.drift)

    def clean(name: str, df: DataFrame) -> DataFrame:
        written = report.write(name, df, _join_path(warehouse, "transformed_data", name))
        warn_if_none(report.rows[name], f"{name} has no rows - check codes and periods")
        return written

    la_codes = lsoa_codes = None
    if not skip_arcgis:
        report.run("ca_la_lookup", "fail", lambda: clean(
            "ca_la_lookup", transform_ca_la_lookup(raw[LOOKUP_LAYER], extra_la_rows)))
        report.run("lsoa_2021_pwc", "fail", lambda: clean(
            "lsoa_2021_pwc", add_geometry_column(transform_lsoa_pwc(raw["lsoa_2021_pwc"]))))
        la_codes = get_ca_la_codes(report.tables["ca_la_lookup"])
        lsoa_codes = small_areas
        if lsoa_codes is None:
            lsoa_codes = distinct_values(report.tables["lsoa_2021_pwc"], "lsoa21cd")
    report.run("ghg_emissions", "skip", lambda: clean(
        "ghg_emissions", transform_ghg_emissions(raw["ghg_emissions"], la_codes)))
    report.run("dft_la_lookup", "skip", lambda: clean(
        "dft_la_lookup", transform_dft_lookup(raw["dft_traffic"], la_codes)))
    report.run("imd_2025", "skip", lambda: clean(
        "imd_2025", transform_imd_2025(raw["imd_2025"], lsoa_codes)))
    if download_epc:
        start, end = epc_from_date or three_months_back(today), previous_month(today)
        codes = la_codes if la_codes is not None else default_la_codes
        for name, cert_type, transform in (
            ("epc_domestic", "domestic", transform_epc_domestic),
            ("epc_nondomestic", "non-domestic", transform_epc_nondomestic),
        ):
            def certificates(name=name, cert_type=cert_type, transform=transform) -> DataFrame:
                pages = read_certificate_pages(
                    spark, _join_path(landing, name), cert_type,
                    from_period=start, to_period=end, multi_line=multi_line,
                )
                if codes is not None:
                    pages = in_codes(pages, "local-authority", codes)
                return clean(name, transform(pages))

            report.run(name, "skip", certificates)
    return report


@dataclass
class BuildReport:
    tables: dict[str, DataFrame]
    views: ViewReport


def build_tables(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    warehouse: str,
    region: Region,
    skip_view_errors: bool = True,
) -> BuildReport:
    """Write every table with its geometry, check its key, then build the views.

    ``inputs`` holds any of the tables of ``TABLE_KEYS``.  A key that is not unique stops
    the build; nothing outside ``warehouse`` is touched, so build into a new path and
    switch readers over afterwards.  Certificates lie in a folder per authority, of which a
    regional view reads only its own.
    """
    unknown = sorted(set(inputs) - set(TABLE_KEYS))
    if unknown:
        raise ValueError(f"Unknown tables: {unknown}")
    tables: dict[str, DataFrame] = {}
    for name, key in TABLE_KEYS.items():
        if name not in inputs:
            continue
        df = TABLE_GEOMETRY.get(name, lambda frame: frame)(inputs[name])
        by, path = TABLE_PARTITIONS.get(name), _join_path(warehouse, name)
        tables[name] = replace_table(df, path) if by is None else replace_partitioned(df, path, by)
        if key:
            assert_unique(tables[name].select(quoted(key)), key)
    return BuildReport(tables, create_all_views(spark, tables, region, skip_view_errors))
