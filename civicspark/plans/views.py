"""View registry (V10): every published view as a lazy frame and a temporary view."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from civicspark.operators.filters import Box
from civicspark.plans.certificates import (
    domestic_enriched_view, domestic_publication_view, domestic_region_view,
    non_domestic_publication_view, non_domestic_view,
)
from civicspark.plans.emissions import (
    emissions_long_table, per_capita_emissions_view, subsector_emissions_view,
)
from civicspark.plans.geography import simple_geography_view

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Region:
    """What the regional views are about."""

    name: str
    box: Box = field(default_factory=Box)
    exclude_la: str | None = None


Frames = Mapping[str, DataFrame]

# Published view name: builder.  A builder sees the tables and the views before it.
VIEWS: dict[str, Callable[[Frames, Region], DataFrame]] = {
    "simple_geog_lookup_vw": lambda t, r: simple_geography_view(
        t["postcodes"], t["ca_la"], r.name
    ),
    "ca_la_ghg_emissions_sub_sector_ods_vw": lambda t, r: subsector_emissions_view(
        t["ghg_emissions"], t["ca_la"]
    ),
    "per_cap_emissions_ca_national_vw": lambda t, r: per_capita_emissions_view(
        t["emissions"], t["ca_la"], r.exclude_la
    ),
    "ca_emissions_evidence_long_tbl": lambda t, r: emissions_long_table(
        t["emissions"], t["ca_la"]
    ),
    "epc_domestic_vw": lambda t, r: domestic_enriched_view(
        t["epc_domestic"], t["postcodes"], t["tenure"], t["imd_lsoa"]
    ),
    "epc_domestic_lep_vw": lambda t, r: domestic_region_view(
        t["epc_domestic_vw"], t["ca_la"], r.name, r.box
    ),
    "epc_domestic_ods_vw": lambda t, r: domestic_publication_view(t["epc_domestic_lep_vw"]),
    "epc_non_domestic_vw": lambda t, r: non_domestic_view(
        t["epc_nondom"], t["ca_la"], t["postcodes"], r.name
    ),
    "epc_non_domestic_ods_vw": lambda t, r: non_domestic_publication_view(
        t["epc_non_domestic_vw"], r.box
    ),
}


@dataclass
class ViewReport:
    created: list[str] = field(default_factory=list)
    failed: list[tuple[str, str]] = field(default_factory=list)
    views: dict[str, DataFrame] = field(default_factory=dict)

    def raise_if_failed(self) -> ViewReport:
        """An error that lists the views that were not created, if any."""
        if self.failed:
            raise RuntimeError(f"views not created: {self.failed}")
        return self


def create_all_views(
    spark: SparkSession, tables: Frames, region: Region, skip_errors: bool = True
) -> ViewReport:
    """Build every view and register it.  No job runs.

    A view whose tables are missing is reported as failed; with ``skip_errors=False`` the
    first failure is raised.
    """
    report = ViewReport()
    known = dict(tables)
    for name, build in VIEWS.items():
        try:
            view = build(known, region)
            view.createOrReplaceTempView(name)
        except Exception as error:
            report.failed.append((name, f"{type(error).__name__}: {error}"))
            if not skip_errors:
                raise
            continue
        known[name] = report.views[name] = view
        report.created.append(name)
    if report.failed:
        log.warning("Views not created: %s", [name for name, _ in report.failed])
    return report
