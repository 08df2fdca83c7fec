"""Geography clean-ups and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions.geometry import make_point, parse_wkt
from civicspark.functions.names import apply_names, lower_name, remove_numbers
from civicspark.operators.aggregates import distinct_values
from civicspark.operators.chunks import chunk_codes
from civicspark.operators.columns import (
    add_columns, drop_if_present, join_side_by_side, quoted, select_by_regex,
)
from civicspark.operators.filters import equals, in_codes
from civicspark.operators.quality import distinct_rows, missing_columns, require_columns
from civicspark.operators.sets import append_rows, union_all

# Fixed value: name pattern of the columns the geography view shows.
GEOGRAPHY_COLUMNS = "^ls|^ms|^lad|^pcd|^wd|^lad|^imd|lat|long"


def transform_ca_la_lookup(raw: DataFrame, extra_rows: Sequence[Mapping] = ()) -> DataFrame:
    """Drop the object id, strip digits from names, append rows for authorities the
    source leaves out.  Appended rows are added even where the source has them."""
    clean = apply_names(drop_if_present(raw, "ObjectId"), remove_numbers)
    return append_rows(clean, extra_rows)


def transform_lsoa_pwc(raw: DataFrame) -> DataFrame:
    """Distinct centroids with lower-case names; x and y must be there."""
    clean = apply_names(distinct_rows(raw), lower_name)
    if missing_columns(clean, ["x", "y"]):
        raise ValueError(f"Required geometry columns x and y are not among {clean.columns}")
    return clean


def get_ca_la_codes(lookup: DataFrame) -> DataFrame:
    """The authority codes, as a frame to semi-join with."""
    if "ladcd" not in lookup.columns:
        raise ValueError(f"'ladcd' column not found among {lookup.columns}")
    return lookup.select("ladcd")


def region_codes(lookup: DataFrame, region: str, code: str = "ladcd") -> DataFrame:
    """Codes of the authorities of one combined authority."""
    return equals(lookup, "cauthnm", region).select(quoted(code))


def consolidate_lookups(pages: Sequence[DataFrame]) -> DataFrame:
    """One lookup from its pages: union with widening, lower-case names, distinct."""
    return distinct_rows(apply_names(union_all(pages), lower_name))


def small_area_codes(
    lookup: DataFrame, la_codes: DataFrame | Sequence[str], area: str = "lsoa21cd",
    authority: str = "lad24cd",
) -> DataFrame:
    """Distinct small areas of the given authorities."""
    return distinct_values(in_codes(lookup, authority, la_codes), area)


def small_area_chunks(codes: DataFrame, area: str = "lsoa21cd", size: int = 100) -> DataFrame:
    """The codes in order, a fixed number to a chunk.  See :func:`chunk_codes`."""
    return chunk_codes(codes, area, size)


def region_centroids(centroids: DataFrame, codes: DataFrame, area: str = "lsoa21cd") -> DataFrame:
    """Centroids of the given small areas."""
    return in_codes(centroids, area, codes)


def simple_geography_view(
    postcodes: DataFrame, lookup: DataFrame, region: str, authority: str = "lad25cd"
) -> DataFrame:
    """V1: postcodes of one region, reduced to the geography columns of both sides."""
    authorities = equals(lookup, "cauthnm", region).select("ladcd", "ladnm")
    joined = join_side_by_side(postcodes, authorities, [(authority, "ladcd")], clash="suffix")
    return select_by_regex(joined, GEOGRAPHY_COLUMNS)


def add_geometry_column(
    df: DataFrame, x_col: str = "x", y_col: str = "y", geom_col: str = "geom"
) -> DataFrame:
    """Point column from coordinates; an existing column of that name is replaced."""
    require_columns(df, [x_col, y_col])
    return add_columns(df, {geom_col: make_point(quoted(x_col), quoted(y_col))})


def add_geometry_column_from_wkt(
    df: DataFrame, wkt_col: str = "geometry", geom_col: str = "geom"
) -> DataFrame:
    """Parsed geometry from well-known text."""
    require_columns(df, [wkt_col])
    return add_columns(df, {geom_col: parse_wkt(quoted(wkt_col))})
