"""Points and rings without a spatial extension.

A point is ``struct<x, y>``.  A parsed geometry is ``struct<kind, parts>`` with
``parts[polygon][ring][point]``; a POINT, MULTIPOINT or LINESTRING is one polygon with one
ring, a MULTILINESTRING one polygon with a ring for each line, and a GEOMETRYCOLLECTION has the
polygons of all its members, those of nested collections too.  An EMPTY geometry has no parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicspark.functions.scalars import _col, unscientific
from civicspark.functions.wkt import GEOMETRY, parse_texts


def make_point(x: Column | str, y: Column | str) -> Column:
    """X is the longitude, y the latitude.  NULL when either is missing."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def number_text(value: Column) -> Column:
    """A double in plain notation: the shortest digits that read back, without a final ``.0``."""
    return F.regexp_replace(unscientific(value), r"\.0$", "")


def point_text(point: Column | str) -> Column:
    """C11: ``POINT (x y)``; NULL stays NULL."""
    point = _col(point)
    x, y = point.getField("x"), point.getField("y")
    return F.when(
        point.isNotNull(),
        F.concat(F.lit("POINT ("), number_text(x), F.lit(" "), number_text(y), F.lit(")")),
    )


def parse_wkt(text: Column | str) -> Column:
    """Text of every simple, multiple and collected kind to nested coordinates.

    Whole Arrow batches are parsed by prefix sums (see ``wkt``); collections may lie in
    collections.  Ordinates after the second are left out.  Text without parentheses, unless
    EMPTY, gives NULL; text with malformed coordinates or brackets gives a geometry of NULL parts.
    """
    return F.arrow_udf(parse_texts, GEOMETRY)(_col(text).cast("string"))


def first_point(geometry: Column | str) -> Column:
    """The first coordinate pair of a parsed geometry."""
    parts = _col(geometry).getField("parts")
    ring = F.try_element_at(F.try_element_at(parts, F.lit(1)), F.lit(1))
    return F.try_element_at(ring, F.lit(1))
