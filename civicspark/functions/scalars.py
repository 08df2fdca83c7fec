"""Scalar column expressions (C1-C8, C12-C15), all built-in and code-generated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns of an age band, in the order they are tried.
AGE_RANGE = r"(\d{4})-(\d{4})"
AGE_BEFORE = r"before (\d{4})"
AGE_ONWARDS = r"(\d{4}) onwards"
AGE_ANY_YEAR = r"(\d{4})"

# Tenure spellings by the category they stand for.
TENURE_CATEGORIES = {
    "Owner occupied": ["owner-occupied", "Owner-occupied"],
    "Social rented": ["Rented (social)", "rental (social)"],
    "Private rented": ["rental (private)", "Rented (private)"],
}

# The two certificate types.
CERTIFICATE_TYPES = ("domestic", "non-domestic")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_to_int(text: Column | str) -> Column:
    """Cast that gives NULL instead of failing."""
    return _col(text).try_cast("int")


def matches(text: Column | str, pattern: str) -> Column:
    """C4: true when the pattern occurs anywhere in the text."""
    return _col(text).rlike(pattern)


def extract(text: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match; empty text when nothing matches."""
    return F.regexp_extract(_col(text), pattern, group)


def half_up_int(value: Column) -> Column:
    """Round half away from zero, as integer."""
    return F.round(value).cast("int")


def nominal_construction_year(band: Column | str) -> Column:
    """Year an age band stands for.

    A tight ``dddd-dddd`` range gives its rounded mid-point; then ``before dddd``,
    ``dddd onwards`` and any four digits give that year; anything else is NULL.  A range
    written with blanks round the hyphen is not tight, so its first year counts.
    """
    band = _col(band)
    first, last = (text_to_int(extract(band, AGE_RANGE, g)) for g in (1, 2))
    year = F.when(matches(band, AGE_RANGE), half_up_int((first + last) / F.lit(2.0)))
    for pattern in (AGE_BEFORE, AGE_ONWARDS, AGE_ANY_YEAR):
        year = year.when(matches(band, pattern), text_to_int(extract(band, pattern)))
    return year


def construction_epoch(year: Column | str) -> Column:
    """Epoch of a nominal year; a missing year is ``Unknown``."""
    year = _col(year)
    return (
        F.when(year < 1900, "Before 1900")
        .when(year.between(1900, 1930), "1900 - 1930")
        .when(year > 1930, "1930 to present")
        .otherwise("Unknown")
    )


def map_categories(value: Column | str, categories: Mapping[str, Sequence[str]]) -> Column:
    """Exact, case-sensitive synonym map; whatever is not listed becomes NULL."""
    value = _col(value)
    out = F.lit(None).cast("string")
    for category, spellings in reversed(list(categories.items())):
        out = F.when(value.isin(list(spellings)), category).otherwise(out)
    return out


def clean_tenure(value: Column | str) -> Column:
    """C3 with the tenure spellings."""
    return map_categories(value, TENURE_CATEGORIES)


def date_parts(stamp: Column | str, prefix: str = "LODGEMENT_") -> dict[str, Column]:
    """Day, month and year as integers, named for ``withColumns``."""
    stamp = _col(stamp)
    return {
        f"{prefix}DAY": F.dayofmonth(stamp),
        f"{prefix}MONTH": F.month(stamp),
        f"{prefix}YEAR": F.year(stamp),
    }


def concat_nulls_empty(*parts: Column) -> Column:
    """Concatenation in which NULL counts as empty text."""
    return F.concat_ws("", *[part.cast("string") for part in parts])


def unscientific(value: Column | str) -> Column:
    """A double as text in plain notation: the shortest digits that read back as the value.

    Whole numbers keep ``.0``.  Only text in scientific notation is taken apart.
    """
    value = _col(value).cast("double")
    exact = value.cast("string")
    digits = F.regexp_replace(F.regexp_extract(exact, r"^-?([0-9.]+)E", 1), r"\.", "")
    power = F.regexp_extract(exact, r"E(-?[0-9]+)$", 1).try_cast("int")
    sign = F.when(value < 0, "-").otherwise("")
    # 1.2345E7: the point moves right behind digit 8, zeros fill what is missing.
    padded = F.rpad(digits, F.greatest(power + 2, F.length(digits)), "0")
    large = F.concat(sign, F.substring(padded, F.lit(1), power + 1), F.lit("."), F.substring(padded, power + 2, F.length(padded)))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), F.regexp_replace(digits, "0+$", ""))
    return F.when(~exact.contains("E"), exact).when(power > 0, large).otherwise(small)


def plain_number(value: Column | str) -> Column:
    """A double as text in plain notation, with all its digits; whole numbers keep ``.0``.

    From 1e16 on, and below 1e-4, the text is in scientific notation as SQL engines print it.
    """
    value = _col(value).cast("double")
    size, exact = F.abs(value), value.cast("string")
    power = F.regexp_extract(exact, r"E(-?[0-9]+)$", 1).try_cast("int")
    mantissa = F.regexp_replace(F.regexp_extract(exact, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    far = F.abs(power)
    digits = F.when(far < 10, F.concat(F.lit("0"), far)).otherwise(far.cast("string"))
    outside = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), digits)
    # Within these bounds 20 places hold every digit.
    places = F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    return (
        F.when(~exact.contains("E"), exact)
        .when((size >= 1e16) | (size < 1e-4), outside)
        .otherwise(F.regexp_replace(places, r"\.$", ".0")))


def point_label(lat: Column | str, long: Column | str) -> Column:
    """``{lat, long}``, numbers in plain notation."""
    return concat_nulls_empty(F.lit("{"), plain_number(lat), F.lit(", "), plain_number(long), F.lit("}"))


def slug(text: Column | str) -> Column:
    """``", "``, ``". "`` and blanks become hyphens."""
    return F.regexp_replace(_col(text), r", |\. | ", "-")


def require_certificate_type(cert_type: str) -> str:
    """The type itself, or ``ValueError``."""
    if cert_type not in CERTIFICATE_TYPES:
        raise ValueError(f"Invalid cert_type: {cert_type}; known are {CERTIFICATE_TYPES}")
    return cert_type


def bulk_archive_url(base_url: str, cert_type: str, code: Column, name: Column) -> Column:
    """C14: address of one authority's bulk archive."""
    return F.concat(
        F.lit(base_url), F.lit(require_certificate_type(cert_type)), F.lit("-"),
        _col(code), F.lit("-"), slug(name), F.lit(".zip"),
    )


def months_after(date: Column | str, months: int = 1) -> tuple[Column, Column]:
    """(year, month) of a date moved by whole months."""
    moved = F.add_months(_col(date), months)
    return F.year(moved), F.month(moved)
