"""Column-name rules (P7-P13).  Plain string functions: they see names, never rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

_DIGITS = re.compile(r"[0-9]")
_PIVOT_MARKS = re.compile(r'["{},]')
_TO_UNDERSCORE = re.compile(r"[ /:,?().\- ]")
_APOSTROPHES = re.compile("['’]")


def lower_name(name: str) -> str:
    """P7."""
    return name.lower()


def remove_numbers(name: str) -> str:
    """Lower-case, without its digits."""
    return _DIGITS.sub("", name.lower())


def upper_underscore(name: str) -> str:
    """P10: ``lmk-key`` -> ``LMK_KEY``."""
    return name.upper().replace("-", "_")


def hyphen_lower(name: str) -> str:
    """Inverse of :func:`upper_underscore`: the spelling used in landed pages."""
    return name.lower().replace("_", "-")


def space_underscore(name: str) -> str:
    """Blanks become underscores, lower-case."""
    return name.replace(" ", "_").lower()


def clean_column_name(name: str) -> str:
    """Unwrap a joint-pivot label.

    Names that start with ``lsoa`` pass; any other name loses its quotes, braces and
    commas and then its first two characters (the ``a.``-style domain letter).
    """
    if name.startswith("lsoa"):
        return name
    return _PIVOT_MARKS.sub("", name)[2:]


def snake_name(name: str, strip_underscores: bool = False) -> str:
    """Lower-case; punctuation to underscore; apostrophes dropped; runs collapsed."""
    out = _APOSTROPHES.sub("", _TO_UNDERSCORE.sub("_", name.lower()))
    if strip_underscores:
        out = out.strip("_")
    return re.sub("_+", "_", out)


def number_duplicates(names: Iterable[str]) -> list[str]:
    """Earlier duplicates get ``_1``, ``_2``...; the last one keeps the bare name."""
    out = list(names)
    present = Counter(out)
    handed_out: Counter[str] = Counter()
    for position, name in enumerate(out):
        if present[name] < 2:
            continue
        handed_out[name] += 1
        numbered = f"{name}_{handed_out[name]}"
        present[name] -= 1
        present[numbered] += 1
        out[position] = numbered
    return out


def get_rename_dict(
    df: DataFrame,
    remove_numbers_fn: Callable[[str], str] = remove_numbers,
    rm_numbers: bool = False,
) -> dict[str, str]:
    """Old name -> lower-case name, digits removed on request, duplicates numbered."""
    shape = (lambda n: remove_numbers_fn(n).lower()) if rm_numbers else str.lower
    return dict(zip(df.columns, number_duplicates(shape(n) for n in df.columns)))


def apply_names(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by a rule; two columns that end up alike are an error.

    Spark resolves names without case, so ``Col`` and ``col`` count as alike.
    """
    names = [rule(name) for name in df.columns]
    clashes = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if clashes:
        raise ValueError(f"Duplicate column names after renaming: {sorted(clashes)}")
    return df.toDF(*names)


def clean_names(df: DataFrame, strip_underscores: bool = False) -> DataFrame:
    """P12 over a whole frame."""
    return apply_names(df, lambda name: snake_name(name, strip_underscores))
