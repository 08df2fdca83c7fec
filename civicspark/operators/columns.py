"""Projections and column bookkeeping."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.operators.quality import require_columns


def ticked(name: str) -> str:
    """A literal column name as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by its literal name."""
    return F.col(ticked(name))


def select_layout(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """Project to a published layout, given as target name -> source column."""
    require_columns(df, layout.values())
    return df.selectExpr(
        *[f"{ticked(source)} AS {ticked(target)}" for target, source in layout.items()]
    )


def rename_strict(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; every old name must exist."""
    require_columns(df, names)
    return df.withColumnsRenamed(dict(names))


def drop_strict(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns but these; each of them must exist."""
    require_columns(df, names)
    return df.drop(*names)


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """All columns but these, where they exist."""
    return df.drop(*names)


def select_by_regex(df: DataFrame, pattern: str) -> DataFrame:
    """P5: the columns whose name contains a match of the pattern, in their order."""
    keep = [name for name in df.columns if re.search(pattern, name)]
    if not keep:
        raise ValueError(f"No column name matches {pattern!r}")
    return df.select([ticked(name) for name in keep])


def join_side_by_side(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    clash: str = "drop",
) -> DataFrame:
    """``left.*, right.*`` of an equi-join, given as (left column, right column) pairs.

    A right-hand column whose name is taken is left out (``clash="drop"``) or carries the
    first free suffix ``_1``, ``_2``... (``clash="suffix"``).
    """
    if clash not in ("drop", "suffix"):
        raise ValueError(f"clash must be 'drop' or 'suffix', not {clash!r}")
    require_columns(left, [l for l, _ in on])
    require_columns(right, [r for _, r in on])
    taken = {name.lower() for name in left.columns}
    names, hidden = {}, []
    for name in right.columns:
        final = name
        if name.lower() in taken and clash == "drop":
            final = f"__right_{name}"
            hidden.append(final)
        count = 0
        while final.lower() in taken:
            count += 1
            final = f"{name}_{count}"
        taken.add(final.lower())
        names[name] = final
    renamed = right.withColumnsRenamed({old: new for old, new in names.items() if old != new})
    key_names = {name.lower(): final for name, final in names.items()}
    condition = [quoted(l) == quoted(key_names[r.lower()]) for l, r in on]
    return left.join(renamed, condition, how).drop(*hidden)


def unnest(df: DataFrame, *structs: str, drop: Iterable[str] = ()) -> DataFrame:
    """Replace struct columns by their fields, dropping fields not wanted."""
    require_columns(df, structs)
    columns = [ticked(name) for name in df.columns if name not in structs]
    columns += [f"{ticked(name)}.*" for name in structs]
    return df.select(*columns).drop(*drop)


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Computed columns; a column of that name is overwritten, so it is idempotent."""
    return df.withColumns(dict(columns))


def add_chained(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Computed columns of which a later one may use an earlier one."""
    for name, column in steps:
        df = df.withColumn(name, column)
    return df
