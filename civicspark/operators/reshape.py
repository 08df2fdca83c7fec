"""Pivot and unpivot."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions.names import apply_names, clean_column_name, snake_name
from civicspark.operators.columns import quoted
from civicspark.operators.quality import require_columns


def pivot_unique(
    df: DataFrame,
    index: Sequence[str],
    on: str,
    values: str,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Long to wide without aggregation, in one shuffle.

    A cell that two rows claim is an error when the result is computed, and so is a label that
    is not listed.  Pass the labels to spare the job that looks them up; labels become columns,
    so there are few of them.
    """
    require_columns(df, [*index, on, values])
    if labels is None:
        found = df.select(quoted(on).alias("label")).distinct().orderBy("label")
        labels = [r["label"] for r in found.collect()]
    label, value = quoted(on), quoted(values)
    hit = [label.eqNullSafe(F.lit(x)) for x in labels]
    known = hit[0] if hit else F.lit(False)
    for h in hit[1:]:
        known = known | h
    cells = df.groupBy(*[quoted(i) for i in index]).agg(
        *[F.max(F.when(h, value)).alias(f"__v{k}") for k, h in enumerate(hit)],
        *[F.count(F.when(h, 1)).alias(f"__n{k}") for k, h in enumerate(hit)],
        F.max(F.when(~known, label.cast("string"))).alias("__unlisted"),
    )
    failed = lambda text, x: F.raise_error(F.concat(F.lit(text), x)).cast(df.schema[values].dataType)
    columns = [
        F.when(F.col("__unlisted").isNotNull(), failed("pivot: unlisted label ", F.col("__unlisted")))
        .when(F.col(f"__n{k}") > 1, failed("pivot: more than one value for label ", F.lit(str(x))))
        .otherwise(F.col(f"__v{k}")).alias("null" if x is None else str(x))
        for k, x in enumerate(labels)
    ]
    return cells.select(*[quoted(i) for i in index], *columns)


def joint_label(*values) -> str:
    """Label of a joint pivot: ``{"first","second"}``."""
    return "{" + ",".join(f'"{value}"' for value in values) + "}"


def pivot_joint(
    df: DataFrame,
    index: Sequence[str],
    on: Sequence[str],
    values: str,
    labels: Sequence[Sequence[str]] | None = None,
    name_rule: Callable[[str], str] | None = None,
) -> DataFrame:
    """R2: pivot on several columns at once; each pair of values that occurs is a column."""
    require_columns(df, on)
    parts = [F.concat(F.lit('"'), quoted(c).cast("string"), F.lit('"')) for c in on]
    label = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    joint = [joint_label(*pair) for pair in labels] if labels else None
    wide = pivot_unique(df.withColumn("__joint", label), index, "__joint", values, joint)
    return apply_names(wide, name_rule) if name_rule else wide


def indicator_name(label: str) -> str:
    """Published name of a joint label: cleaned, unwrapped, cleaned again."""
    return snake_name(clean_column_name(snake_name(label, True)), True)


def unpivot_not_null(
    df: DataFrame,
    keep: Sequence[str],
    name: str,
    value: str,
    columns: Sequence[str] | None = None,
    value_type: str | None = None,
) -> DataFrame:
    """All columns but the kept ones to (name, value) rows; NULL values give no row."""
    require_columns(df, keep)
    held = {k.lower() for k in keep}
    columns = list(columns or [c for c in df.columns if c.lower() not in held])
    require_columns(df, columns)
    if value_type:
        df = df.withColumns({c: quoted(c).cast(value_type) for c in columns})
    long = df.unpivot([quoted(k) for k in keep], [quoted(c) for c in columns], name, value)
    return long.where(quoted(value).isNotNull())
