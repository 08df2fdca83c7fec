"""Duplicates, keys and lenient types."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.checks.registry import check, derive, table
from civicspark.operators.quality import (
    cast_to_schema, count_rows_of, distinct_by_key, distinct_rows, duplicate_keys,
    parse_date_if_text, require_columns, warn_if_empty,
)
from civicspark.operators.sets import union_all
from civicspark.session import scratch_path


@check("row_distinct", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM {lineitem}")
def row_distinct(spark, sf_dir):
    """Every row is there at least twice."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return distinct_rows(union_all([lines, lines]))


@check("key_distinct", """
SELECT doc_id, lang, source, n_chars, text FROM
    (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS nth FROM {documents})
WHERE nth = 1
""")
def key_distinct(spark, sf_dir):
    """The first document of each text."""
    return distinct_by_key(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@check("key_distinct_no_order", """
SELECT user_id, min(value) AS value FROM {events} GROUP BY user_id
""")
def key_distinct_no_order(spark, sf_dir):
    """D2 without an order: the other columns decide, whatever the partitioning."""
    return distinct_by_key(table(spark, sf_dir, "events").select("user_id", "value"), "user_id")


@check("duplicate_keys", """
SELECT user_id, event_type, count(*) AS count FROM
    (SELECT nullif(user_id, 3) AS user_id, event_type FROM {events})
WHERE user_id IS NOT NULL GROUP BY user_id, event_type HAVING count(*) > 1
""")
def duplicated_keys(spark, sf_dir):
    """NULL keys never count as duplicates."""
    events = table(spark, sf_dir, "events").select(
        F.nullif("user_id", F.lit(3)).alias("user_id"), "event_type"
    )
    return duplicate_keys(events, "user_id", "event_type")


@check("duplicate_texts", """
SELECT text, count(*) AS count FROM {documents} WHERE text IS NOT NULL
GROUP BY text HAVING count(*) > 1
""")
def duplicated_texts(spark, sf_dir):
    """D5 over whole texts."""
    return duplicate_keys(table(spark, sf_dir, "documents"), "text")


_MESSY = """SELECT event_id,
    CASE event_id % 4 WHEN 0 THEN substr(props, 7, 2) WHEN 1 THEN 'n/a'
        WHEN 2 THEN cast(event_id % 500 AS string) ELSE NULL END AS rating,
    CASE event_id % 3 WHEN 0 THEN cast(cast(ts AS date) AS string) WHEN 1 THEN '2024-13-40'
        ELSE '' END AS lodged,
    CASE event_id % 3 WHEN 0 THEN cast(event_id % 900 AS string) || '.25' ELSE 'x' END AS area
FROM {events}"""


@check("lenient_cast", f"""
SELECT event_id, try_cast(rating AS integer) AS rating,
    try_cast(area AS decimal(10,2)) AS area FROM ({_MESSY})
""", doubles=["area"])
def lenient_cast(spark, sf_dir):
    """What does not fit becomes NULL, the row stays."""
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("rating", T.IntegerType()),
        T.StructField("area", T.DecimalType(10, 2)),
    ])
    return cast_to_schema(derive(spark, sf_dir, _MESSY), schema)


@check("lenient_dates", f"SELECT event_id, try_cast(lodged AS date) AS lodged FROM ({_MESSY})", texts=["lodged"])
def lenient_dates(spark, sf_dir):
    """D7."""
    messy = derive(spark, sf_dir, _MESSY).select("event_id", "lodged")
    return parse_date_if_text(messy, "lodged")


@check("observed_filter", "SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'P'")
def observed_filter(spark, sf_dir):
    """A required-column check and a count that rides along with the action."""
    orders = table(spark, sf_dir, "orders")
    require_columns(orders, ["o_orderkey", "o_orderstatus"])
    partial, _ = count_rows_of(orders.where("o_orderstatus = 'P'"), "partial_orders")
    return partial.select("o_orderkey")


@check("observed_counts", """
SELECT o_orderstatus AS status, count(*) AS n_rows FROM {orders}
WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_orderstatus
UNION ALL SELECT 'none', 0
""")
def observed_counts(spark, sf_dir):
    """The counts that ride along with a write, and the warning of an empty frame."""
    orders = table(spark, sf_dir, "orders")
    counted = []
    for status in ("F", "O", "P", "none"):
        rows, seen = count_rows_of(orders.where(F.col("o_orderstatus") == status), f"orders_{status}")
        rows.select("o_orderkey").write.parquet(scratch_path(spark, "observed"))
        counted.append((status, warn_if_empty(seen, f"no orders of status {status}")))
    present = [c for c in counted if c[1] or c[0] == "none"]
    return spark.createDataFrame(present, "status string, n_rows bigint")
