"""Row filters and unions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from civicspark.checks.registry import check, table
from civicspark.operators.filters import (
    Box, differs, flag_matching, in_box, in_codes, in_codes_of_first_column, in_months,
    latest_period, not_null,
)
from civicspark.operators.joins import enrich
from civicspark.operators.sets import (
    append_rows, first_rows_by, preview, table_counts, union_all,
)
from civicspark.streaming.periods import previous_month, three_months_back


@check("bbox_filter", """
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM {lineitem}
WHERE l_discount BETWEEN 0.02 AND 0.05 AND l_tax BETWEEN 0.01 AND 0.04
""")
def bbox_filter(spark, sf_dir):
    """inclusive on all edges."""
    box = Box(west=0.02, east=0.05, south=0.01, north=0.04)
    return in_box(table(spark, sf_dir, "lineitem"), box, "l_discount", "l_tax").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax"
    )


@check("not_equal_filter", """
SELECT o_orderkey, status FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status
    FROM {orders}) WHERE status <> 'F'
""")
def not_equal_filter(spark, sf_dir):
    """NULL is dropped too."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return differs(orders, "status", "F")


@check("latest_period", """
WITH o AS (SELECT o_orderkey, o_custkey, cast(year(o_orderdate) AS int) AS year FROM {orders})
SELECT * FROM o WHERE year = (SELECT max(year) FROM o) AND o_custkey IN
    (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'MACHINERY')
""")
def latest_period_then_codes(spark, sf_dir):
    """The latest year of all rows first, then the code filter."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")
    )
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'")
    return in_codes(latest_period(orders, "year"), "o_custkey", wanted.select("c_custkey"))


@check("not_null_filter", """
SELECT o.o_orderkey, c.c_name FROM {orders} o
LEFT JOIN (SELECT * FROM {customer} WHERE c_acctbal < 3000) c ON o.o_custkey = c.c_custkey
WHERE c.c_name IS NOT NULL
""")
def not_null_filter(spark, sf_dir):
    """F6."""
    poor = table(spark, sf_dir, "customer").where("c_acctbal < 3000").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return not_null(enrich(orders, poor, "o_custkey", "c_custkey"), "c_name").select(
        "o_orderkey", "c_name"
    )


@check("month_range", """
SELECT o_orderkey, o_totalprice FROM {orders}
WHERE year(o_orderdate) * 12 + month(o_orderdate) BETWEEN 1996 * 12 + 11 AND 1998 * 12 + 2
""")
def month_range(spark, sf_dir):
    """both end months included."""
    orders = in_months(table(spark, sf_dir, "orders"), "o_orderdate", (1996, 11), (1998, 2))
    return orders.select("o_orderkey", "o_totalprice")


@check("default_periods", """
SELECT o_orderkey, o_custkey FROM {orders}
WHERE year(o_orderdate) * 12 + month(o_orderdate) BETWEEN 1998 * 12 + 6 AND 1998 * 12 + 8
""")
def default_periods(spark, sf_dir):
    """From three months back to the previous month, as of a given day."""
    today = date(1998, 9, 15)
    orders = table(spark, sf_dir, "orders")
    return in_months(
        orders, "o_orderdate", three_months_back(today), previous_month(today)
    ).select("o_orderkey", "o_custkey")


@check("literal_code_list", """
SELECT event_id, event_type FROM {events} WHERE event_type IN ('click', 'error')
""")
def literal_code_list(spark, sf_dir):
    """F4 with a short literal list, which reaches the scan."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return in_codes(events, "event_type", ["click", "error"])


@check("first_code_column", """
SELECT o_orderkey, o_custkey AS ladcd FROM {orders}
WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_nationkey = 3)
""")
def first_code_column(spark, sf_dir):
    """the filter finds the column by candidate names."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("ladcd"))
    codes = table(spark, sf_dir, "customer").where("c_nationkey = 3").select("c_custkey")
    return in_codes_of_first_column(orders, ["LA Code", "ladcd"], codes)


@check("pattern_flag", """
SELECT doc_id, regexp_matches(text, '^The|[0-9]{3}|ation') AS hit FROM {documents}
""")
def pattern_flag(spark, sf_dir):
    """F8, C4 over whole texts."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return flag_matching(documents, "text", "^The|[0-9]{3}|ation", "hit").drop("text")


@check("union_widen", """
SELECT l_orderkey AS id, cast(l_linenumber AS double) AS amount FROM {lineitem}
UNION ALL SELECT o_orderkey, o_totalprice FROM {orders}
""")
def union_widen(spark, sf_dir):
    """Integers beside doubles become doubles."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("amount")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("id")
    )
    return union_all([lines, orders])


@check("append_row", """
SELECT s_suppkey, s_name, s_nationkey FROM {supplier}
UNION ALL SELECT 0, 'Supplier#000000000', 5 UNION ALL SELECT -1, 'extra', NULL
""")
def append_row(spark, sf_dir):
    """Constant rows are added even where the key is there already."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return append_rows(suppliers, [
        {"s_suppkey": 0, "s_name": "Supplier#000000000", "s_nationkey": 5},
        {"s_suppkey": -1, "s_name": "extra", "s_nationkey": None},
    ])


_COUNTED = (
    "customer", "documents", "events", "lineitem", "nation", "orders", "pages", "part",
    "region", "supplier",
)


@check("table_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {{{name}}}" for name in _COUNTED
))
def counts_of_tables(spark, sf_dir):
    """K7, A5, U4, O2."""
    return table_counts({name: table(spark, sf_dir, name) for name in _COUNTED})


@check("stable_sample", """
SELECT p_partkey, p_name, p_retailprice FROM {part}
ORDER BY p_retailprice DESC, p_partkey LIMIT 1000
""")
def stable_sample(spark, sf_dir):
    """O1, O2: a sample whose rows do not depend on partitioning."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return first_rows_by(parts, 1000, F.desc("p_retailprice"), "p_partkey")


@check("preview_size", "SELECT least(count(*), 500) AS n_rows FROM {orders}")
def preview_size(spark, sf_dir):
    """O3: the preview of a fixed size (its rows are any rows, so their number is checked)."""
    return preview(table(spark, sf_dir, "orders"), ["o_orderkey"], 500).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@check("preview_rows", """
SELECT p_partkey, p_name FROM {part} ORDER BY p_retailprice DESC, p_partkey LIMIT 500
""")
def preview_rows(spark, sf_dir):
    """O3, O2: a preview of an ordered frame, its rows and columns by value."""
    ordered = table(spark, sf_dir, "part").orderBy(F.desc("p_retailprice"), "p_partkey")
    return preview(ordered, ["p_partkey", "p_name"], 500)
