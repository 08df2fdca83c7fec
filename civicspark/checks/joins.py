"""Joins, latest-per-key and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.checks.registry import check, table
from civicspark.operators.aggregates import (
    distinct_values, max_per_key, overall_max, ratio_of_sums, row_count, sums_per_key,
)
from civicspark.operators.columns import drop_strict, join_side_by_side
from civicspark.operators.filters import equals, in_codes
from civicspark.operators.joins import (
    enrich, enrich_dimension, latest_per_key, lookup_join, semi_join_codes,
)


@check("latest_per_key_ties", """
WITH e AS (SELECT event_id, user_id, event_type, value, cast(ts AS date) AS day FROM {events})
SELECT e.* FROM e JOIN (SELECT user_id, max(day) AS latest FROM e GROUP BY user_id) m
ON e.user_id = m.user_id AND e.day = m.latest
""", texts=["day"])
def latest_per_key_ties(spark, sf_dir):
    """All events of each user's last day."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("day")
    )
    return latest_per_key(events, "user_id", "day")


@check("latest_per_two_keys", """
WITH l AS (SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, l_quantity,
    cast(l_shipdate AS date) AS shipped FROM {lineitem})
SELECT l.* FROM l JOIN (SELECT l_partkey, l_returnflag, max(shipped) AS latest FROM l
    GROUP BY l_partkey, l_returnflag) m
ON l.l_partkey = m.l_partkey AND l.l_returnflag = m.l_returnflag AND l.shipped = m.latest
""", texts=["shipped"])
def latest_per_two_keys(spark, sf_dir):
    """J3 on a compound key."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity",
        F.col("l_shipdate").cast("date").alias("shipped"),
    )
    return latest_per_key(lines, ["l_partkey", "l_returnflag"], "shipped")


@check("enrich_left_chain", """
SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, c.c_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM {orders} o
LEFT JOIN (SELECT * FROM {customer} WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT * FROM {nation} WHERE n_nationkey <> 7) n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT * FROM {region} WHERE r_name <> 'ASIA') r ON n.n_regionkey = r.r_regionkey
""")
def enrich_left_chain(spark, sf_dir):
    """A chain of left joins with gaps at every link."""
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    nations = table(spark, sf_dir, "nation").where("n_nationkey <> 7")
    regions = table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    places = enrich_dimension(
        customers.select("c_custkey", "c_mktsegment", "c_nationkey"),
        [(nations, "c_nationkey", "n_nationkey"), (regions, "n_regionkey", "r_regionkey")],
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return enrich(orders, places, "o_custkey", "c_custkey").select(
        "o_orderkey", "o_custkey", "c_mktsegment", "c_nationkey", "n_name", "n_regionkey", "r_name"
    )


@check("inner_lookup", """
SELECT * EXCLUDE (n_nationkey, n_regionkey, c_nationkey)
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
""")
def inner_lookup(spark, sf_dir):
    """J1, P3."""
    joined = lookup_join(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
        "c_nationkey", "n_nationkey",
    )
    return drop_strict(joined, ["n_nationkey", "n_regionkey", "c_nationkey"])


@check("pruned_join", """
WITH rich AS (SELECT c_custkey, c_mktsegment FROM {customer} WHERE c_acctbal > 5000)
SELECT o_orderkey, o_totalprice, rich.c_custkey, rich.c_mktsegment
FROM {orders} JOIN rich ON o_custkey = rich.c_custkey
""")
def pruned_join(spark, sf_dir):
    """Join with a filtered, column-pruned side."""
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 5000")
    return lookup_join(
        table(spark, sf_dir, "orders"), rich.select("c_custkey", "c_mktsegment"),
        "o_custkey", "c_custkey",
    ).select("o_orderkey", "o_totalprice", "c_custkey", "c_mktsegment")


@check("semi_in_subquery", """
SELECT * FROM {customer} WHERE c_nationkey IN (SELECT n_nationkey FROM {nation}
    WHERE n_regionkey IN (SELECT r_regionkey FROM {region} WHERE r_name = 'EUROPE'))
""")
def semi_in_subquery(spark, sf_dir):
    """J5, F1."""
    europe = equals(table(spark, sf_dir, "region"), "r_name", "EUROPE").select("r_regionkey")
    nations = semi_join_codes(table(spark, sf_dir, "nation"), "n_regionkey", europe)
    return semi_join_codes(
        table(spark, sf_dir, "customer"), "c_nationkey", nations, "n_nationkey"
    )


@check("semi_code_list", """
SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_custkey IN
    (SELECT DISTINCT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING')
""")
def semi_code_list(spark, sf_dir):
    """J6, F4, A6."""
    wanted = equals(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return in_codes(orders, "o_custkey", distinct_values(wanted, "c_custkey"))


@check("side_by_side_suffix", """
SELECT a.l_orderkey AS okey, a.l_quantity AS qty, b.o_totalprice AS price, b.qty AS qty_1
FROM {lineitem} a JOIN (SELECT o_orderkey, o_totalprice, o_custkey AS qty FROM {orders}) b
ON a.l_orderkey = b.o_orderkey
""")
def side_by_side_suffix(spark, sf_dir):
    """The later of two equal names gets ``_1``."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("okey"), F.col("l_quantity").alias("qty")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("okey"), F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("qty"),
    )
    joined = join_side_by_side(lines, orders, [("okey", "okey")], clash="suffix")
    return drop_strict(joined, ["okey_1"])


@check("max_and_sums", """
SELECT s.l_suppkey, s.sum_qty, m.last_shipped
FROM (SELECT l_suppkey, cast(sum(cast(l_quantity AS decimal(12,2))) AS double) AS sum_qty
    FROM {lineitem} GROUP BY l_suppkey) s
JOIN (SELECT l_suppkey, max(cast(l_shipdate AS date)) AS last_shipped
    FROM {lineitem} GROUP BY l_suppkey) m ON s.l_suppkey = m.l_suppkey
""", texts=["last_shipped"])
def max_and_sums(spark, sf_dir):
    """A1, A2."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_quantity").cast("decimal(12,2)").alias("qty"),
        F.col("l_shipdate").cast("date").alias("shipped"),
    )
    sums = sums_per_key(lines, ["l_suppkey"], {"sum_qty": "qty"})
    latest = max_per_key(lines, "l_suppkey", "shipped", "last_shipped")
    return lookup_join(sums, latest, "l_suppkey", "l_suppkey").withColumn(
        "sum_qty", F.col("sum_qty").cast("double")
    )


@check("ratio_of_sums", """
SELECT r_name, o_orderstatus,
    cast(sum(cast(o_totalprice AS decimal(12,2))) AS double)
    / nullif(cast(sum(cast(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE c_acctbal END AS decimal(12,2))) AS double), 0)
    AS price_per_balance
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
GROUP BY r_name, o_orderstatus
""")
def ratio_of_sums_by_region(spark, sf_dir):
    """A2, A3: a ratio of sums per group; a zero denominator gives NULL."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("balance")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("price")
    )
    places = enrich_dimension(
        customers,
        [(table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey"),
         (table(spark, sf_dir, "region"), "n_regionkey", "r_regionkey")],
    )
    joined = lookup_join(
        orders, places.select("c_custkey", "balance", "r_name"), "o_custkey", "c_custkey"
    ).withColumn(
        "balance",
        F.when(F.col("o_orderstatus") == "P", F.lit(0)).otherwise(F.col("balance")).cast("decimal(12,2)"),
    )
    return ratio_of_sums(joined, ["r_name", "o_orderstatus"], "price", "balance", "price_per_balance")


@check("overall_max_and_count", """
SELECT max(l_extendedprice) AS dearest, count(*) AS n_rows FROM {lineitem}
""")
def overall_max_and_count(spark, sf_dir):
    """A4, A5: two one-row results side by side."""
    lines = table(spark, sf_dir, "lineitem")
    dearest = overall_max(lines, "l_extendedprice", "dearest").withColumn("one", F.lit(1))
    counted = row_count(lines).withColumn("one", F.lit(1))
    return lookup_join(dearest, counted, "one", "one").select("dearest", "n_rows")


@check("distinct_values", "SELECT DISTINCT o_custkey FROM {orders}")
def distinct_customers(spark, sf_dir):
    """A6."""
    return distinct_values(table(spark, sf_dir, "orders"), "o_custkey")
