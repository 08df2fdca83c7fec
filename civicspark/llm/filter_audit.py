"""How filters act together, for every order in which they can run (operator 12).

Each row has a mask of the filters it fails.  In an order of the filters the row is removed at
the first step whose filter is in its mask.  Orders are numbered by Lehmer rank, so all orders
with the same first filters are one interval of ranks: a mask is removed at a step by a filter
on the intervals of those prefixes that end with this filter and hold no other of the mask.
Counts per mask are added at the start of each interval and taken off at its end; one prefix
sum over the ranks then gives every order's removals.  Rows are counted once per mask, so what
follows the counts does not grow with the table.

Filters of ``documents``: A few words, B repeated words, C capitals, D symbols, E the text of a
smaller doc_id.  A null text is the empty one, a null language the part ''.  A row without a
doc_id is no copy and has no copies.  Of several rows of one doc_id and text none is a copy of
the other; each is counted.  A doc_id with several labels is good (or toxic) if one of them says
so.  Texts of any length are read whole, once.  An empty table has no parts and gives no rows.
Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILTERS = "ABCDE"
_WHITE = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions that look at one text alone."""
    words = F.array_remove(F.split(text, _WHITE), "")
    n_words = F.size(words)
    return {
        "A": n_words < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n_words,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_of(failures: dict[str, Column], filters: str = FILTERS) -> Column:
    """The failed filters as bits, the first filter's the lowest."""
    mask = F.lit(0)
    for bit, name in enumerate(filters):
        if name in failures:
            mask = mask + F.when(failures[name], 1 << bit).otherwise(0)
    return mask.cast("int")


def lehmer_rank(order: Sequence[int], n: int) -> int:
    """Lexicographic rank, among all orders of n, of the first one that begins like this."""
    return sum(
        sum(later not in order[:place] for later in range(item)) * factorial(n - 1 - place) for place, item in enumerate(order))


def _prefixes(n: int, first: tuple[int, ...] = ()) -> Iterator[tuple[int, ...]]:
    for item in range(n):
        if item not in first:
            yield (*first, item)
            yield from _prefixes(n, (*first, item))


def removal_intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, end): the ranks in which rows of this mask are removed at this step."""
    n, out = len(filters), []
    for prefix in _prefixes(n):
        start, wide = lehmer_rank(prefix, n), factorial(n - len(prefix))
        before = sum(1 << item for item in prefix[:-1])
        for mask in range(1, 1 << n):
            if mask >> prefix[-1] & 1 and not mask & before:
                out.append((mask, len(prefix), start, start + wide))
    return out


def documents_by_mask(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of documents, with one pass over the texts.

    What is shuffled is an id, a digest of the text and a few flags.  Rows are counted per
    (text, id) and then per text before copies meet, so a text that a third of all rows share
    is a handful of rows by then; only its copies' smallest id is needed.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        mask_of(text_failures(text)).alias("own"), F.unhex(F.sha2(text, 256)).alias("digest"))
    # Rows without an id have no labels; they are spread by their text over the join's partitions.
    salted = scanned.withColumn("salt", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("salt", F.lit(0).cast("bigint"))
    labelled = salted.join(said, ["doc_id", "salt"], "left").select(
        "doc_id", "part", "own", "digest", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")))
    kinds = ["digest", "own", "part", "good", "toxic"]
    by_id = labelled.groupBy("doc_id", *kinds).agg(F.count("*").alias("n"))
    by_text = by_id.groupBy(*kinds).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_first"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_unnamed"))
    is_first = F.col("first") == F.min("first").over(W.partitionBy("digest"))
    no_copy = F.col("n_unnamed") + F.when(is_first, F.col("n_first")).otherwise(0)
    copy_bit = 1 << FILTERS.index("E")
    split = by_text.withColumn("no_copy", no_copy).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("own").alias("mask"), F.col("no_copy").alias("n")),
            F.struct((F.col("own") + copy_bit).alias("mask"), (F.col("n") - F.col("no_copy")).alias("n")))).alias("m"))
    return split.where("m.n > 0").groupBy("part", "m.mask").agg(
        F.sum("m.n").alias("n"), *(F.sum(F.when(F.col(c), F.col("m.n")).otherwise(0)).alias(c) for c in ("good", "toxic")))


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts per (part, mask)."""
    spark, n = counts.sparkSession, len(filters)
    measures = ("n", "good", "toxic")
    # Both tables are fixed by the number of filters: n! * n orders' steps at most.
    intervals = spark.createDataFrame(removal_intervals(filters), "mask int, step int, start int, end int")
    orders = [(lehmer_rank(p, n), "".join(filters[i] for i in p)) for p in _prefixes(n) if len(p) == n]
    steps = spark.createDataFrame(
        [(rank, order, step + 1, letter, 1 << filters.index(letter)) for rank, order in orders for step, letter in enumerate(order)],
        "rank int, filter_order string, step int, filter string, bit int")
    ends = counts.join(F.broadcast(intervals), "mask").select("part", "step", F.explode(F.array(
        F.struct(F.col("start").alias("rank"), *(F.col(m).alias(m) for m in measures)),
        F.struct(F.col("end").alias("rank"), *((-F.col(m)).alias(m) for m in measures)))).alias("e"))
    differences = ends.groupBy("part", "step", "e.rank").agg(*(F.sum(f"e.{m}").alias(m) for m in measures))
    bits = F.array(*(F.lit(1 << k) for k in range(n)))
    of_part = counts.groupBy("part").agg(F.sum("n").alias("total"))
    of_filter = counts.withColumn("bit", F.explode(bits)).groupBy("part", "bit").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"))
    # Each part has every step of every order, also those where nothing is removed.
    grid = of_filter.join(F.broadcast(steps), "bit").join(of_part, "part")
    so_far = W.partitionBy("part", "step").orderBy("rank")
    removed = grid.join(differences, ["part", "step", "rank"], "left").withColumns(
        {m: F.coalesce(F.sum(m).over(so_far), F.lit(0)) for m in measures})
    earlier = W.partitionBy("part", "rank").orderBy("step")
    return removed.select(
        "part", "filter_order", "step", "filter",
        (F.col("total") - F.sum("n").over(earlier)).alias("kept"), F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(W.partitionBy("part", "filter")).alias("shapley"))


#: The same by plain enumeration, for engines that read the tables as views.
ORACLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents),
l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END)
        || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
        || (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
    FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
    SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
    FROM x a, x b, x c, x d, x e
    WHERE a.c NOT IN (b.c, c.c, d.c, e.c) AND b.c NOT IN (c.c, d.c, e.c) AND c.c NOT IN (d.c, e.c) AND d.c <> e.c),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS filter FROM o, range(1, 6) r(step)),
m AS (
    SELECT g.part, s.filter_order, s.step, s.filter, g.failed, g.n, g.good, g.toxic,
        contains(g.failed, s.filter) AS fails,
        contains(g.failed, s.filter) AND length(translate(s.filter_order[1:s.step - 1], g.failed, '')) = s.step - 1 AS gone,
        length(translate(s.filter_order[1:s.step], g.failed, '')) = s.step AS stays
    FROM g, s),
q AS (
    SELECT part, filter_order, step, filter,
        sum(CASE WHEN stays THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN failed = filter THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM m GROUP BY ALL)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM q
"""
