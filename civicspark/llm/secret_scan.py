"""Secret scan with character Markov models (operator 4), in SQL functions throughout.

Fixed patterns give the base spans.  Beside them, every long token is scored by two first-order
Markov models of its characters, one of random strings and one of ordinary identifiers; a token
whose mean log-likelihood ratio per transition exceeds a threshold is a ``random`` span, unless
it overlaps a base span.

Both models are trained from labelled samples: random strings made from hashes against words of
the corpus, taken from the ``sample_texts`` distinct texts with the smallest hashes, and decimals,
times, identifiers, UUIDs and paths with digits, made from hashes.  Nothing else is sampled: every
text is scanned whole, in time that grows with its length and its number of spans.

Null and empty texts have no spans.  Every row gives one row, repeated rows included; other
columns, clashing names included, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm.spans import SPAN, apart_from, blocks, joined, let, matches, piece, rest, running

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
SAMPLE_TEXTS, RANDOM_STRINGS, SHORTEST, THRESHOLD = 2000, 3000, 20, 0.6

#: The patterns of the base spans.  A shorter hex or access run can hold no match
#: of its own, so their least lengths stand in the patterns; ``assign`` is filtered afterwards,
#: because a short match also uses up its text.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
TOKEN = f"[A-Za-z0-9+/_-]{{{SHORTEST},}}"


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds by start, then kind."""
    assign = F.filter(matches(text, ASSIGN, "assign", 0), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    access = matches(text, ACCESS, "access", 1, text.contains("AKIA"))
    return F.sort_array(F.concat(assign, access, matches(text, HEX, "hex", 2)))


def random_strings(spark: SparkSession, n: int = RANDOM_STRINGS) -> DataFrame:
    """Labelled sample of random strings: hex in either case, base64 and upper-case keys."""
    raw = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    b64 = F.regexp_replace(F.base64(F.unhex("h")), "=", "")
    return raw.select(F.explode(F.array(F.col("h"), F.upper("h"), b64, b64, F.translate(b64, "+/", "-_"),
                                        F.regexp_replace(F.upper(b64), "[^A-Z0-9]", ""))).alias("value"))


def ordinary_words(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """Labelled sample of ordinary identifiers: words without digits of a bounded set of texts, and paths of them."""
    hashed = docs.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("h"))
    cut = hashed.select("h").distinct().orderBy("h").limit(sample_texts).agg(F.max("h")).first()[0]
    texts = hashed.where(F.col("h") <= F.lit(cut).cast("bigint")).dropDuplicates(["h"])
    words = F.regexp_extract_all("text", F.lit("(?<![A-Za-z0-9+/_-])[A-Za-z][A-Za-z_-]{2,}(?![A-Za-z0-9+/_-])"), 0)
    return texts.select(words.alias("w")).select(F.explode(F.concat("w", F.array(F.array_join("w", "/")))).alias("value"))


def ordinary_numbers(spark: SparkSession, n: int = RANDOM_STRINGS) -> DataFrame:
    """Labelled sample of ordinary tokens with digits, made from hashes: decimals, times, identifiers, paths."""
    number = F.conv(F.substring(F.sha2(F.col("id").cast("string"), 224), 1, 15), 16, 10)
    made = spark.range(n).select(
        "id", number.alias("number"), F.sha2(F.col("id").cast("string"), 384).alias("h"),
        F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(2_000_000_000))).alias("at"))
    part = lambda first, n: F.substring("h", first, n)
    digits = F.concat("number", F.reverse("number"))
    return made.select(F.explode(F.array(
        digits, digits, F.date_format("at", "yyyyMMddHHmmssSSSSSS"), F.date_format("at", "yyyy-MM-dd-HH-mm-ss"),
        # Lower-case hexadecimal alone is random, so these are fewer.
        F.when(F.col("id") % 4 < 3, F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("4"), part(14, 3)), part(17, 4), part(21, 12))),
        F.concat(F.lit("order-item-"), F.substring("number", 1, 9), F.lit("-version-2")),
        F.concat(F.lit("/home/user/data/"), F.date_format("at", "yyyy/MM/dd"), F.lit("/part-0000"), F.substring("number", 1, 2)),
        F.concat(F.lit("INVOICE-"), F.date_format("at", "yyyyMMdd"), F.lit("-"), F.substring("number", 1, 8)))).alias("value")).where("value IS NOT NULL")


def transition_counts(samples: DataFrame) -> dict[tuple[str, str], int]:
    """Counts of neighbouring symbols; there are at most as many rows as pairs of symbols."""
    chars = samples.where(F.length("value") >= 2).select(F.split("value", "").alias("c"))
    pairs = F.arrays_zip(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1))
    counts = chars.select(F.explode(F.transform(pairs, lambda p: F.concat(p["0"], p["1"]))).alias("pair")).groupBy("pair").count()
    return {(r["pair"][0], r["pair"][1]): r["count"] for r in counts.collect()}


def log_ratios(random: dict, ordinary: dict, smooth: float = 0.5) -> list[float]:
    """log P(next | previous, random) - log P(next | previous, ordinary), row by row."""

    def logs(counts: dict) -> list[list[float]]:
        rows = [[counts.get((a, b), 0) + smooth for b in SYMBOLS] for a in SYMBOLS]
        return [[log(x / sum(row)) for x in row] for row in rows]

    return [p - q for r, o in zip(logs(random), logs(ordinary), strict=True) for p, q in zip(r, o, strict=True)]


def train(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> list[float]:
    ordinary = ordinary_words(docs, sample_texts).unionByName(ordinary_numbers(docs.sparkSession))
    return log_ratios(transition_counts(random_strings(docs.sparkSession)), transition_counts(ordinary))


def mean_ratio(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the transitions of a token made of ``SYMBOLS``."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")  # folded to a constant

    def add(state: Column, char: Column) -> Column:
        code = F.instr(F.lit(SYMBOLS), char) - 1
        step = F.when(state["last"] >= 0, F.get(table, state["last"] * len(SYMBOLS) + code)).otherwise(0.0)
        return F.struct(code.alias("last"), (state["total"] + step).alias("total"))

    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("total"))
    return F.aggregate(F.split(value, ""), start, add, lambda s: s["total"]) / (F.length(value) - 1)


def scan(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """The documents' columns plus ``base`` and ``secrets``: arrays of spans by start and kind."""
    text = F.col("text")
    found = docs.withColumn("base", base_spans(text)).withColumn("_tokens", matches(text, TOKEN, "random", 3))
    random = F.filter(apart_from(F.col("_tokens"), F.col("base")), lambda s: mean_ratio(s["value"], ratios) > threshold)
    return found.withColumn("secrets", F.sort_array(F.concat("base", random.cast(SPAN)))).drop("_tokens")


def masked(text: Column, spans: Column) -> Column:
    """The text with every secret replaced by its kind in brackets; overlaps are merged."""

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        kept = F.struct(at.alias("start"), s["start"].alias("end"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("name"))
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, kept)

    def filled(parts: Column) -> Column:
        end = F.array(F.struct(F.lit(2**31 - 1).alias("start"), F.lit(2**31 - 1).alias("kind_no"), F.lit(2**31 - 1).alias("end"),
                               F.lit("").alias("kind"), F.lit("").alias("value")))
        gaps = running(F.concat(spans, end), F.lit(0), step, "struct<start:int,end:int,name:string>")
        return F.array_join(F.transform(F.filter(gaps, lambda g: g.isNotNull()), lambda g: F.when(
            g["end"] < 2**31 - 1, F.concat(piece(parts, g["start"], g["end"]), g["name"])).otherwise(rest(parts, g["start"]))), "")

    return F.when(F.size(spans) > 0, let(blocks(text), filled)).otherwise(text)


def secret_digests(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Counts, digest of the base spans, and all spans of each document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scan(docs.select("doc_id", "text"), ratios).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
