"""Personal data (operator 5), in SQL functions throughout.

Patterns propose spans, checks confirm them (Luhn for cards, mod 97 for account numbers, ranges
for addresses and digit counts), and context words nearby adjust each span's score.  The four
base kinds always stay.  Added kinds: ``iban`` (confirmed by mod 97) and ``local``, a national
telephone number that only a context word makes certain enough; neither may overlap another.

Null and empty texts have no spans.  Every row gives one row, repeated rows included; other
columns, clashing names included, are ignored.  An empty table gives an empty result.  A long text
takes time in proportion to its length and its number of spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.spans import SPAN, apart_from, blocks, joined, matches, piece

KINDS = ("email", "ip", "card", "phone", "iban", "local")
ACCEPT = 0.6
#: A run is tried from its first character, or from where the last match ended, not from within:
#: the result is the same and the time stays linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
LOCAL = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"
#: Score of a confirmed span of each kind, and the words nearby that raise it.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local": 0.4}
CONTEXT = {
    "email": "mail|contact|write to|schreib|écri|correo", "ip": r"\bip\b|address|server|host|login",
    "card": r"card|credit|visa|payment|karte|carte|tarjeta", "phone": r"phone|call|\btel|mobile|fax|appel|llam|anruf",
    "iban": r"iban|account|bank|konto|compte|cuenta", "local": r"phone|call|\btel|mobile|fax|appel|llam|anruf",
}
BONUS, BEFORE, AFTER = 0.2, 48, 24
_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a digit string passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number, blanks removed, passes the mod-97 check."""
    compact = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        v = F.instr(F.lit(_LETTERS), F.substring(turned, i, F.lit(1))) - 1
        return (rest * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def small_parts(value: Column) -> Column:
    """Whether every part of a dotted number is at most 255."""
    return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.ltrim(p, F.lit("0"))).cast("int"), F.lit(0)) <= 255))


def base_spans(text: Column) -> Column:
    """Confirmed spans of the four base kinds by kind, then start."""
    email = matches(text, EMAIL, "email", 0, text.contains("@"))
    ip = F.filter(matches(text, IP, "ip", 1), lambda s: small_parts(s["value"]))
    card = F.filter(matches(text, CARD, "card", 2), lambda s: F.length(digits(s["value"])).between(13, 19) & luhn(digits(s["value"])))
    phone = F.filter(matches(text, PHONE, "phone", 3, text.contains("+")), lambda s: F.length(digits(s["value"])).between(9, 15))
    return F.concat(email, ip, card, phone)


def score(parts: Column, span: Column) -> Column:
    """Score of a span of a text cut into blocks: by its kind, raised by context words nearby."""
    first = F.greatest(span["start"] - BEFORE, F.lit(0))
    near = F.lower(F.concat_ws(" ", piece(parts, first, span["start"]), piece(parts, span["end"], span["end"] + AFTER)))
    total = F.lit(0.0)
    for kind in KINDS:
        total = F.when(span["kind"] == kind, SCORES[kind] + F.when(near.rlike(CONTEXT[kind]), BONUS).otherwise(0.0)).otherwise(total)
    return total


def scan(docs: DataFrame) -> DataFrame:
    """The documents' columns plus ``base`` and ``pii`` spans, and ``scores`` beside ``pii``."""
    text = F.col("text")
    proposed = (
        docs.withColumn("base", base_spans(text))
        .withColumn("_iban", F.filter(matches(text, IBAN, "iban", 4), lambda s: mod97(s["value"])))
        .withColumn("_local", matches(text, LOCAL, "local", 5)))
    # Without a span there is nothing to look up, so the text is not cut.
    spanned = F.size("base") + F.size("_iban") + F.size("_local") > 0
    proposed = proposed.withColumn("_blocks", F.when(spanned, blocks(text)))
    iban = apart_from(F.col("_iban"), F.col("base"))
    local = F.filter(apart_from(F.col("_local"), F.concat("base", "_iban")), lambda s: score(F.col("_blocks"), s) >= ACCEPT)
    return (
        proposed.withColumn("pii", F.concat("base", iban.cast(SPAN), local.cast(SPAN)))
        .withColumn("scores", F.transform("pii", lambda s: F.round(score(F.col("_blocks"), s), 2)))
        .drop("_iban", "_local", "_blocks"))


def pii_digests(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, all spans and their scores of each document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", *(count(k) for k in KINDS[:4]), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"), F.array_join(F.transform("scores", lambda x: x.cast("string")), ",").alias("scores"))
