"""Language identification by a byte convolutional network (operator 8).

Windows of 256 bytes; byte embeddings; filters of widths 2, 3 and 4; the largest response of
each filter over the window; softmax.  The network is trained in numpy on the driver from a
bounded sample of labelled rows (``per_language`` distinct texts of each language,
``per_document`` windows of each, both parameters) and applied to all windows of every text in batches.  A
document's probabilities are the normalised mean of its windows' log-probabilities.

A text that is null or holds no letter is ``und`` with score 0, and so is every text when
there is no labelled row at all.  Rows come out as often as they come in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicspark.llm.support import ship

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 8, 8
BLOCK = 128  # windows computed at once
PER_LANGUAGE, PER_DOCUMENT, ROUNDS = 500, 4, 6
_LETTER = regex.compile(r"\p{L}")


def windows_of(raw: bytes) -> np.ndarray:
    """All windows of a text; the last one is filled up with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class ByteNet:
    """The network: embedding, filters by width, and a linear layer over pooled responses."""

    def __init__(self, languages: list[str], seed: int = 8):
        draw = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"embed": draw.standard_normal((256, EMBED)) * 0.5,
                  "out": draw.standard_normal((len(WIDTHS) * FILTERS, len(languages))) * 0.1,
                  "bias": np.zeros(len(languages))}
        for w in WIDTHS:
            self.p[f"f{w}"] = draw.standard_normal((w, EMBED, FILTERS)) / np.sqrt(w * EMBED)
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.tables: dict[int, list[np.ndarray]] = {}

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over windows ``x``."""
        p, n = self.p, len(x)
        e = p["embed"][x]
        pooled, where = [], []
        for w in WIDTHS:
            t = WINDOW - w + 1
            r = sum(e[:, j : j + t] @ p[f"f{w}"][j] for j in range(w)) + p[f"b{w}"]
            best = r.argmax(1)
            where.append(best)
            pooled.append(np.take_along_axis(r, best[:, None], 1)[:, 0])
        raw = np.concatenate(pooled, 1)
        h = np.maximum(raw, 0)
        z = h @ p["out"] + p["bias"]
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        z[np.arange(n), y] -= 1
        z /= n
        g = {"out": h.T @ z, "bias": z.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (z @ p["out"].T) * (raw > 0)
        for k, w in enumerate(WIDTHS):  # only the window position of the maximum learns
            d = back[:, k * FILTERS : (k + 1) * FILTERS]
            g[f"b{w}"], g[f"f{w}"] = d.sum(0), np.zeros_like(p[f"f{w}"])
            for j in range(w):
                at = where[k] + j
                seen = e[np.arange(n)[:, None], at]
                g[f"f{w}"][j] = np.einsum("nfe,nf->ef", seen, d)
                np.add.at(g["embed"], x[np.arange(n)[:, None], at], d[:, :, None] * p[f"f{w}"][j].T[None])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, batch: int = 128, rate: float = 0.01) -> ByteNet:
        draw = np.random.default_rng(1)
        m, v, t = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for _ in range(rounds):
            order = draw.permutation(len(x))
            for start in range(0, len(x), batch):
                pick = order[start : start + batch]
                t += 1
                for k, g in self.step(x[pick], y[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        return self

    def compile(self) -> ByteNet:
        """Bytes are few, so filters become tables: response = sum of rows of byte pairs."""
        one = {w: [self.p["embed"] @ self.p[f"f{w}"][j] for j in range(w)] for w in WIDTHS}
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        self.tables = {w: [pair(*t[:2])] + ([pair(*t[2:])] if w == 4 else t[2:]) for w, t in one.items()}
        return self

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        wide = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        pooled = []
        for w in WIDTHS:
            t = WINDOW - w + 1
            r = self.tables[w][0][wide[:, :t]]
            if w == 3:
                r += self.tables[w][1][x[:, 2 : 2 + t]]
            elif w == 4:
                r += self.tables[w][1][wide[:, 2 : 2 + t]]
            pooled.append(r.max(1) + self.p[f"b{w}"])
        z = np.maximum(np.concatenate(pooled, 1), 0) @ self.p["out"] + self.p["bias"]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE, per_document: int = PER_DOCUMENT, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, h and windows w of the ``per_language`` distinct texts of smallest hash of each language.

    Copies of a text count once, so neither they nor the hottest text take another's place.
    Distinct texts are counted roughly first, and only a share of each language with about twice
    ``per_language`` of them is cut into windows; the exact cut follows.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND text <> '' AND lang IS NOT NULL")
    rows = rows.withColumn("id", F.xxhash64("text")).withColumn("h", F.pmod("id", F.lit(1 << 40)))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")).collect()}
    share = {k: 2.0 * per_language / max(1, n) for k, n in counts.items()}
    below = F.create_map(*[F.lit(v) for k in sorted(share) for v in (k, min(1.0, share[k]) * float(1 << 40))])
    taken = rows.where(F.col("h") < below[F.col("lang")]) if counts else rows
    kinds = pa.schema([("lang", pa.string()), ("id", pa.int64()), ("h", pa.int64()), ("w", pa.binary())])

    def cut(batches):
        seen = set()  # of this task; about twice per_language a language
        for batch in batches:
            made = []
            for k, key in enumerate(zip(*(batch.column(n).to_pylist() for n in (1, 2, 3)), strict=True)):
                if key in seen:
                    continue
                seen.add(key)
                w = windows_of(batch.column(0)[k].as_py().encode("utf-8", "surrogatepass"))
                at = np.unique(np.linspace(0, len(w) - 1, per_document).round().astype(int))
                made.append((*key, w[at].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds.types, strict=True)], schema=kinds) if made else pa.RecordBatch.from_pylist([], kinds)

    cuts = taken.select("text", "lang", "id", "h").mapInArrow(cut, "lang string, id bigint, h bigint, w binary")
    once = cuts.groupBy("lang", "id", "h").agg(F.min("w").alias("w"))
    place = F.row_number().over(W.partitionBy("lang").orderBy("h", "id"))
    return once.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "h", "w")


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, per_document: int = PER_DOCUMENT, text: str = "text", lang: str = "lang") -> ByteNet | None:
    """Fit on a bounded sample of each language; None if no row has both a text and a language."""
    found: dict[str, list] = {}
    for r in sample(labelled, per_language, per_document, text, lang).collect():
        found.setdefault(r["lang"], []).append((r["h"], bytes(r["w"])))
    languages = sorted(found)
    x, y = [], []
    for k, language in enumerate(languages):
        for _, w in sorted(found[language]):
            part = np.frombuffer(w, np.uint8).reshape(-1, WINDOW)
            x.append(part)
            y += [k] * len(part)
    if not x:
        return None
    return ByteNet(languages).fit(np.concatenate(x), np.array(y)).compile()


def predict(docs: DataFrame, net: ByteNet | None, text: str = "text") -> DataFrame:
    """The documents' columns plus ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(net)  # a few hundred kB of parameters
    taken = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*taken).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        net = model.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))  # made one at a time below
            totals: dict[int, list] = {}

            def settle(owners, parts):
                logs = np.concatenate([net.log_probabilities(w[i : i + BLOCK]) for w in [np.concatenate(parts)] for i in range(0, len(w), BLOCK)])
                at = 0
                for k, part in zip(owners, parts, strict=True):
                    sums = totals.setdefault(k, [0.0, 0])
                    sums[0] += logs[at : at + len(part)].sum(0)
                    sums[1] += len(part)
                    at += len(part)

            owners, parts, waiting = [], [], 0
            for k, body in enumerate(value.as_py() for value in texts):
                if net is None or not body or not _LETTER.search(body):
                    continue
                owners.append(k)
                parts.append(windows_of(body.encode("utf-8", "surrogatepass")))
                waiting += len(parts[-1])
                if waiting >= 8 * BLOCK:
                    settle(owners, parts)
                    owners, parts, waiting = [], [], 0
            if owners:
                settle(owners, parts)
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            for k, (total, n) in totals.items():
                q = np.exp((total - total.max()) / n)
                names[k], scores[k] = net.languages[int(q.argmax())], float(q.max() / q.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*taken, "lang_pred", "score"],
            )

    return docs.select(*taken).mapInArrow(run, schema)
