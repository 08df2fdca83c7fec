"""Hard negatives by threshold joins over an inverted index (operator 11).

Vectors become integers, ``floor(256 * x)``.  An anchor's positives are its best rows of the same
label; the negatives of a positive are the best rows of other labels whose score lies in a
window below the positive's.  Both are found by threshold joins.  A window starts with a high
threshold; while it holds fewer rows than wanted the threshold is lowered, down to the window's
own lower end.  Windows that are full leave the next round.

Within a join, rows lie in blocks.  A block's index holds a row's values dimension by
dimension, the strongest first, and leaves out its last dimensions where their norm and the
anchors' are too small to reach any threshold.  Partial scores are added up from the index; a
row is dropped once no anchor's partial score and remaining norms reach its threshold, a pair
likewise at the end, and what an unindexed rest may add is then computed exactly.  Full windows
raise an anchor's threshold to its k-th score while a task goes through its blocks.

Anchors meet the blocks in chunks of ``CHUNK``: copied to the executors while they are few
(counted), else both sides are shuffled by chunk and stripe.  A task sends at most k rows per
window, so what is shuffled does not grow with the pairs.

Rows with a null id, label, vector or component, or with a non-finite one, take no part; a
shorter vector counts as filled up with zeros.  Every row stands for itself: repeated rows are
separate anchors and candidates, and a row is only kept from being its own positive.  Ties go
to the smaller vec_id.  Scores are exact; one beyond a long is the nearest long.  Without
anchors, positives or negatives, as for an empty table, there are no rows.  Other columns may
have any name.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicspark.llm.blocks import stacked, vectors_of
from civicspark.llm.support import join_small, pinned, ship

#: Rows of a block, anchors of a chunk, anchors scored together, dimensions added up at once,
#: anchors that may be copied to the executors, and how much wider a window's band gets.
BLOCK, CHUNK, TILE, SLAB, COPIED, WIDER = 4096, 8192, 1024, 16, 16_384, 16
SCALE = 256
_LONG = np.iinfo(np.int64)
_BLOCKS = "block bigint, ids binary, labels binary, asked binary, matrix binary, kind string, width int, n int, norm double"
_ANCHOR = "a_block bigint, a_row int, anchor_id bigint, label bigint, vector binary, norm double"
_HITS = "a_block bigint, a_row int, slot int, block bigint, row int, vec_id bigint, score bigint"
_PLACE = ["a_block", "a_row"]


def packed(matrix: np.ndarray) -> tuple[str, bytes]:
    """Integers as two bytes each where they fit, as doubles otherwise."""
    kind = "int16" if np.abs(matrix).max(initial=0) < 2**15 else "float64"
    return kind, matrix.astype(kind).tobytes()


def unpacked(raw: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(n, -1 if raw else 0).astype(np.float64)


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def _block_rows(batches, size: int):
    """Blocks of the rows of a partition, in the order they come."""
    held: list[tuple] = []

    def close():
        matrix = stacked([v for *_, v in held])
        kind, raw = packed(matrix)
        ids, labels, asked = (np.array([h[i] for h in held], t).tobytes() for i, t in enumerate((np.int64, np.int64, np.bool_)))
        out = {"block": 0, "ids": ids, "labels": labels, "asked": asked, "matrix": raw, "kind": kind, "width": matrix.shape[1],
               "n": len(held), "norm": float(np.sqrt((matrix**2).sum(1)).max())}
        held.clear()
        return out

    names = [part.split()[0] for part in _BLOCKS.split(", ")]
    kinds = [pa.int64(), *[pa.binary()] * 4, pa.string(), pa.int32(), pa.int32(), pa.float64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    for batch in batches:
        ids, labels, asked = (batch.column(i).to_pylist() for i in range(3))
        for key, label, query, vector in zip(ids, labels, asked, vectors_of(batch.column(3)), strict=True):
            if vector is not None:
                held.append((key, label, query, np.floor(SCALE * vector)))
                if len(held) == size:
                    yield pa.RecordBatch.from_pylist([close()], schema)
    if held:
        yield pa.RecordBatch.from_pylist([close()], schema)


def make_blocks(vectors: DataFrame, is_anchor: Column, size: int = BLOCK) -> DataFrame:
    """Blocks of the rows that take part; nothing is shuffled for them."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"), "embedding").where("vec_id IS NOT NULL AND label IS NOT NULL")
    return rows.mapInArrow(lambda b: _block_rows(b, size), _BLOCKS).withColumn("block", F.monotonically_increasing_id())


def anchors_of(blocks: DataFrame) -> DataFrame:
    """The rows that ask, each with its place."""

    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                places = np.flatnonzero(np.frombuffer(x["asked"], np.bool_))
                if not len(places):
                    continue
                matrix = unpacked(x["matrix"], x["kind"], x["n"])[places]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x["block"]] * len(places), pa.int64()), pa.array(places, pa.int32()),
                    pa.array(np.frombuffer(x["ids"], np.int64)[places]), pa.array(np.frombuffer(x["labels"], np.int64)[places]),
                    pa.array([v.tobytes() for v in matrix], pa.binary()), pa.array(np.sqrt((matrix**2).sum(1)))],
                    names=[part.split()[0] for part in _ANCHOR.split(", ")])

    return blocks.mapInArrow(run, _ANCHOR)


def exact_scores(q: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All integer inner products, in the narrowest arithmetic that holds every sum exactly."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, q.shape[1])
    if most < 2**24:
        return (q.astype(np.float32) @ y.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (q @ y.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q).dot(whole(y).T), _LONG.min + 1, _LONG.max).astype(np.int64)


def rest_norms(m: np.ndarray) -> np.ndarray:
    """Norm of what is left of each row from every dimension on; the last is zero."""
    squares = np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.pad(squares, ((0, 0), (0, 1))))


def reaching(q: np.ndarray, y: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of y, score) of all pairs whose score is at least that of the row of q."""
    d = q.shape[1]
    most = float(np.abs(q).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, d)
    if most >= 2**53 or d == 0 or least.min(initial=0) < -most - 1:
        scores = exact_scores(q, y)
        i, j = np.nonzero(scores >= least[:, None])
        return i, j, scores[i, j]
    kind = np.float32 if most < 2**24 else np.float64
    order = np.argsort(-(y * y).sum(0), kind="stable")
    q, y = q[:, order], y[:, order]
    q_rest, y_rest = rest_norms(q), rest_norms(y)
    low = least.astype(np.float64)[:, None] - 1  # bounds are rounded; what is close to them stays
    slack = 1 + 1e-5
    # The index of a row ends where its rest cannot reach the lowest threshold with any anchor.
    end = np.minimum((q_rest.max(0) * y_rest * slack >= low.min()).sum(1), d)
    index = np.where(np.arange(d) < end[:, None], y, 0).astype(kind)
    live = np.flatnonzero(end > 0) if low.min() > 0 else np.arange(len(y))
    narrow, partial = q.astype(kind), np.zeros((len(q), len(live)), kind)
    rest = partial
    for first in range(0, d, SLAB):
        last = min(first + SLAB, d)
        held = first + np.flatnonzero(index[live, first:last].any(0))  # dimensions that have postings
        partial += narrow[:, held] @ index[np.ix_(live, held)].T
        seen = np.minimum(last, end[live])
        rest = q_rest[:, seen] * y_rest[live, seen] * slack
        keep = (partial + rest >= low).any(0)
        if not keep.all():
            live, partial, rest = live[keep], partial[:, keep], rest[:, keep]
    i, k = np.nonzero(partial + rest >= low)
    j = live[k]
    scores = np.rint(partial[i, k]).astype(np.int64)
    open_ends = np.flatnonzero(end[j] < d)
    for part in np.array_split(open_ends, max(1, len(open_ends) // 65536)):
        scores[part] = (q[i[part]] * y[j[part]]).sum(1).astype(np.int64)
    found = scores >= least[i]
    return i[found], j[found], scores[found]


class Chunk:
    """Anchors of a chunk with their windows, and the best rows found for them so far."""

    def __init__(self, x: dict, k: int):
        self.blocks, self.rows = np.frombuffer(x["a_blocks"], np.int64), np.frombuffer(x["a_rows"], np.int32)
        self.labels, n = np.frombuffer(x["a_labels"], np.int64), len(self.blocks)
        self.matrix = unpacked(x["a_matrix"], x["a_kind"], n)
        self.slots = np.frombuffer(x["slots"], np.int32).reshape(n, -1)
        self.low, self.high = (np.frombuffer(x[c], np.int64).reshape(n, -1).copy() for c in ("lows", "highs"))
        self.k = k
        # score, id, block and row of the k best of every window
        self.best = np.full((4, self.low.size, k), _LONG.min, np.int64)

    def meet(self, y: np.ndarray, ids: np.ndarray, labels: np.ndarray, block: int, same: bool) -> None:
        width = max(self.matrix.shape[1], y.shape[1])
        q, y = widened(self.matrix, width), widened(y, width)
        for first in range(0, len(q), TILE):
            i, j, score = reaching(q[first : first + TILE], y, self.low[first : first + TILE].min(1))
            i += first
            fits = ((self.labels[i] == labels[j]) == same) & ~((self.blocks[i] == block) & (self.rows[i] == j))
            i, j, score = i[fits], j[fits], score[fits]
            for w in range(self.low.shape[1]):
                inside = (score >= self.low[i, w]) & (score <= self.high[i, w])
                if inside.any():
                    self._add(i[inside] * self.low.shape[1] + w, score[inside], ids[j[inside]], block, j[inside])

    def _add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray, block: int, rows: np.ndarray) -> None:
        touched = np.unique(window)
        former = self.best[:, touched].reshape(4, -1)
        used = former[0] > _LONG.min
        window = np.concatenate([np.repeat(touched, self.k)[used], window])
        new = np.concatenate([former[:, used], np.stack([score, ids, np.full_like(score, block), rows.astype(np.int64)])], axis=1)
        order = np.lexsort((new[3], new[2], new[1], -new[0], window))
        window, new = window[order], new[:, order]
        starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        rank = np.arange(len(window)) - np.repeat(starts, np.diff(np.r_[starts, len(window)]))
        keep = rank < self.k
        self.best[:, touched] = _LONG.min
        self.best[:, window[keep], rank[keep]] = new[:, keep]
        low = self.low.reshape(-1)
        low[touched] = np.maximum(low[touched], self.best[0, touched, -1])

    def result(self) -> pa.RecordBatch:
        window, rank = np.nonzero(self.best[0] > _LONG.min)
        anchor = window // self.low.shape[1]
        score, ids, block, row = self.best[:, window, rank]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.blocks[anchor]), pa.array(self.rows[anchor]), pa.array(self.slots.reshape(-1)[window]),
             pa.array(block), pa.array(row.astype(np.int32)), pa.array(ids), pa.array(score)],
            names=[part.split()[0] for part in _HITS.split(", ")])


_CHUNKS = "c bigint, a_blocks binary, a_rows binary, a_labels binary, a_matrix binary, a_kind string, slots binary, lows binary, highs binary"


def _chunk_rows(batches, size: int, share: float):
    """Chunks of anchors; a window's threshold lies ``share`` of its width below its upper end."""
    names = [part.split()[0] for part in _CHUNKS.split(", ")]
    kinds = [pa.int64(), *[pa.binary()] * 4, pa.string(), *[pa.binary()] * 3]
    for batch in batches:
        for first in range(0, batch.num_rows, size):
            rows = batch.slice(first, size).to_pylist()
            matrix = stacked([np.frombuffer(r["vector"], np.float64) for r in rows])
            kind, raw = packed(matrix)
            wide = max(len(r["windows"]) for r in rows)
            # An anchor with fewer windows is filled up with ones that nothing fits.
            slots, lows, highs = (np.full((len(rows), wide), fill, kind_) for fill, kind_ in ((-1, np.int32), (_LONG.max, np.int64), (_LONG.min, np.int64)))
            for n, r in enumerate(rows):
                for m, w in enumerate(r["windows"]):
                    slots[n, m], highs[n, m] = w["slot"], w["high"]
                    lows[n, m] = w["low"] if share >= 1 else max(w["low"], w["high"] - math.ceil((w["high"] - w["low"]) * share))
            columns = [np.array([r[c] for r in rows], t).tobytes() for c, t in (("a_block", np.int64), ("a_row", np.int32), ("label", np.int64))]
            made = [0, *columns, raw, kind, slots.tobytes(), lows.tobytes(), highs.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, kinds, strict=True)], names=names)


def threshold_join(blocks: DataFrame, anchors: DataFrame, windows: DataFrame, n_anchors: int, k: int, same: bool, share: float) -> DataFrame:
    """The k best rows of each window at this share of its width, from all blocks."""
    spark = blocks.sparkSession
    asked = anchors.join(windows.groupBy(*_PLACE).agg(F.collect_list(F.struct("slot", "low", "high")).alias("windows")), _PLACE)
    dealt = asked.repartition(math.ceil(n_anchors / CHUNK))
    made = dealt.mapInArrow(lambda b: _chunk_rows(b, CHUNK, share), _CHUNKS).withColumn("c", F.monotonically_increasing_id())
    chunks = pinned(made, "negatives-chunks")
    keys = [r.c for r in chunks.select("c").collect()]  # one per ``CHUNK`` anchors
    stripes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, len(keys))) if n_anchors > COPIED else 1
    wanted = F.explode(F.array(*[F.lit(c).cast("bigint") for c in keys]))
    left = blocks.drop("asked", "width", "norm").withColumn("c", wanted).withColumn("stripe", F.pmod(F.xxhash64("block"), F.lit(stripes)))
    right = chunks.withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(stripes - 1).cast("bigint"))))
    met = join_small(left, right, ["c", "stripe"], "inner", n_anchors, COPIED)

    def run(batches):
        open_chunks: dict[int, Chunk] = {}
        for batch in batches:
            for n in range(batch.num_rows):  # a row is a block and a chunk
                x = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
                if x["c"] not in open_chunks:
                    if len(open_chunks) > 3:  # at most so many are held; one that comes again starts anew
                        yield open_chunks.pop(next(iter(open_chunks))).result()
                    open_chunks[x["c"]] = Chunk(x, k)
                y = unpacked(x["matrix"], x["kind"], x["n"])
                open_chunks[x["c"]].meet(y, np.frombuffer(x["ids"], np.int64), np.frombuffer(x["labels"], np.int64), x["block"], same)
        for chunk in open_chunks.values():
            yield chunk.result()

    hits = met.mapInArrow(run, _HITS)
    rank = F.row_number().over(W.partitionBy(*_PLACE, "slot").orderBy(F.desc("score"), "vec_id", "block", "row"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def fill(blocks: DataFrame, anchors: DataFrame, windows: DataFrame, k: int, same: bool, share: float) -> DataFrame:
    """The k best rows of each window: thresholds are lowered until a window is full or at its end."""
    spark, done = blocks.sparkSession, []
    while True:
        n = windows.select(*_PLACE).distinct().count()
        if not n:
            break
        hits = pinned(threshold_join(blocks, anchors, windows, n, k, same, share), "negatives-hits")
        if share >= 1:
            done.append(hits)
            break
        full = hits.groupBy(*_PLACE, "slot").agg(F.count("*").alias("n")).where(F.col("n") == k).drop("n")
        done.append(hits.join(full, [*_PLACE, "slot"], "left_semi"))
        windows = pinned(windows.join(full, [*_PLACE, "slot"], "left_anti"), "negatives-windows")
        share = min(1.0, share * WIDER)
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], _HITS + ", rank int")


def mine(vectors: DataFrame, is_anchor: Column, positives: int, negatives: int, low: int, high: int, block: int = BLOCK) -> DataFrame:
    """Each anchor's positives, with the best rows of other labels that score between ``low``
    and ``high`` percent of the positive."""
    ship(vectors.sparkSession)
    blocks = pinned(make_blocks(vectors, is_anchor, block), "negatives-blocks")
    size = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("norm"), F.lit(0.0)).alias("norm")).first()
    anchors = pinned(anchors_of(blocks), "negatives-anchors")
    most = F.least(F.col("norm") * size.norm + 1, F.lit(2.0**62)).cast("bigint")  # no score is higher
    every = F.lit(_LONG.min + 1)
    whole = anchors.select(
        *_PLACE, F.lit(0).alias("slot"), F.when(most < 2**61, -most - 1).otherwise(every).alias("low"),
        F.when(most < 2**61, most).otherwise(F.lit(_LONG.max)).alias("high"))
    best = pinned(fill(blocks, anchors, whole, positives, True, 0.25), "negatives-positives")
    chosen = best.select(*_PLACE, F.col("rank").cast("int").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    of_score = "cast({end}(cast(positive_score AS decimal(19, 0)) * {percent} / 100) AS bigint)"
    windows = chosen.select(*_PLACE, "slot", F.expr(of_score.format(end="ceil", percent=low)).alias("low"),
                            F.expr(of_score.format(end="floor", percent=high)).alias("high")).where("low <= high")
    # The first band is as wide as some windowfuls of evenly spread scores.
    share = min(1.0, 64 * negatives / max(1, size.n))
    found = fill(blocks, anchors, pinned(windows, "negatives-windows"), negatives, False, share)
    return found.join(chosen, [*_PLACE, "slot"]).join(anchors.select(*_PLACE, "anchor_id"), _PLACE).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


#: The query's rows by comparing every anchor with every row.
ORACLE = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.r AS a, b.r AS b, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
    s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.other_id) <= 10
"""
