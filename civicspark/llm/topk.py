"""Exact top-k search by inner product with block-at-a-time pruning (operator 6).

Vectors become integers, ``floor(256 * x)``.  Rows sorted by id are cut into blocks, ranges of
documents, each with its forward index (the integer matrix) and the largest and smallest value
of every dimension.  A query's bound on a block is the sum over dimensions of what query value
and block extreme give at most.  A block of queries takes the document blocks of its slice in
descending order of bound and leaves each query out where the block's bound lies below the
k-th score found so far; equal bounds are still scored, because a tie may have a smaller id.
The slices' best are merged per query.

Vectors that are null, or hold a null or non-finite component, take no part.  A shorter vector
counts as filled up with zeros.  Ties go to the smaller id; repeated rows are separate
candidates (a query leaves out every row of its own id).  Query rows of one id are one query,
asked once for each different vector; a candidate row's score is its best over these.  With fewer candidates than k, all
are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicspark.llm.blocks import stacked, vectors_of
from civicspark.llm.support import pinned, ship

SCALE, BLOCK, SLICES = 256, 2048, 24
_BLOCK = "block bigint, ids binary, matrix binary, width int, top binary, low binary"
_EXACT = float(2**53)


def _block_rows(batches, size: int):
    """Blocks of rows in the order they come, a whole partition at a time."""
    ids, rows, serial = [], [], 0

    def close():
        nonlocal serial
        matrix = stacked(rows)
        out = {"block": serial, "ids": np.array(ids, np.int64).tobytes(), "matrix": matrix.astype(np.int64).tobytes(),
               "width": matrix.shape[1], "top": matrix.max(0).astype(np.int64).tobytes(), "low": matrix.min(0).astype(np.int64).tobytes()}
        ids.clear()
        rows.clear()
        serial += 1
        return out

    kinds = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("matrix", pa.binary()), ("width", pa.int32()), ("top", pa.binary()), ("low", pa.binary())])
    for batch in batches:
        for key, vector in zip(batch.column(0).to_pylist(), vectors_of(batch.column(1)), strict=True):
            if vector is None or key is None:
                continue
            ids.append(key)
            rows.append(np.floor(SCALE * vector))
            if len(ids) == size:
                yield pa.RecordBatch.from_pylist([close()], kinds)
    if ids:
        yield pa.RecordBatch.from_pylist([close()], kinds)


def make_blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of ``size`` rows, by ranges of ids."""
    ranged = vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    made = ranged.mapInArrow(lambda b: _block_rows(b, size), _BLOCK)
    return made.withColumn("block", F.monotonically_increasing_id())


def bounds(queries: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The largest score each query can reach in a block with these extremes."""
    return np.maximum(queries, 0) @ top + np.minimum(queries, 0) @ low


def scores(queries: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles are used while they hold every sum exactly."""
    most = max(1, np.abs(queries).max(initial=0)) * max(1.0, float(np.abs(matrix).max(initial=0))) * max(1, queries.shape[1])
    if most < _EXACT:
        return (queries.astype(np.float64) @ matrix.T.astype(np.float64)).astype(np.int64)
    return queries.astype(np.int64) @ matrix.T.astype(np.int64)


def keep_best(found: np.ndarray, ids: np.ndarray, places: np.ndarray, own: np.ndarray, new: np.ndarray, new_ids: np.ndarray, first: int, k: int):
    """The k best of what was found and of new scores, by score and then by smaller id.

    ``places`` are the rows' numbers over all blocks; those of the new ones count up from ``first``.
    """
    gone = np.iinfo(np.int64).min
    new = np.where(new_ids[None, :] == own[:, None], gone, new)
    every = np.broadcast_to(np.arange(len(new_ids)), new.shape)
    if new.shape[1] > 4 * k:
        # Whatever may be among the best reaches the k-th largest score; ties at it all stay.
        kth = np.partition(new, new.shape[1] - k, axis=1)[:, -k]
        reach = (new >= kth[:, None]).sum(1).max()
        if reach <= 64:
            pick = np.argpartition(-new.astype(np.float64), min(int(reach), new.shape[1] - 1), axis=1)[:, : int(reach)] if np.abs(new[new > gone]).max(initial=0) < _EXACT else np.argsort(new, axis=1)[:, ::-1][:, : int(reach)]
            new, picked = np.take_along_axis(new, pick, 1), pick
        else:
            picked = every
    else:
        picked = every
    all_scores, all_ids = np.concatenate([found, new], 1), np.concatenate([ids, new_ids[picked]], 1)
    all_places = np.concatenate([places, first + picked], 1)
    order = np.lexsort((all_ids, -np.where(all_scores == gone, gone + 1, all_scores)), axis=1)[:, :k]
    return tuple(np.take_along_axis(a, order, 1) for a in (all_scores, all_ids, all_places))


def search(vectors: DataFrame, is_query: Column, k: int, block: int = BLOCK, slices: int = SLICES) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best among all rows but its own."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    docs = pinned(make_blocks(rows, block), "top-k-blocks")
    asked = pinned(make_blocks(rows.where(is_query).distinct(), 1024), "top-k-queries")
    # Every block of queries meets every block of documents, in slices that run side by side.
    slice_of = F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int")
    left = asked.select(F.col("block").alias("q"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.col("width").alias("q_width"),
                        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    pairs = left.join(docs.select(slice_of.alias("slice"), (F.col("block") * block).alias("first"), "ids", "matrix", "width", "top", "low"), "slice")
    gone = np.iinfo(np.int64).min

    def widened(m: np.ndarray, width: int) -> np.ndarray:
        return np.pad(m, ((0, 0), (0, width - m.shape[1])))

    def bound_of(batches):
        """The block's bound for the query block: the largest of its queries' bounds."""
        for batch in batches:
            out = []
            for q_ids, q_raw, q_width, top, low, width in zip(*(batch.column(n).to_pylist() for n in ("q_ids", "q_matrix", "q_width", "top", "low", "width")), strict=True):
                n = len(q_ids) // 8
                wide = max(q_width, width)
                q = widened(np.frombuffer(q_raw, np.int64).reshape(n, q_width), wide).astype(np.float64)
                ends = [widened(np.frombuffer(x, np.int64).reshape(1, width), wide)[0].astype(np.float64) for x in (top, low)]
                out.append(float(bounds(q, *ends).max(initial=0.0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "bound"])

    names = "q bigint, slice int, q_ids binary, q_matrix binary, q_width int, first bigint, ids binary, matrix binary, width int, top binary, low binary"
    ordered = (
        pairs.select(*[c.split()[0] for c in names.split(", ")]).mapInArrow(bound_of, names + ", bound double")
        .repartition("q", "slice").sortWithinPartitions("q", "slice", F.desc("bound")))

    def run(batches):
        state: dict = {}

        def result():
            used = state["ids"] >= 0
            used &= state["scores"] > gone
            q, r = np.nonzero(used)
            return pa.RecordBatch.from_arrays(
                [pa.array(state["own"][q]), pa.array(state["ids"][q, r]), pa.array(state["places"][q, r]), pa.array(state["scores"][q, r])], names=["query_id", "vec_id", "place", "score"])

        for batch in batches:
            for row in range(batch.num_rows):  # a row is a block of documents for a block of queries
                x = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                if state.get("key") != (x["q"], x["slice"]):
                    if state:
                        yield result()
                    own = np.frombuffer(x["q_ids"], np.int64)
                    state = {"key": (x["q"], x["slice"]), "own": own, "q": np.frombuffer(x["q_matrix"], np.int64).reshape(len(own), -1),
                             "scores": np.full((len(own), k), gone), "ids": np.full((len(own), k), -1), "places": np.full((len(own), k), -1)}
                ids = np.frombuffer(x["ids"], np.int64)
                wide = max(state["q"].shape[1], x["width"])
                q = widened(state["q"], wide)
                matrix = widened(np.frombuffer(x["matrix"], np.int64).reshape(len(ids), x["width"]), wide)
                ends = [widened(np.frombuffer(x[n], np.int64).reshape(1, -1), wide)[0].astype(np.float64) for n in ("top", "low")]
                limit = bounds(q.astype(np.float64), *ends)
                # A bound in doubles may be off by its rounding; that margin is never pruned.
                live = np.flatnonzero((state["scores"][:, -1] == gone) | (limit + 1e-9 * np.abs(limit) + 1 >= state["scores"][:, -1]))
                if len(live):
                    new = scores(q[live], matrix)
                    best = keep_best(state["scores"][live], state["ids"][live], state["places"][live], state["own"][live], new, ids, x["first"], k)
                    state["scores"][live], state["ids"][live], state["places"][live] = best
        if state:
            yield result()

    lists = ordered.mapInArrow(run, "query_id bigint, vec_id bigint, place bigint, score bigint")
    best = lists.groupBy("query_id", "vec_id", "place").agg(F.max("score").alias("score"))  # one list for each vector of an id
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # k rows of each slice
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
