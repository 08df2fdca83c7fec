"""Packing along a space-filling curve (operator 9).

Each document's token ids are hashed into a vector, projected to a few dimensions by fixed
random directions and given a Hilbert key.  A range sort by that key puts similar documents
side by side; the sorted token stream is cut into sequences of a fixed length, so a sequence
holds neighbours on the curve and none is padded but the last, which is split into sequences
whose lengths are powers of two and need no padding either.

Every row is packed: a null or empty text is the end id alone, repeated rows are packed as
often as they occur, a null id stays null.  Ties on the curve are broken by the row number
given when the tokens are written.  An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.support import pinned, ship

SEQUENCE, END_ID = 2048, 1
HASHED, DIMS, BITS = 64, 4, 12


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str, special: str, special_id: int):
    """The byte-level vocabulary as ranks; ``special`` in a text becomes its id."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={special: special_id})


def directions() -> np.ndarray:
    """Fixed projection of hashed counts; the seed is part of the method."""
    return np.random.default_rng(9).standard_normal((HASHED, DIMS)) / np.sqrt(HASHED)


def hashed_vector(ids: np.ndarray) -> np.ndarray:
    """Signed counts of hashed token ids, of length one."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    vector = np.bincount((h >> np.uint64(58)).astype(np.int64), weights=sign, minlength=HASHED)
    return vector / max(float(np.linalg.norm(vector)), 1e-12)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer points (rows), by transposed bit planes."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for shift in range(bits - 1, 0, -1):  # undo the rotations of each level, from the coarsest
        bit, low = 1 << shift, (1 << shift) - 1
        for i in range(n):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        parity ^= np.where(x[n - 1] & (1 << shift), (1 << shift) - 1, 0)
    x ^= parity
    key = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> shift) & 1)
    return key


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed vectors: project, squash to the unit cube, quantise."""
    flat = np.tanh(vectors @ directions() * np.sqrt(HASHED)) * 0.5 + 0.5
    return hilbert_keys(np.clip((flat * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1))


def encode_rows(docs: DataFrame, ranks_path: str, pattern: str, special: str, special_id: int) -> DataFrame:
    """``row``, doc_id, curve key, number of ids with the end id, and the ids (16 bits each)."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        enc = encoding(ranks_path, pattern, special, special_id)
        for batch in batches:
            texts, doc_ids = batch.column(1).to_pylist(), batch.column(0)
            for start in range(0, len(texts), 512):
                ids = [np.array(enc.encode(t or "", allowed_special={special}) + [END_ID], np.uint16)
                       for t in texts[start : start + 512]]
                vectors = np.array([hashed_vector(i[:-1]) for i in ids])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(start, 512), pa.array(curve_keys(vectors)),
                     pa.array([len(i) for i in ids], pa.int64()), pa.array([i.tobytes() for i in ids], pa.binary())],
                    names=["doc_id", "key", "doc_tokens", "ids"],
                )

    coded = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key bigint, doc_tokens bigint, ids binary")
    return coded.withColumn("row", F.monotonically_increasing_id())


def stream_positions(coded: DataFrame) -> DataFrame:
    """``row`` and ``at``: where each document begins in the token stream sorted along the curve.

    Only keys and counts are sorted.  Positions are summed within each range partition; the
    totals of the partitions, one small row each, are added on the driver.
    """
    ordered = coded.select("key", "row", "doc_tokens").repartitionByRange("key", "row").sortWithinPartitions("key", "row")

    def run(batches):
        at = 0
        for batch in batches:
            counts = batch.column(1).to_numpy()
            ends = at + np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends - counts), pa.array(ends)], names=["row", "at", "ends"])
            at = int(ends[-1]) if len(ends) else at

    local = pinned(
        ordered.select("row", "doc_tokens").mapInArrow(run, "row bigint, at bigint, ends bigint")
        .withColumn("part", F.spark_partition_id()),
        "stream-positions",
    )
    totals = sorted((r["part"], r["n"]) for r in local.groupBy("part").agg(F.max("ends").alias("n")).collect())
    before, rows = 0, []
    for part, n in totals:
        rows.append((part, before))
        before += n
    bases = local.sparkSession.createDataFrame(rows or [(0, 0)], "part int, base bigint")
    return local.join(F.broadcast(bases), "part").select(  # one row per partition
        "row", (F.col("at") + F.col("base")).alias("at"), F.lit(before).cast("bigint").alias("total"))


def cuts(at: int, n: int, total: int, length: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """Pieces (start, length, sequence, offset) of the document at ``at``.

    The rest behind the last whole sequence is cut into powers of two, the largest first.
    """
    whole = total // length * length
    out, start = [], 0
    while start < n:
        here = at + start
        if here < whole:
            sequence, first, size = here // length, here // length * length, length
        else:
            sequence, first, rest = whole // length, whole, total - whole
            size = 1 << (rest.bit_length() - 1)
            while here >= first + size:
                first, rest, sequence = first + size, rest - size, sequence + 1
                size = 1 << (rest.bit_length() - 1)
        take = min(n - start, first + size - here)
        out.append((start, take, sequence, here - first))
        start += take
    return out


def pack(docs: DataFrame, ranks_path: str, pattern: str, special: str, special_id: int, length: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids."""
    coded = pinned(encode_rows(docs, ranks_path, pattern, special, special_id), "packed-ids")
    placed = coded.drop("key").join(stream_positions(coded), "row")
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            doc_ids, counts, raws, ats, totals = (batch.column(i).to_pylist() for i in range(5))
            rows = []
            for doc_id, n, raw, at, total in zip(doc_ids, counts, raws, ats, totals, strict=True):
                ids = np.frombuffer(raw, np.uint16).astype("<u4")
                for start, size, sequence, offset in cuts(at, n, total, length):
                    piece = ids[start : start + size]
                    rows.append((doc_id, start, size, zlib.crc32(piece.tobytes()), n, sequence, offset, raw[2 * start : 2 * (start + size)]))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return placed.select("doc_id", "doc_tokens", "ids", "at", "total").mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, ids binary",
    )
