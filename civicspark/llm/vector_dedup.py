"""Near-duplicate vectors by a subspace pigeonhole join (operator 10).

Unit vectors with cosine of at least c lie within a squared distance of 2 - 2c.  They are turned
by a fixed random rotation and split into blocks of a few dimensions, and each block gets the
share of the squared distance that it has of the dimensions: two linked vectors keep within the
budget in at least one block.  Each block is range-joined: the plane of its first two
dimensions is cut into cells as wide as the budget's root, vectors of a cell are packed into
matrices of bounded size, and matrices of the same or neighbouring cells meet in a tile.  A tile
finds the pairs within the block's budget and verifies them by cosine in double precision on
the original vectors.  A pair is credited to the first block whose budget it keeps, so links
are counted once without listing pairs; each tile hands on one count per vector and the links
of its local components, never all pairs.

Equal vectors are joined into one with a multiplicity first.  Vectors that are null, zero or
hold a null or non-finite component link with nothing.  Shorter vectors count as filled up
with zeros.  Every row gives one row; rows of one id are copies of one vector each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.blocks import stacked
from civicspark.llm.graph import connected_components
from civicspark.llm.support import pinned, ship

BLOCK_DIMS, BATCH_ROWS, BATCH_BYTES, MATRIX_ROWS = 16, 16384, 1 << 26, 1024
#: Of a squared distance, for rounding: of doubles, and of the single-precision first look.
SLACK, ROUGH = 1e-9, 2e-5


#: Whether a row has an id and a vector with a direction.
USABLE = (
    "coalesce(vec_id IS NOT NULL AND embedding IS NOT NULL AND exists(embedding, x -> x <> 0) AND "
    "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')), false)")


def units(raw: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither vanish nor overflow."""
    scaled = raw / np.abs(raw).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(10).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def borders(dims: int, block_dims: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    n = max(1, dims // block_dims)
    return [(k * dims // n, (k + 1) * dims // n) for k in range(n)]


def number_type(vectors: DataFrame) -> str:
    """The stored precision: four bytes for floats, eight for everything else."""
    return "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"


def pack_cells(vectors: DataFrame, dims: int, limit: float) -> DataFrame:
    """Matrices by block and cell, of at most ``MATRIX_ROWS`` rows.

    A task packs a bounded number of rows at a time, so a cell of any size becomes many matrices.
    """
    turn, cuts, kind = rotation(dims), borders(dims), number_type(vectors)
    most = max(64, min(BATCH_ROWS, BATCH_BYTES // (8 * dims)))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def flush(ids: list, copies: list, rows: list):
        raw = stacked(rows, dims)
        turned = units(raw) @ turn
        ids, copies, raw = np.array(ids, np.int64), np.array(copies, np.int64), raw.astype(kind)
        out: dict[str, list] = {n: [] for n in ("block", "cx", "cy", "ids", "copies", "raw")}
        for k, (a, b) in enumerate(cuts):
            width = np.sqrt(limit * (b - a) / dims) * (1 + 1e-6)
            cells = np.floor(turned[:, [a, min(a + 1, b - 1)]] / width).astype(np.int64)
            order = np.lexsort((cells[:, 1], cells[:, 0]))
            ranked = cells[order]
            edges = np.flatnonzero(np.r_[True, (np.diff(ranked, axis=0) != 0).any(1), True])
            for i, j in zip(edges, edges[1:], strict=False):
                for at in range(i, j, MATRIX_ROWS):
                    pick = order[at : min(j, at + MATRIX_ROWS)]
                    for name, value in (("block", k), ("cx", int(ranked[i, 0])), ("cy", int(ranked[i, 1])),
                                        ("ids", ids[pick].tobytes()), ("copies", copies[pick].tobytes()), ("raw", raw[pick].tobytes())):
                        out[name].append(value)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    def run(batches):
        ids, copies, rows = [], [], []
        for batch in batches:
            for key, n, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids.append(key)
                copies.append(n)
                rows.append(np.asarray(value, np.float64))
                if len(ids) == most:
                    yield flush(ids, copies, rows)
                    ids, copies, rows = [], [], []
        if ids:
            yield flush(ids, copies, rows)

    return vectors.select("rep", "copies", "embedding").mapInArrow(
        run, "block int, cx bigint, cy bigint, ids binary, copies binary, raw binary"
    ).withColumn("matrix", F.monotonically_increasing_id())


def local_roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component in a symmetric boolean matrix."""
    root = ids.copy()
    big = np.iinfo(np.int64).max
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], big).min(1))
        if (new == root).all():
            return root
        root = new


def tile_links(left: dict, right: dict, same: bool, block: int, dims: int, limit: float, cosine: float, turn: np.ndarray):
    """Counts per vector, and (id, root) links, of the pairs credited to this block."""
    cuts = borders(dims)
    a, b = cuts[block]
    budgets = [limit * (q - p) / dims + SLACK for p, q in cuts]
    x, y = left["turned"], right["turned"]
    # One product gives |x|^2 - 2xy + |y|^2; what it lets through is measured again in doubles.
    one = np.c_[x, (x * x).sum(1), np.ones(len(x))].astype(np.float32)
    two = np.c_[-2 * y, np.ones(len(y)), (y * y).sum(1)].astype(np.float32)
    near = one @ two.T <= np.float32(budgets[block] + ROUGH)
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    keep_i, keep_j = [], []
    for s in range(0, len(i), 1 << 15):
        p, q = i[s : s + (1 << 15)], j[s : s + (1 << 15)]
        good = np.einsum("nd,nd->n", left["unit"][p], right["unit"][q]) >= cosine
        p, q = p[good], q[good]
        if len(p):
            gap = (left["unit"][p] - right["unit"][q]) @ turn
            gap *= gap
            first = np.full(len(p), -1)
            for k in range(len(cuts) - 1, -1, -1):
                first[gap[:, cuts[k][0] : cuts[k][1]].sum(1) <= budgets[k]] = k
            keep_i.append(p[first == block])
            keep_j.append(q[first == block])
    if not keep_i:
        return None
    i, j = np.concatenate(keep_i), np.concatenate(keep_j)
    if not len(i):
        return None
    names, place = np.unique(np.concatenate([left["ids"][i], right["ids"][j]]), return_inverse=True)
    u, v = place[: len(i)], place[len(i) :]
    linked = np.zeros((len(names), len(names)), bool)
    linked[u, v] = linked[v, u] = True
    weights = np.bincount(u, right["copies"][j], len(names)) + np.bincount(v, left["copies"][i], len(names))
    return names, weights.astype(np.int64), local_roots(linked, names)


def links(vectors: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Per vector its number of links to others, and (a, b) links that span the components.

    ``vectors`` has rep, copies and embedding; copies count as so many links.
    """
    spark = vectors.sparkSession
    size = vectors.agg(F.max(F.size("embedding")).alias("dims"), F.count("*").alias("n")).first()
    if not size["n"]:
        empty = spark.createDataFrame([], "id bigint, links bigint, a bigint, b bigint")
        return empty.select("id", "links"), empty.select("a", "b")
    dims, limit, kind = size["dims"], 2 - 2 * cosine, number_type(vectors)
    packed = pinned(pack_cells(vectors.repartition(max(1, -(-size["n"] // BATCH_ROWS))), dims, limit), "cells")
    side = lambda n: [F.col(c).alias(f"{c}{n}") for c in ("matrix", "ids", "copies", "raw")]
    home = packed.select("block", "cx", "cy", *side(1))
    # Of two different cells the later one visits the earlier.
    steps = F.array(*[F.struct(F.lit(p).alias("x"), F.lit(q).alias("y")) for p, q in ((0, 0), (1, -1), (1, 0), (1, 1), (0, 1))])
    guest = packed.withColumn("s", F.explode(steps)).select(
        "block", (F.col("cx") - F.col("s.x")).alias("cx"), (F.col("cy") - F.col("s.y")).alias("cy"),
        ((F.col("s.x") == 0) & (F.col("s.y") == 0)).alias("at_home"), *side(2))
    tiles = home.join(guest, ["block", "cx", "cy"]).where("NOT at_home OR matrix1 <= matrix2")
    turn, cuts = rotation(dims), borders(dims)

    def matrices(row: dict, n: str) -> dict:
        a, b = cuts[row["block"]]
        ids = np.frombuffer(row[f"ids{n}"], np.int64)
        unit = units(np.frombuffer(row[f"raw{n}"], kind).reshape(len(ids), dims).astype(np.float64))
        return {"ids": ids, "copies": np.frombuffer(row[f"copies{n}"], np.int64), "unit": unit, "turned": unit @ turn[:, a:b]}

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                same = row["matrix1"] == row["matrix2"]
                found = tile_links(matrices(row, "1"), matrices(row, "2"), same, row["block"], dims, limit, cosine, turn)
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["id", "links", "root"])

    columns = ["block", *(f"{c}{n}" for n in (1, 2) for c in ("matrix", "ids", "copies", "raw"))]
    partial = pinned(tiles.select(*columns).mapInArrow(run, "id bigint, links bigint, root bigint"), "tile-links")
    return (partial.groupBy("id").agg(F.sum("links").alias("links")),
            partial.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    A row without an id takes no part and has neither a component nor is it kept.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    good = rows.where(USABLE)
    classes = pinned(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    counts, edges = links(classes, cosine)
    roots = connected_components(edges).withColumnRenamed("id", "rep")
    told = (
        classes.join(counts.withColumnRenamed("id", "rep"), "rep", "left").join(roots, "rep", "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component_id", "rep").alias("component_id")))
    placed = good.join(told, "embedding").select("vec_id", "n_links", "component_id")
    rest = rows.where(f"NOT {USABLE}").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
