"""Exact Jaccard join of word-shingle sets by a partitioned universe (operator 3).

Two sets x and y with Jaccard of at least t differ in at most H = (1 - t) / (1 + t) * (|x| + |y|)
members.  Sums of sizes are cut into bands; a band has one H, that of its largest sum, and a
partition of the universe of hashes into m > H segments.  A set takes part in every band that
the sum with a partner may fall into.  Segments of linked sets differ by at most H members in
all, so most are equal.  Each set chooses which segments to search by and how (its allocation):

* a segment searched whole finds sets that are equal there, and covers one difference;
* the first few segments of a band are indexed with all one-deletion neighbours too; searched
  so, a segment finds sets that differ by at most one there, and covers two differences;
* a segment is left out when it is dear.  The cost of a segment is the frequency of its rarest
  member among frequent shingles, counted over all documents beforehand; an empty segment is
  the dearest.  As long as H + 1 differences stay covered, the dearest go first.

Every segment with members is indexed, so a pair is found when either set searches a segment they share.
Frequencies only steer costs: any choice finds all pairs.

Signatures are dealt out and sorted by hash.  A signature's smallest searching set leads it,
and each set is first compared with the leader it meets most often, which settles large groups
in as many comparisons as they have members.  Signatures whose sets are not in one component
by then are compared by tiles: the sets of a signature, cut into parts of about ``TILE``, meet
part by part as matrices of short sketches.  A sketch holds the parities of hashed members, and
two of them differ in no more bits than the sets in members, so pairs that differ in more bits
than the threshold allows are never written.  Work inside a signature grows with the square of
its different texts, its rows with that square over ``TILE``.  Pairs left over meet their full
sketches and then, exactly, the sets of the whole texts (64-bit hashes of shingles).

A pair may share many signatures.  Each set keeps, for some hash functions, the least hash of
the signatures it searches by; the first function in which two sets agree names a signature
that both have, and only there is the pair written.

Texts with equal sets form a class and are represented by its smallest id.  A text without
words, or null, links with nothing.  Rows of one id are one document; a row without an id links
with nothing and has no component.  Each row gives one row.
"""

from __future__ import annotations

from collections import OrderedDict
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.graph import connected_components
from civicspark.llm.shingles import SHORT, Hasher, fingerprint, mixed, short_sketch, sketch, sketch_distance
from civicspark.llm.support import join_small, pinned, ship

#: Extra segments as a share of H + 1; segments with one-deletion neighbours; partitions for
#: sets with many empty segments; frequent shingles whose counts steer costs (at least ``FREQUENT`` in a chunk of ``CHUNK`` members).
SPARE, DELETED, PARTITIONS, KNOWN, FREQUENT, CHUNK = 0.15, 4, 6, 100_000, 8, 2_000_000
#: Ids or pairs that may be copied to the executors; beyond it both sides are shuffled.
COPIED = 1_000_000
#: Sets of a signature that meet as one matrix; up to ``FEW`` meet in step with those of other
#: signatures; hash functions by which a pair finds the one signature it is written at.
TILE, FEW, LEAST = 1024, 24, 6

_EMPTY_COST = float("inf")


class Bands:
    """Bands of size sums, and what each needs, for one threshold."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        self.tops: list[int] = [2]  # the first sum above each band
        self.growth = Fraction(1) / threshold

    def band(self, total: int) -> int:
        while self.tops[-1] <= total:
            top = self.tops[-1]
            self.tops.append(max(top + 1, int(top * self.growth)))
        return int(np.searchsorted(self.tops, total, side="right"))

    def of_size(self, n: int) -> range:
        """Bands of the sums that a set of n members may have with a partner."""
        smallest, largest = -(-n * self.t.numerator // self.t.denominator), n * self.t.denominator // self.t.numerator
        return range(self.band(n + smallest), self.band(n + largest) + 1)

    def shape(self, band: int) -> tuple[int, int, int]:
        """H, the number of segments, and how many of them are indexed with neighbours."""
        most = self.tops[band] - 1
        h = most * (self.t.denominator - self.t.numerator) // (self.t.denominator + self.t.numerator)
        m = h + 1 + int(np.ceil(SPARE * (h + 1)))
        return h, m, min(m, DELETED)


def allocate(whole: np.ndarray, near: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """What is searched: each segment whole, and the first ones' neighbours too.

    Leaving one of them out gives up one covered difference; the dearest go first while the
    units last, a segment's neighbours before the segment.
    """
    costs = np.concatenate([near, whole])
    searched = np.ones(len(costs), bool)
    dear = np.flatnonzero(costs)
    if len(dear) > units:
        dear = dear[np.argsort(-costs[dear], kind="stable")[:units]]
    searched[dear] = False
    return searched[len(near) :], searched[: len(near)]


def signatures(members: np.ndarray, bands: Bands, hot: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Signatures of a set; bit 0 is clear where the set searches by the signature.

    A set whose allocation leaves out all its empty segments, and the neighbours of those with
    one member, finds each partner by segments that hold members, and all those are indexed.  A
    set with too many of them for that takes part in the next partition of the universe as well, among the sets that had too many
    in each partition before; in the last one empty segments are indexed and searched.
    """
    n = len(members)
    if n == 0:
        return np.empty(0, np.uint64)
    weight = np.zeros(n)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, members), len(hot) - 1)
        weight = np.where(hot[at] == members, counts[at], 0.0)
    out, open_bands, any_hot = [], list(bands.of_size(n)), bool(weight.any())
    for turn in range(PARTITIONS):
        values, costs = members, weight
        if turn:
            values = mixed(members + np.uint64(turn))
            order = np.argsort(values)
            values, costs = values[order], weight[order]
        mixes, high = mixed(values), values >> np.uint64(32)
        crowded = []
        for band in open_bands:
            h, m, with_neighbours = bands.shape(band)
            # Values are sorted, so each segment is a run of them.
            segment = ((high * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
            starts = np.concatenate([[0], np.flatnonzero(segment[1:] != segment[:-1]) + 1])
            held = segment[starts]
            ends = np.r_[starts[1:], n]
            cost, near_cost = np.full(m, _EMPTY_COST), np.full(with_neighbours, _EMPTY_COST)
            cost[held] = np.minimum.reduceat(costs, starts)
            few = int(np.searchsorted(held, with_neighbours))
            for k in range(few):
                if ends[k] - starts[k] > 1:  # without its rarest member
                    near_cost[held[k]] = np.partition(costs[starts[k] : ends[k]], 1)[1] if any_hot else 0.0
            searched, near_searched = allocate(cost, near_cost, m + with_neighbours - h - 1)
            shown, near_shown = cost < _EMPTY_COST, near_cost < _EMPTY_COST
            if (searched & ~shown).any() or (near_searched & ~near_shown).any():
                if turn + 1 < PARTITIONS:
                    crowded.append(band)
                else:
                    shown[:] = near_shown[:] = True
            place = np.uint64((band * PARTITIONS + turn) * 0x9FB21C651E98DF25 % 2**64) + np.arange(m, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            sums = np.zeros(m, np.uint64)
            sums[held] = np.add.reduceat(mixes, starts)
            sig = mixed(sums + place) & ~np.uint64(1)
            out.append((sig | (~searched).astype(np.uint64))[shown])
            for k in range(few):
                if near_shown[held[k]]:
                    less = sums[held[k]] - mixes[starts[k] : ends[k]]
                    beside = mixed(less + place[held[k]]) & ~np.uint64(1)
                    out.append(beside | np.uint64(not near_searched[held[k]]))
        open_bands = crowded
        if not open_bands:
            break
    return np.concatenate(out)


def describe(docs: DataFrame) -> DataFrame:
    """Rows of two kinds.  kind 0: id, set size n, fingerprint (a, b), sketch and short sketch.  kind 1: a
    frequent shingle (a) with its number of sets (b) in one chunk; equal sets of a chunk count once."""
    ship(docs.sparkSession)
    names = ["kind", "id", "n", "a", "b", "sketch", "short"]

    def run(batches):
        hasher = Hasher()
        held, seen, n_held = [], set(), 0

        def frequent():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= FREQUENT
            values, n = values[often].view(np.int64), n[often]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(values), np.int32)), pa.nulls(len(values), pa.int64()), pa.nulls(len(values), pa.int64()), pa.array(values), pa.array(n), pa.nulls(len(values), pa.binary()), pa.nulls(len(values), pa.binary())],
                names=names)

        for batch in batches:
            sizes, prints, sketches, shorts = [], [], [], []
            for text in (value.as_py() for value in batch.column(1)):
                members = hasher.members(text)
                sketches.append(sketch(members))
                shorts.append(short_sketch(members))
                print_ = fingerprint(members)
                sizes.append(len(members))
                prints.append(print_)
                if len(members) and print_ not in seen:
                    seen.add(print_)
                    held.append(members)
                    n_held += len(members)
                    if n_held >= CHUNK:
                        yield frequent()
                        held, seen, n_held = [], set(), 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sizes), np.int32)), batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array([a for a, _ in prints], pa.int64()), pa.array([b for _, b in prints], pa.int64()), pa.array(sketches, pa.binary()), pa.array(shorts, pa.binary())],
                names=names)
        if held:
            yield frequent()

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "kind int, id bigint, n bigint, a bigint, b bigint, sketch binary, short binary")
    return pinned(rows, "shingle-sets")


def known_frequencies(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts; a bounded hint for costs."""
    top = (
        described.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n"))
        .orderBy(F.desc("n"), "a").limit(KNOWN).select("a", "n").toPandas())
    values, n = top["a"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.float64)
    order = np.argsort(values)
    return values[order], n[order]


def index_rows(docs: DataFrame, threshold: Fraction, hot: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(sig, id) of every signature of every document of ``docs``; equal sets of a task once."""
    shared = docs.sparkSession.sparkContext.broadcast((hot, counts))

    def run(batches):
        hasher, bands, seen = Hasher(), Bands(threshold), set()
        hot, counts = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            sigs, owners, n = [], [], 0
            for key, text in zip(ids, (value.as_py() for value in batch.column(1)), strict=True):
                members = hasher.members(text)
                if not len(members) or (mark := fingerprint(members)) in seen:
                    continue
                seen.add(mark)
                made = signatures(members, bands, hot, counts)
                sigs.append(made.view(np.int64))
                owners.append(np.full(len(made), key, np.int64))
                n += len(made)
                if n >= 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(owners))], names=["sig", "id"])
                    sigs, owners, n = [], [], 0
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(owners))], names=["sig", "id"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "sig bigint, id bigint")


def shared_signatures(rows: DataFrame) -> DataFrame:
    """Rows of signatures that several sets have and one of them searches by: key, id, searches, leader.

    Sorted rows stream through; a signature's searchers come first, the smallest of them leads.
    """

    def run(batches):
        key = leader = None  # of the run that the last batch ended in, if it is worth showing
        alone = None  # its first row while that has no second

        for batch in batches:
            sig, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if alone is not None:
                sig, ids = np.r_[alone[0], sig], np.r_[alone[1], ids]
                alone = None
            if not len(sig):
                continue
            keys = sig >> 1
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            run_of = np.cumsum(np.r_[False, keys[1:] != keys[:-1]])
            length = np.diff(np.r_[starts, len(keys)])
            lead = ids[starts].copy()
            worth = (length >= 2) & ((sig[starts] & 1) == 0)
            if key is not None and keys[0] == key[0]:
                worth[0] = key[1]
                lead[0] = leader
            last = len(starts) - 1
            continued = last == 0 and key is not None and keys[0] == key[0]
            if length[last] == 1 and not continued:
                alone = (sig[-1:], ids[-1:])
                key = None
            else:
                key, leader = (keys[-1], bool(worth[last])), lead[last]
            take = worth[run_of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[take]), pa.array(ids[take]), pa.array((sig[take] & 1) == 0), pa.array(lead[run_of][take])],
                names=["key", "id", "searches", "leader"])

    dealt = rows.repartition(F.shiftright("sig", 1)).sortWithinPartitions("sig", "id")
    return pinned(dealt.mapInArrow(run, "key bigint, id bigint, searches boolean, leader bigint"), "shared-signatures")


def plausible(pairs: DataFrame, sketches: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs whose sketches differ in no more bits than sets that reach the threshold may."""
    one = sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    top, bottom = threshold.numerator, threshold.denominator

    def run(batches):
        for batch in batches:
            n_a, n_b, s_a, s_b = (batch.column(i).to_pylist() for i in range(2, 6))
            mask = pa.array([(bottom + top) * sketch_distance(s, t) <= (bottom - top) * (m + n) for m, n, s, t in zip(n_a, n_b, s_a, s_b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def compared(unit, left, ids, n, component, searches, least, hashed, sketches, threshold: Fraction):
    """Pairs of positions of one unit each that may be linked, as two arrays.

    Rows of a unit stand together.  ``left`` is 0 for a unit whose rows all meet, else it names
    the side, 1 or 2, and rows of different sides meet.
    """
    top, bottom = threshold.numerator, threshold.denominator
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    ends = np.r_[starts[1:], len(unit)]
    found = []

    def keep(x, y, distance):
        """Of pairs x, y: near enough by sketch and size, in two components, and written here."""
        m, k = n[x], n[y]
        good = ((bottom + top) * distance <= (bottom - top) * (m + k)) & (m * bottom >= k * top) & (k * bottom >= m * top)
        good &= (component[x] != component[y]) & (searches[x] | searches[y]) & (ids[x] != ids[y]) & ((left[x] == 0) | (left[x] != left[y]))
        x, y = x[good], y[good]
        agree = least[x] == least[y]
        first = agree.argmax(axis=1)
        at = np.arange(len(x))
        here = ~agree[at, first] | (hashed[x, first] == least[x, first])
        found.append((x[here], y[here]))

    few = np.flatnonzero((ends - starts > 1) & (ends - starts <= FEW))
    last = np.repeat(ends[few], (ends - starts)[few])  # of the unit of each row below
    rows = np.concatenate([np.arange(starts[k], ends[k]) for k in few]) if len(few) else np.empty(0, np.int64)
    for step in range(1, FEW):
        within = rows + step < last
        rows, last = rows[within], last[within]
        if not len(rows):
            break
        x = rows[component[rows] != component[rows + step]]
        keep(x, x + step, np.bitwise_count(sketches[x] ^ sketches[x + step]).sum(axis=1, dtype=np.int64))
    for k in np.flatnonzero(ends - starts > FEW):
        here = np.arange(starts[k], ends[k])
        if left[here[0]]:
            one, two = here[left[here] == 1], here[left[here] == 2]
        else:
            one = two = here
        words = np.ascontiguousarray(sketches[two].T)
        for at in range(0, len(one), 256):
            block = one[at : at + 256]
            distance = np.zeros((len(block), len(two)), np.uint16)
            for w in range(sketches.shape[1]):
                distance += np.bitwise_count(sketches[block, w][:, None] ^ words[w][None, :])
            most = (bottom - top) * (n[block][:, None] + n[two][None, :]) // (bottom + top)
            i, j = np.nonzero(distance <= most)
            if one is two:
                i, j = i[block[i] < two[j]], j[block[i] < two[j]]
            keep(block[i], two[j], distance[i, j].astype(np.int64))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def open_pairs(rows: DataFrame, sketches: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b), a < b, of sets of one signature and two components that short sketches leave.

    ``rows`` has key, id, searches, component and, for each key, its number of sets.
    """
    hashes = [F.xxhash64("key", F.lit(j)) for j in range(LEAST)]
    least = rows.where("searches").groupBy("id").agg(*[F.min(h).alias(f"m{j}") for j, h in enumerate(hashes)])
    # A set that searches nothing here agrees with no other, so its pairs are written at each signature.
    known = sketches.select("id", "n", "short").join(least, "id", "left").withColumn(
        "least", F.array(*[F.coalesce(f"m{j}", F.xxhash64("id", F.lit(-1 - j))) for j in range(LEAST)])).drop(*[f"m{j}" for j in range(LEAST)])
    rows = rows.join(known, "id")
    whole = rows.where(F.col("sets") <= TILE).withColumn("i", F.lit(0)).withColumn("j", F.lit(0)).withColumn("side", F.lit(0))
    parts = F.ceil(F.col("sets") / TILE).cast("int")
    cut = (
        rows.where(F.col("sets") > TILE).withColumn("part", F.pmod(F.hash("id"), parts))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
        .withColumn("side", F.when(F.col("i") == F.col("j"), 0).when(F.col("part") == F.col("i"), 1).otherwise(2)).drop("part", "other"))
    dealt = whole.unionByName(cut).select("key", "i", "j", "side", "id", "n", "component", "searches", "least", F.array(*hashes).alias("hashed"), "short")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs_of(table):
        key, i, j, side, ids, n, component = (table.column(k).to_numpy() for k in range(7))
        searches = table.column(7).to_numpy(zero_copy_only=False)
        least, hashed = (np.array(table.column(k).combine_chunks().flatten().to_numpy()).reshape(-1, LEAST) for k in (8, 9))
        bits = np.frombuffer(b"".join(table.column(10).to_pylist()), np.uint64).reshape(-1, SHORT // 64)
        changed = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        x, y = compared(np.cumsum(np.r_[False, changed]), side, ids, n, component, searches, least, hashed, bits, threshold)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[x], ids[y])), pa.array(np.maximum(ids[x], ids[y]))], names=["a", "b"])

    def run(batches):
        held = None  # rows of the unit that the last batch ended in
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            key, i, j = (table.column(k).to_numpy() for k in range(3))
            rest = int(np.flatnonzero((key == key[-1]) & (i == i[-1]) & (j == j[-1]))[0])
            held = table.slice(rest)
            if rest:
                yield pairs_of(table.slice(0, rest))
        if held is not None:
            yield pairs_of(held)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def verify(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold: by sketches first, then by the sets."""
    pairs = pinned(plausible(pairs, sketches, threshold), "plausible-pairs")
    n = pairs.count()
    right = join_small(texts.withColumnRenamed("id", "b"), pairs, ["b"], "inner", n, COPIED).withColumnRenamed("text", "text_b")
    wanted = pairs.select(F.col("a").alias("id")).distinct()
    left = join_small(texts, wanted, ["id"], "left_semi", n, COPIED).select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    both = left.join(right, "a").select("a", "b", "text_a", "text_b")
    top, bottom = threshold.numerator, threshold.denominator

    def run(batches):
        hasher, recent = Hasher(), OrderedDict()
        for batch in batches:
            good = []
            for a, first, second in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x = recent.get(a)
                if x is None:
                    x = recent[a] = hasher.members(first)
                    if len(recent) > 8:
                        recent.popitem(last=False)
                y = hasher.members(second)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bottom * common >= top * (len(x) + len(y) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def apart(docs: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The documents with a number of its own, above all ids, for each row of a repeated id, and those
    rows' numbers and ids (node, id); None if no id is repeated.  Ids are below 2**62 in size."""
    repeated = pinned(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    n = repeated.count()
    if not n:
        return None
    top = docs.agg(F.max(F.col("doc_id").cast("bigint"))).first()[0]
    numbered = pinned(
        join_small(docs, repeated, ["doc_id"], "left_semi", n, COPIED)
        .select(F.col("doc_id").cast("bigint").alias("id"), "text", (F.lit(top + 1) + F.monotonically_increasing_id()).alias("node")), "numbered-rows")
    others = join_small(docs, repeated, ["doc_id"], "left_anti", n, COPIED).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return others.unionByName(numbered.select(F.col("node").alias("doc_id"), "text")), numbered.select("node", "id")


def join(docs: DataFrame, threshold: Fraction = Fraction(3, 4)) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Rows of one id are one document.  Where an id is repeated its rows are joined as documents of
    their own first, so that each of its texts finds its links, and then made one.
    """
    docs = docs.select("doc_id", "text")
    separate = apart(docs)
    if separate is None:
        return join_texts(docs, threshold)
    rows, numbers = separate
    found = pinned(join_texts(rows, threshold), "text-components")
    n = numbers.count()
    one = numbers.select(F.col("node").alias("doc_id"), "id")
    two = numbers.select(F.col("node").alias("component_id"), F.col("id").alias("to"))
    named = join_small(join_small(found, one, ["doc_id"], "left", n, COPIED), two, ["component_id"], "left", n, COPIED)
    named = pinned(named.select(F.coalesce("id", "doc_id").alias("id"), "n_shingles", F.coalesce("to", "component_id").alias("to")), "named-components")
    roots = connected_components(named.where("id IS NOT NULL").select(F.col("id").alias("a"), F.col("to").alias("b")))
    return named.drop("to").join(roots, "id", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def join_texts(docs: DataFrame, threshold: Fraction) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, where no id stands on rows of different texts."""
    described = describe(docs)
    sets = described.where("kind = 0").select("id", "n", "a", "b")
    hot, counts = known_frequencies(described)
    named = sets.where("id IS NOT NULL AND n > 0")
    classes = named.groupBy("a", "b", "n").agg(F.min("id").alias("rep"))
    members = pinned(named.join(classes, ["a", "b", "n"]).select("id", "rep", "n").distinct(), "set-classes")
    copies = members.where("id <> rep").select(F.col("id").alias("doc_id")).distinct()
    base = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    single = join_small(base, copies, ["doc_id"], "left_anti", copies.count(), COPIED)
    hits = shared_signatures(index_rows(single, threshold, hot, counts))
    texts = single.select(F.col("doc_id").cast("bigint").alias("id"), "text")

    ordered = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    sketches = pinned(described.where("kind = 0 AND id IS NOT NULL AND n > 0").groupBy("id").agg(
        F.max_by(F.struct("n", "sketch", "short"), "n").alias("s")).select("id", "s.*"), "sketches")
    # Each set is compared with the leader it meets most often.
    met = hits.where("id <> leader").groupBy("id", "leader").agg(F.count("*").alias("times"))
    best = met.groupBy("id").agg(F.max(F.struct("times", (-F.col("leader")).alias("leader"))).alias("m"))
    star = pinned(best.select(*ordered(-F.col("m.leader"), F.col("id"))).distinct(), "leader-pairs")
    linked = pinned(verify(star, sketches, texts, threshold), "leader-links")
    same_id = members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    settled = connected_components(linked.unionByName(same_id))

    # Signatures whose sets are in one component by now have nothing left to find.
    n_settled = settled.count()
    placed = join_small(hits.drop("leader"), settled, ["id"], "left", n_settled).withColumn("component", F.coalesce("component_id", "id")).drop("component_id")
    mixed_keys = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("sets")).where("low <> high").select("key", "sets")
    left = pinned(placed.join(mixed_keys, "key"), "open-signatures")
    rest = pinned(open_pairs(left, sketches, threshold).join(star, ["a", "b"], "left_anti"), "open-pairs")
    more = verify(rest, sketches, texts, threshold)
    roots = connected_components(linked.unionByName(more).unionByName(same_id))

    placed = sets.join(roots, "id", "left")
    return placed.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
