"""Byte-level BPE encoding and decoding by recursive queries (operator 13).

Spark deals the texts out; inside a task an embedded SQL engine does the merges.  The words of
a chunk of texts that are not known yet become rows of token positions.  One recursive query
joins neighbouring positions with the merge table, contracts each word's leftmost pair of the
least rank, and repeats until no pair of any word stands in the table.  An aggregation ordered
by position then gives each word's ids and, joined with the vocabulary, its decoded bytes.

Words longer than ``LONG`` bytes take a second form of the query: it contracts, from the left,
all pairs of the least rank that do not overlap, where no merge with the new token has a lower
rank (else the leftmost alone).  The order of merges is the same, in fewer steps.

A word that is itself in the vocabulary is one token.  A null or empty text has no tokens; every
row gives one row; repeated rows stay repeated, null ids stay null and an empty table gives no
rows.  Only the key and the text are read, so other columns may have any name.  A text of any
length is cut into words as it is read, ``SEGMENT`` of them at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.support import ship

#: Characters of text encoded together, words of one piece of a text, words remembered,
#: bytes of a long word, and bytes of the words of one query.
CHUNK, SEGMENT, REMEMBERED, LONG, QUERY_BYTES = 4_000_000, 200_000, 250_000, 64, 1_000_000

#: One contraction of each word a step.  A row is a live token: p is its first byte, q the next
#: token's.  The head of the pair takes the new token, the tail is marked dead (-1) and left out
#: of the chain, all other rows stay.  A word without a pair has no rows and is finished.
_LEFTMOST = """
WITH RECURSIVE state(p, w, t, q) USING KEY (p) AS (
    SELECT p, w, t, q FROM start
    UNION ALL
    (WITH best AS (
        SELECT s.w, arg_min({'head': s.p, 'tail': s.q, 'next': n.q, 'token': m.rank}, m.place + s.p) AS pair
        FROM state s JOIN state n ON n.p = s.q JOIN merges m ON m.ab = s.t::BIGINT * 2147483648 + n.t
        WHERE s.t >= 0 GROUP BY s.w)
    SELECT s.p, s.w,
        CASE WHEN s.p = pair.head THEN pair.token WHEN s.p = pair.tail THEN -1 ELSE s.t END,
        CASE WHEN s.p = pair.head THEN pair.next ELSE s.q END
    FROM state s JOIN best ON best.w = s.w WHERE s.t >= 0)
)"""
#: The same with all pairs of the least rank at once, every other one of a run of overlapping pairs.
_ALL_OF_RANK = """
WITH RECURSIVE state(p, w, t) USING KEY (p) AS (
    SELECT p, w, t FROM start
    UNION ALL
    (WITH pairs AS (
        SELECT p, w, t, lead(t) OVER (PARTITION BY w ORDER BY p) AS u FROM state WHERE t >= 0),
    ranked AS (
        SELECT s.*, m.rank, m.alone, m.place + s.p AS place
        FROM pairs s LEFT JOIN merges m ON m.ab = s.t::BIGINT * 2147483648 + s.u),
    least AS (
        SELECT *, min(place) OVER (PARTITION BY w) AS low, row_number() OVER (PARTITION BY w ORDER BY p) AS n FROM ranked),
    hits AS (
        SELECT *, coalesce(rank = low >> 32 AND (NOT alone OR place = low), false) AS hit FROM least WHERE low IS NOT NULL),
    runs AS (
        SELECT *, n - coalesce(max(CASE WHEN NOT hit THEN n END) OVER (PARTITION BY w ORDER BY p), 0) AS nth FROM hits),
    heads AS (
        SELECT *, coalesce(lag(nth % 2 = 1) OVER (PARTITION BY w ORDER BY p), false) AS tail FROM runs)
    SELECT p, w, CASE WHEN nth % 2 = 1 THEN rank WHEN tail THEN -1 ELSE t END FROM heads)
)"""
_GATHERED = """
SELECT w, string_agg(t::VARCHAR, ',' ORDER BY p) AS ids, string_agg(hex, '' ORDER BY p) AS decoded
FROM state JOIN vocabulary ON id = t WHERE t >= 0 GROUP BY w"""


def white_space_as_engine(pattern: str) -> str:
    """The pattern with the library's meaning of white space, Unicode's property, spelled out."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class RecursiveBpe:
    """Encoder of one rank file, with the words it met of late."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing}")
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(white_space_as_engine(pattern))
        self.known: dict[str, tuple[str, bytes]] = {}
        self.former: dict[str, tuple[str, bytes]] = {}
        # One thread, since each task has a core; nothing is spilled to a disk of the machine.
        self.sql = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        pairs = [
            (left, right, rank) for word, rank in self.ranks.items() for cut in range(1, len(word))
            if (left := self.ranks.get(word[:cut])) is not None and (right := self.ranks.get(word[cut:])) is not None
        ]
        a, b, rank = (np.array(x, np.int32) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int32),) * 3
        lowest = np.full(int(max(self.ranks.values())) + 1, np.iinfo(np.int32).max, np.int32)
        np.minimum.at(lowest, a, rank)
        np.minimum.at(lowest, b, rank)
        self._keep("merges", pa.table({
            "ab": (a.astype(np.int64) << 31) + b, "rank": rank, "place": rank.astype(np.int64) << 32, "alone": lowest[rank] < rank}))
        self._keep("vocabulary", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [w.hex() for w in self.ranks]}))

    def _keep(self, name: str, rows: pa.Table) -> None:
        self.sql.register("given", rows)
        self.sql.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.sql.unregister("given")

    def merged(self, words: list[bytes]) -> list[tuple[str, bytes]]:
        """Ids, joined by commas, and decoded bytes of each word, by the recursive query."""
        out: list[tuple[str, bytes]] = [("", b"")] * len(words)
        for is_long, recursion in ((False, _LEFTMOST), (True, _ALL_OF_RANK)):
            places = [i for i, w in enumerate(words) if (len(w) > LONG) == is_long]
            sizes = np.array([len(words[i]) for i in places], np.int64)
            part = np.cumsum(sizes) // QUERY_BYTES
            for k in np.unique(part):
                chosen = np.flatnonzero(part == k)
                symbols = self.of_byte[np.frombuffer(b"".join(words[places[i]] for i in chosen), np.uint8)]
                p = np.arange(len(symbols), dtype=np.int32)
                after = p + 1
                after[np.cumsum(sizes[chosen]) - 1] = -1  # the last byte of a word has no next one
                self.sql.register("start", pa.table({"p": p, "w": np.repeat(chosen.astype(np.int32), sizes[chosen]), "t": symbols, "q": after}))
                rows = self.sql.execute(recursion + _GATHERED).fetchall()
                self.sql.unregister("start")
                for w, ids, decoded in rows:
                    out[places[w]] = ids, bytes.fromhex(decoded)
        return out

    def learn(self, words: set[str]) -> None:
        """Make all these words known; what was known before gives way by age."""
        if len(self.known) > REMEMBERED:
            self.known, self.former = {}, self.known
        fresh: list[str] = []
        for word in words:
            if word in self.known:
                continue
            if (found := self.former.get(word)) is not None:
                self.known[word] = found
            elif (rank := self.ranks.get(code := word.encode())) is not None:
                self.known[word] = str(rank), code  # a word of the vocabulary is one token
            else:
                fresh.append(word)
        if fresh:
            self.known.update(zip(fresh, self.merged([w.encode() for w in fresh]), strict=True))

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The words of a text, ``SEGMENT`` at a time where the text is long."""
        if len(text) <= CHUNK:
            yield self.pattern.findall(text)
            return
        found = (m[0] for m in self.pattern.finditer(text))
        while piece := list(islice(found, SEGMENT)):
            yield piece

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[int, str, bytes]]:
        """(row, ids, bytes) of every piece of every text, in order; a row may have several."""
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush():
            self.learn(set().union(*(words for _, words in held)))
            for row, words in held:
                found = [self.known[w] for w in words]
                yield row, ",".join(map(itemgetter(0), found)), b"".join(map(itemgetter(1), found))
            held.clear()

        for row, text in enumerate(texts):
            for words in self.pieces(text) if text else ():
                held.append((row, words))
                size += sum(map(len, words)) if len(text) > CHUNK else len(text)
                if size >= CHUNK:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> RecursiveBpe:
    """One encoder per rank file and worker process."""
    return RecursiveBpe(path, pattern)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its key, ``ids`` (array of int) and ``decoded`` (the bytes of the ids)."""
    ship(docs.sparkSession)

    def run(batches):
        bpe = encoder(ranks, pattern)
        for batch in batches:
            ids: list[list[int]] = [[] for _ in range(batch.num_rows)]
            decoded = [bytearray() for _ in range(batch.num_rows)]
            for row, some, code in bpe.encoded(batch.column(1).to_pylist()):
                ids[row] += map(int, some.split(","))
                decoded[row] += code
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(bytes, decoded), pa.binary())], names=[key, "ids", "decoded"])

    schema = f"`{key}` {dict(docs.dtypes)[key]}, ids array<int>, decoded binary"
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def token_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Digests of ids and decoded bytes, taken piece by piece where the tokens are made."""
    ship(docs.sparkSession)

    def run(batches):
        bpe = encoder(ranks, pattern)
        for batch in batches:
            n = batch.num_rows
            counts, ids, decoded = [0] * n, [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
            for row, some, code in bpe.encoded(batch.column(1).to_pylist()):
                ids[row].update((("," if counts[row] else "") + some).encode())
                decoded[row].update(code)
                counts[row] += some.count(",") + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array([h.hexdigest() for h in ids]), pa.array([h.hexdigest() for h in decoded])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
