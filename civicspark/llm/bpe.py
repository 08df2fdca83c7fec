"""Byte-pair encoding and decoding of whole texts (operator 2).

Each word is a doubly linked list of symbols.  A heap holds the ranks of neighbouring pairs;
the lowest rank is merged first, the leftmost of equal ones, and an entry whose pair has
changed since it was pushed is skipped.  Decoding concatenates vocabulary strings.

A null or empty text has no tokens.  Every row gives one row; repeated rows stay repeated and
null ids stay null; an empty table gives no rows.  Only the key and the text are read, so other
columns may have any name.  A text of any length is encoded whole; words and runs met of late
are remembered, up to a fixed number.  The vocabulary file must describe what ``WordBpe`` implements: NFC, white
space to blanks, lower case, the word pattern, bytes as characters, a word-end suffix and no
decoder (tokens are then joined by one blank).
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.support import ship

#: The characters of Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Fixed value: the word pattern of the vocabulary file.
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
_SPLIT_DIFFERS = regex.compile("[\x1c-\x1f]")  # str.split() cuts there, the pattern does not
_WHITE_RUN = regex.compile(f"[{WHITE}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    shown = set(printable)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder of one vocabulary.  ``cache_words`` bounds the words it remembers."""

    def __init__(self, path: str, cache_words: int = 300_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # Symbols are numbers: a token's id, or one above all ids for a symbol without one.
        symbols = [c + end for end in ("", self.suffix) for c in byte_symbols()]
        beyond = itertools.count(max(self.strings, default=0) + 1)
        number = self.vocab | {c: next(beyond) for c in dict.fromkeys(symbols) if c not in self.vocab}
        self.inner, self.final = [number[c] for c in symbols[:256]], [number[c] for c in symbols[256:]]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {number[a] << 32 | number[b]: rank for rank, (a, b) in enumerate(pairs) if a in number and b in number}
        self.merged = [number[a + b] if a + b in number else next(beyond) for a, b in pairs]
        self.known: dict[str, tuple[str, str]] = {}
        self.former: dict[str, tuple[str, str]] = {}
        self.cache_words = cache_words

    def merge(self, parts: list[int]) -> list[int]:
        """Symbols of one word after all merges.  An entry of the heap is rank << 32 | place."""
        rank_of, merged, n = self.ranks.get, self.merged, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := rank_of(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j, left = after[i], parts[i]
            if left < 0 or j >= n or rank_of(left << 32 | parts[j]) != rank:
                continue  # stale
            parts[i] = left = merged[rank]
            parts[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(left << 32 | parts[k])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank_of(parts[h] << 32 | left)) is not None:
                heapq.heappush(heap, r << 32 | h)
        return [p for p in parts if p >= 0]

    def _word(self, word: str) -> tuple[str, str]:
        """Ids and strings, each joined by blanks, of one word of the pattern."""
        code = word.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in code]
        parts[-1] = self.final[code[-1]]
        ids = [i for i in self.merge(parts) if i in self.strings]
        return " ".join(map(str, ids)), " ".join([self.strings[i] for i in ids])

    def _words(self, run: str) -> tuple[str, str]:
        """The same of a run without white space; runs and the words in them are remembered."""
        found = self.former.get(run)
        if found is None:
            words = [run] if run.isalpha() and run.isascii() else WORD.findall(run)
            if len(words) == 1:
                found = self._word(words[0])
            else:
                each = [self.known.get(w) or self._words(w) for w in words]
                found = " ".join([a for a, _ in each if a]), " ".join([b for a, b in each if a])
        if len(self.known) >= self.cache_words:
            self.known, self.former = {}, self.known  # what was not asked for of late goes
        self.known[run] = found
        return found

    def _piece(self, text: str) -> list[tuple[str, str]]:
        if not text.isascii():
            # Lower case is taken of each character alone, so a final sigma is not special.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        chunks = [c for c in _WHITE_RUN.split(text) if c] if _SPLIT_DIFFERS.search(text) else text.split()
        make = self._words
        return [self.known.get(c) or make(c) for c in chunks]

    def encode(self, text: str | None) -> tuple[str, str]:
        """Decimal ids and token strings of a text, each joined by one blank."""
        if not text:
            return "", ""
        found: list[tuple[str, str]] = []
        for piece in self.cut.split(text) if self.cut else (text,):
            if piece in self.special:
                found.append((str(self.special[piece]), piece))
            elif piece:
                found += self._piece(piece)
        return " ".join([a for a, _ in found if a]), " ".join([b for a, b in found if a])

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids if i in self.strings)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder per vocabulary and worker process."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its key, ``ids`` and ``decoded`` (both text, joined by blanks)."""
    ship(docs.sparkSession)
    schema = f"`{key}` {dict(docs.dtypes)[key]}, ids string, decoded string"

    def run(batches):
        bpe = encoder(vocabulary)
        for batch in batches:
            coded = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a for a, _ in coded], pa.string()), pa.array([b for _, b in coded], pa.string())],
                names=[key, "ids", "decoded"],
            )

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def token_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of ids and decoded text, taken where the tokens are made."""
    ship(docs.sparkSession)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches):
        bpe = encoder(vocabulary)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                a, b = bpe.encode(text)
                counts.append(a.count(" ") + 1 if a else 0)
                ids.append(digest(a))
                decoded.append(digest(b))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
