"""Byte-pair encoding of a corpus with a public vocabulary, and decoding."""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.runtime import spread

VOCABULARIES = "/opt/tokenizers"
#: Fixed value: the published pre-tokenisation pattern of this vocabulary.
PIECES = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHED, CACHED_LENGTH = 1 << 17, 64


class Encoder:
    """A byte-level BPE vocabulary given as ranks: a token's id is its merge rank."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.byte = [self.ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        self.cache: dict[str, list[int]] = {}

    def merged(self, a: int, b: int) -> int:
        """The id (and rank) of two symbols merged, or -1."""
        got = self.pairs.get((a, b))
        if got is None:
            got = self.ranks.get(self.tokens[a] + self.tokens[b], -1)
            if len(self.pairs) < CACHED:
                self.pairs[a, b] = got
        return got

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece.

        The symbols form a doubly linked list; a heap holds the merges that were possible when they were pushed, by rank, then
        from the left. An entry whose symbols have changed since is skipped.
        """
        sym = [self.byte[b] for b in piece]
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := self.merged(sym[i], sym[i + 1])) >= 0]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            if sym[i] != a:
                continue
            j = right[i]
            if j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = rank, -1
            k = right[j]
            right[i] = k
            if k < n:
                left[k] = i
                if (r := self.merged(rank, sym[k])) >= 0:
                    heapq.heappush(heap, (r, i, rank, sym[k]))
            h = left[i]
            if h >= 0 and (r := self.merged(sym[h], rank)) >= 0:
                heapq.heappush(heap, (r, h, sym[h], rank))
        return [s for s in sym if s >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        cache = self.cache
        for piece in PIECES.findall(text):
            ids = cache.get(piece)
            if ids is None:
                ids = self.merge(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= CACHED_LENGTH:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: their strings of bytes one after another. An id outside the vocabulary raises KeyError."""
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder a process."""
    return Encoder(path)


def _path(name: str, folder: str) -> str:
    return os.path.join(folder, f"{name}.tiktoken")


def encode_texts(docs: DataFrame, *, ident: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """``ident, ids``: the token ids of each row's text, no special tokens; an empty list for empty and NULL texts.

    Text that looks like a special token is plain text. Blank texts have the ids of their blanks. Rows given twice come out
    twice, a NULL ident stays. Works row by row; ``folder`` must exist on every worker.
    """
    path = _path(name, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            flat: list[int] = []
            at = [0]
            for t in b.column(1).to_pylist():
                if t:
                    flat += enc.encode(t)
                at.append(len(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))], names=[ident, "ids"])

    kind = docs.schema[ident].dataType.simpleString()
    return spread(docs.select(F.col(ident), F.col(text).cast("string").alias("text"))).mapInArrow(run, f"{ident} {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, *, ident: str = "doc_id", ids: str = "ids", name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """``ident, text``: the text of each row's ids; the empty text for an empty or NULL list."""
    path = _path(name, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([enc.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=[ident, "text"])

    kind = encoded.schema[ident].dataType.simpleString()
    return encoded.select(F.col(ident), F.col(ids).cast("array<int>")).mapInArrow(run, f"{ident} {kind}, text string")
