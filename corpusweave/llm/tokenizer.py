"""Byte-level BPE with a hierarchical-bitmap rank queue, and its use over a whole corpus.

Merging one pre-token keeps a linked list of its tokens and, per merge rank, a bucket of the list positions whose pair has
that rank. Three levels of 64-bit words mark the buckets in use; find-first-set on each level gives the lowest rank, so the
next merge costs the same for a pre-token of ten bytes and of a million. Entries are never removed when a neighbour changes:
an entry whose pair no longer has the rank is stale and is skipped when its bucket comes up.

Defined cases: NULL and empty texts have no ids (an empty list); a text of blanks is not empty. Special tokens are not
used: their strings are ordinary text. Very long texts and pre-tokens are processed whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern that belongs to the byte_bpe vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Pre-tokens kept with their ids in a worker; a full cache starts over.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 64
#: Ids that one output batch may hold before it is handed on.
FLUSH_IDS = 2_000_000


def default_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The place of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


class RankQueue:
    """Buckets of positions by rank; three bitmap levels find the lowest rank in use."""

    __slots__ = ("buckets", "low", "mid", "top")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}
        self.mid: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        a, b = rank >> 6, rank >> 12
        self.low[a] = self.low.get(a, 0) | 1 << (rank & 63)
        self.mid[b] = self.mid.get(b, 0) | 1 << (a & 63)
        self.top |= 1 << b

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its positions in order; the bucket is emptied."""
        b = (self.top & -self.top).bit_length() - 1
        word = self.mid[b]
        a = (b << 6) + (word & -word).bit_length() - 1
        word = self.low[a]
        rank = (a << 6) + (word & -word).bit_length() - 1
        word &= word - 1
        self.low[a] = word
        if not word:
            self.mid[b] &= ~(1 << (a & 63))
            if not self.mid[b]:
                self.top &= ~(1 << b)
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions


class ByteBpe:
    """A byte-level BPE vocabulary given as ranks of byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.split = regex.compile(PATTERN).findall
        self.cache: dict[str, list[int]] = {}

    @classmethod
    def from_bytes(cls, blob: bytes) -> ByteBpe:
        """Lines of a base64 token and its rank."""
        return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line)})

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        alive = bytearray(b"\x01") * n
        queue = RankQueue()
        get = ranks.get
        for i in range(n - 1):
            r = get(piece[i : i + 2])
            if r is not None:
                queue.push(r, i)
        while queue.top:
            rank, positions = queue.pop()
            for k, i in enumerate(positions):
                j = after[i] if alive[i] else n
                if j >= n or get(piece[i : after[j]]) != rank:
                    continue  # stale
                end = after[j]
                after[i] = end
                alive[j] = 0
                lower = False
                if end < n:
                    before[end] = i
                    r = get(piece[i : after[end]])
                    if r is not None:
                        queue.push(r, i)
                        lower = r < rank
                p = before[i]
                if p >= 0:
                    r = get(piece[p:end])
                    if r is not None:
                        queue.push(r, p)
                        lower = lower or r < rank
                if lower:  # a vocabulary in no merge order: the lower rank goes first
                    for q in positions[k + 1 :]:
                        queue.push(rank, q)
                    break
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text."""
        if not text:
            return []
        cache, out = self.cache, []
        for w in (_ASCII.findall if text.isascii() else self.split)(text):
            ids = cache.get(w)
            if ids is None:
                ids = self.merge(w.encode())
                if len(w) <= CACHE_CHARS:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[w] = ids
            out += ids
        return out


_LOADED: dict[int, ByteBpe] = {}


def _tokenizer(blob: bytes) -> ByteBpe:
    key = hash(blob)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe.from_bytes(blob)
    return _LOADED[key]


def _source(df: DataFrame, id_col: str, text_col: str, path: str | None):
    with open(path or default_path(), "rb") as f:
        blob = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: its size doesn't depend on the data
    return blob, df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def encode_corpus(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """``id, ids`` for every row, in the rows' own partitions; ``path`` is the vocabulary file."""
    blob, src = _source(df, id_col, text_col, path)
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(blob.value)
        for b in batches:
            start, flat, ends = 0, [], [0]
            for k, text in enumerate(b.column(1).to_pylist()):
                flat += t.encode(text)
                ends.append(len(flat))
                if len(flat) >= FLUSH_IDS or k == b.num_rows - 1:
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(start, k + 1 - start), ids], names=["id", "ids"])
                    start, flat, ends = k + 1, [], [0]

    return src.mapInArrow(run, f"id {id_type}, ids array<int>")


def token_counts(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """``id, tokens`` and the columns ``keep`` for every row: the same encoding, of which only the length is kept."""
    blob, src = _source(df, id_col, text_col, path)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *keep)
    kinds = "".join(f", `{k}` {src.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(blob.value)
        for b in batches:
            n = pa.array([len(t.encode(x)) for x in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n, *(b.column(2 + i) for i in range(len(keep)))], names=["id", "tokens", *keep])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, tokens bigint{kinds}")
