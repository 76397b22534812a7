"""Byte-level BPE encoding and decoding.

Tier one: a minimal perfect hash over the vocabulary resolves whole pre-tokens that are tokens
themselves. Tier two: other pre-tokens are merged by a heap of candidate pairs over a linked list of
bytes. Results of both tiers are kept in a bounded table for each Python worker, so that a frequent
piece is resolved once.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.llm.textkit import column, portions, rows
from sliceforge.runtime import ship, table

#: Pieces kept for each worker before the table is emptied.
KEPT = 800_000
#: White space other than space and line feed (fixed values: Unicode White_Space and what str.isspace adds).
_RARE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")


def odd(text: str) -> bool:
    """Whether white space may stand beside a space, so that a pre-token may reach over a space."""
    return "  " in text or " \n" in text or "\n " in text or _RARE.search(text) is not None


class PerfectHash:
    """Minimal perfect hash by cascading bit arrays: a key settles in the first level where it is alone.

    A key's index is the number of set bits before its own. Indices are dense; a key that was never
    added gets some index or none, so callers compare the stored key.
    """

    def __init__(self, keys: list[bytes], load: float = 2.0):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        rest = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))
        if len(np.unique(rest)) != len(rest):
            raise ValueError("two keys share a hash, or a key is repeated")
        before = 0
        while len(rest):
            size = max(64, int(len(rest) * load))
            at = self._slot(rest, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = before + np.cumsum(alone) - alone
            self.levels.append((size, alone, ranks))
            before += int(alone.sum())
            rest = rest[~alone[at]]

    @staticmethod
    def _slot(h, level: int, size: int):
        h = (h ^ np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
        return ((h >> np.uint64(32)) % np.uint64(size)).astype(np.int64)

    def index(self, keys: list[bytes]) -> np.ndarray:
        """Index of each key, -1 where no level has it."""
        h = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, alone, ranks) in enumerate(self.levels):
            at = self._slot(h[open_], level, size)
            hit = alone[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out


class Codec:
    """Encoder and decoder for a rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.find = regex.compile(pattern).findall
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        tokens = list(self.ranks)
        self.hash = PerfectHash(tokens)
        order = self.hash.index(tokens)
        self.token_at: list[bytes] = [b""] * len(tokens)
        self.rank_at = np.zeros(len(tokens), np.int64)
        for t, i in zip(tokens, order.tolist(), strict=True):
            self.token_at[i] = t
            self.rank_at[i] = self.ranks[t]
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.byte_id = [self.ranks[bytes([b])] for b in range(256)]
        #: Token of every two tokens that make one, by both ids in one number.
        self.pair: dict[int, int] = {}
        for t, i in self.ranks.items():
            for cut in range(1, len(t)):
                a, b = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                if a is not None and b is not None:
                    self.pair[a << 32 | b] = i

    def merge(self, piece: bytes) -> list[int]:
        """Tier two: repeatedly joins the pair of lowest rank, the leftmost of equal ones.

        A heap entry is rank and place in one number; it holds while the place's pair still has that rank.
        """
        pair, n = self.pair, len(piece)
        ids = list(map(self.byte_id.__getitem__, piece))
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank = [pair.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
        rank.append(-1)
        heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if rank[i] != r:
                continue  # one of the two has grown or is gone
            j = after[i]
            k = after[i] = after[j]
            ids[i] = r
            ids[j] = rank[j] = -1
            if k < n:
                before[k] = i
                new = rank[i] = pair.get(r << 32 | ids[k], -1)
                if new >= 0:
                    heappush(heap, new << 32 | i)
            else:
                rank[i] = -1
            h = before[i]
            if h >= 0:
                new = rank[h] = pair.get(ids[h] << 32 | r, -1)
                if new >= 0:
                    heappush(heap, new << 32 | h)
        return [i for i in ids if i >= 0]

    def resolve(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Token ids of distinct pre-tokens: the perfect hash first, the heap for what it misses."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        at = self.hash.index(raw)
        ranks = self.rank_at[at].tolist()
        tokens = self.token_at
        return [(r,) if i >= 0 and tokens[i] == b else tuple(self.merge(b)) for b, i, r in zip(raw, at.tolist(), ranks, strict=True)]

    def known(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Token ids of distinct pre-tokens, through the table of those met before."""
        have = self.pieces
        new = [p for p in pieces if p not in have]
        if len(have) + len(new) > KEPT:
            have.clear()
            new = pieces
        have.update(zip(new, self.resolve(new), strict=True))
        return list(map(have.__getitem__, pieces))

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, as one string each."""
        return self.find(text)

    def encode(self, text: str) -> list[int]:
        pieces = self.split(text)
        names = list(set(pieces))
        ids = dict(zip(names, self.known(names), strict=True))
        return [i for p in pieces for i in ids[p]]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


#: Marks that end a word and are a match by themselves.
_MARKS = frozenset(".,;:!?")


class ChunkTable:
    """Encodes by space-delimited chunks: in ordinary text a pre-token never reaches over a space.

    A chunk is a space and the characters up to the next. Where white space stands beside a
    space, the pattern runs over the whole text instead. `value` turns
    the ids of a chunk into what is kept for it. `words`: the pattern takes letters, with the space
    before them, as one match.
    """

    def __init__(self, split, resolve, value, kept: int = KEPT, words: bool = False):
        self.split, self.resolve, self.value, self.kept, self.words = split, resolve, value, kept, words
        self.rest: dict[str, object] = {}  # what stands after a space
        self.first: dict[str, object] = {}  # what begins a text
        self.alone: dict[str, object] = {}  # pre-tokens of texts that are not cut at spaces

    def __call__(self, texts: list[str]) -> list[list]:
        """For each text the values of its chunks, in order."""
        cut = [(self.split(t), True) if odd(t) else (t.split(" "), False) for t in texts]
        rest, first, alone = set(), set(), set()
        for words, whole in cut:
            if whole:
                alone.update(words)
            else:
                first.add(words[0])
                rest.update(words)
        self._learn(self.rest, rest, " ", self.split)
        self._learn(self.first, first, "", self.split)
        self._learn(self.alone, alone, "", lambda c: [c])
        out = []
        for words, whole in cut:
            if whole:
                out.append(list(map(self.alone.__getitem__, words)))
            else:
                values = list(map(self.rest.__getitem__, words))
                values[0] = self.first[words[0]]
                out.append(values)
        return out

    def _learn(self, have: dict, names: set[str], lead: str, split) -> None:
        new = names - have.keys()
        if len(have) + len(new) > self.kept:
            have.clear()
            new = names
        if not new:
            return
        order = list(new)
        pieces = [self._pieces(c, lead, split) for c in order]
        flat = list({x for p in pieces for x in p})
        ids = dict(zip(flat, self.resolve(flat), strict=True))
        have.update((c, self.value(ids[p[0]] if len(p) == 1 else [i for x in p for i in ids[x]])) for c, p in zip(order, pieces, strict=True))

    def _pieces(self, c: str, lead: str, split) -> list[str]:
        """Matches within a chunk. ASCII letters are one match with the space before them, and a mark after them is another."""
        if self.words and split is self.split and c.isascii():
            if c.isalpha():
                return [lead + c]
            if c[-1:] in _MARKS and c[:-1].isalpha():
                return [lead + c[:-1], c[-1]]
        return split(lead + c) if lead + c else []


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for a worker process and file."""
    key = (path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(path, pattern)
    return _codecs[key]


_tables: dict[tuple[str, str], ChunkTable] = {}


def _text_table(path: str, pattern: str) -> tuple[Codec, ChunkTable]:
    c = codec(path, pattern)
    key = (path, pattern)
    if key not in _tables:
        _tables[key] = ChunkTable(c.split, c.known, tuple)
    return c, _tables[key]


_digest_tables: dict[tuple[str, str], ChunkTable] = {}


def _digest_table(path: str, pattern: str) -> ChunkTable:
    """A worker's table of chunks: number of ids, the ids as written, and the bytes that the ids decode to."""
    key = (path, pattern)
    if key not in _digest_tables:
        c = codec(path, pattern)
        _digest_tables[key] = ChunkTable(c.split, c.known, lambda ids: (len(ids), " ".join(map(str, ids)), c.decode(ids)), KEPT, pattern == public_tokenizers.PATTERN)
    return _digest_tables[key]


def encode_ids(texts: list[str], path: str, pattern: str = public_tokenizers.PATTERN) -> list[list[int]]:
    """Ids of each text."""
    _, chunks = _text_table(path, pattern)
    out = []
    for parts in chunks(texts):
        ids: list[int] = []
        for p in parts:
            ids += p
        out.append(ids)
    return out


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text") -> DataFrame:
    """docs -> doc_id, ids array<int>, a row for a row; null and empty texts have no ids.

    Repeated rows repeat; an empty table gives an empty result; other columns are ignored.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches, 1 << 20):
            yield rows(doc_id=column(b, "doc_id"), ids=pa.array(encode_ids([t or "" for t in texts], path, pattern), pa.list_(pa.int32())))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids -> doc_id, bytes binary; null ids give null."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                yield rows(doc_id=column(part, "doc_id"), bytes=pa.array([None if x is None else c.decode(x) for x in column(part, "ids").to_pylist()], pa.binary()))

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """docs -> doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids and hashes both.

    The ids never leave the worker, so nothing larger than a row of digests is moved.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _digest_table(path, pattern)
        gc.disable()  # the tables hold no cycles, and scanning them over and over costs a seventh of the time
        try:
            for b, texts in portions(batches, 1 << 20):
                n, ids, back = [], [], []
                for parts in chunks([t or "" for t in texts]):
                    counts, written, decoded = zip(*parts, strict=True) if parts else ((), (), ())
                    n.append(sum(counts))
                    ids.append(hashlib.sha256(" ".join(written if all(counts) else filter(None, written)).encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join(decoded)).hexdigest())
                yield rows(doc_id=column(b, "doc_id"), n_tokens=pa.array(n, pa.int64()), ids_sha256=pa.array(ids, pa.string()), decoded_sha256=pa.array(back, pa.string()))
        finally:
            gc.enable()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
