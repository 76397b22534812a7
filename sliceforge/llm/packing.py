"""Packing along a space-filling curve.

Each document's hashed bag of words is projected by hashed signs to a few dimensions; the projections,
spread by a logistic curve, are cell coordinates of a Hilbert curve, whose key range-sorts the documents. Neighbours on the curve are alike, and are laid end to end and cut every
`length` tokens. Each range partition is laid out by itself; the end of a partition is cut into
sequences whose lengths are powers of two, which need no padding. So no id is padded or shared.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sliceforge.llm.bpe import odd
from sliceforge.llm.textkit import NON_LETTERS, U, Words, column, portions, rows, utf8
from sliceforge.runtime import materialize, ship, table

DIMS = 3
LEVELS = 10
END = 0
#: Bytes of packed ids in a range partition.
PART_BYTES = 24 << 20


def project(texts: list[bytes]) -> np.ndarray:
    """(texts, DIMS) in [0, 1): each word adds a hashed sign in each dimension; the sum is scaled by its spread."""
    w = Words(texts, NON_LETTERS, lower=True)
    h = w.hashes()
    n = np.diff(w.first)
    out = np.zeros((len(texts), DIMS))
    for d in range(DIMS):
        sign = ((h >> U(11 + 7 * d)) & U(1)).astype(np.int64) * 2 - 1
        total = np.concatenate(([0], np.cumsum(sign)))
        out[:, d] = (total[w.first[1:]] - total[w.first[:-1]]) / np.sqrt(np.maximum(n, 1))
    # a logistic curve spreads sums of random signs about evenly over the cells
    return 1 / (1 + np.exp(-out))


def hilbert(cells: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Hilbert key of integer cells (n, dims): the transpose form, Gray-decoded, then interleaved."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (levels - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            up = (x[i] & q) > 0
            x[0] = np.where(up, x[0] ^ p, x[0])
            t = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] ^= t
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (levels - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(levels - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


_encoders: dict[str, tuple] = {}


def _byte_values() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, back to its byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranked(path: str) -> tiktoken.Encoding | None:
    """The same vocabulary as ranks, where its ids follow the order of its merges; a faster library then gives the same ids."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in merged or any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        return None
    value, joined = _byte_values(), set(merged)
    ranks = {bytes(map(value.__getitem__, t)): i for t, i in model["vocab"].items() if all(c in value for c in t) and (len(t) == 1 or i in joined)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encoder(path: str) -> tuple:
    """A worker's tokenizer, its faster equal (or None), the texts of special tokens and the number type of ids."""
    if path not in _encoders:
        t = Tokenizer.from_file(path)
        width = "<u2" if t.get_vocab_size() <= 1 << 16 else "<u4"
        _encoders[path] = (t, _ranked(path), [a.content for a in t.get_added_tokens_decoder().values()], width)
    return _encoders[path]


def token_bytes(texts: list[str], path: str) -> tuple[list[bytes], str]:
    """Packed ids of each text, as the library gives them, and their number type.

    Texts with runs of white space or the text of a special token go to the library itself.
    """
    t, ranked, special, width = _encoder(path)

    def ids(text: str) -> list[int]:
        if ranked is None or odd(text) or any(s in text for s in special):
            return t.encode(text, add_special_tokens=False).ids
        return ranked.encode_ordinary(text)

    return [np.array(ids(x), width).tobytes() for x in texts], width


def tokenized(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs -> doc_id, key (place on the curve), n (tokens with the end id), ids (two bytes each), a row for a row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches, 1 << 20):
            ids, width = token_bytes([t or "" for t in texts], path)
            end = np.array([END], width).tobytes()
            ids = [i + end for i in ids]
            size = len(end)
            cells = np.minimum((project(utf8(texts)) * (1 << LEVELS)).astype(np.int64), (1 << LEVELS) - 1)
            yield rows(doc_id=column(b, "doc_id"), key=hilbert(cells), n=pa.array([len(i) // size for i in ids], pa.int64()), width=np.full(len(ids), size, np.int32), ids=pa.array(ids, pa.binary()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, key long, n long, width int, ids binary")


def tail(rest: int) -> list[int]:
    """Lengths of the last sequences: the binary digits of what is left."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Layout:
    """Lays the documents of one partition end to end; only the sequence that is being filled is held."""

    def __init__(self, length: int):
        self.length, self.filled, self.sequence = length, 0, 0
        self.open: list[tuple] = []  # pieces of the unfinished sequence, with their ids

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            size = min(len(ids) - at, self.length - self.filled)
            self.open.append((doc_id, at, ids[at : at + size], len(ids)))
            self.filled += size
            at += size
            if self.filled == self.length:
                yield from self._close([self.length])

    def end(self) -> Iterator[tuple]:
        yield from self._close(tail(self.filled))

    def _close(self, lengths: list[int]) -> Iterator[tuple]:
        """Cuts the held pieces into sequences of the given lengths."""
        room, offset, left = 0, 0, iter(lengths)
        for doc_id, start, ids, total in self.open:
            at = 0
            while at < len(ids):
                if room == 0:
                    room, offset = next(left), 0
                size = min(room, len(ids) - at)
                yield doc_id, start + at, size, _crc(ids[at : at + size]), total, self.sequence, offset
                at, offset, room = at + size, offset + size, room - size
                if room == 0:
                    self.sequence += 1
        self.open, self.filled = [], 0


_LAID = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence", "offset"]


def pack(docs: DataFrame, path: str, length: int = 1024, text: str = "text") -> DataFrame:
    """docs -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document ends with id 0, so null and empty texts give one token. Sequences are full except at
    the end of a partition, where their lengths are powers of two; none is padded. Ties on the curve go
    by doc_id, then by content; copies may be split between partitions, so a large group of copies is
    dealt evenly. Rows with a null doc_id and repeated rows are packed as well. An empty table gives none.
    """
    spark = docs.sparkSession
    # written once: ordering by range reads its input twice
    done = materialize(tokenized(docs, path, text), "tokens")
    size = done.agg(F.sum(F.col("n") * F.col("width")).alias("b")).first().b or 0
    parts = max(spark.sparkContext.defaultParallelism, size // PART_BYTES + 1)
    order = ["key", "doc_id", "digest"]
    ranged = done.withColumn("digest", F.xxhash64("ids")).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, part = Layout(length), TaskContext.get().partitionId()

        def written(found: list[tuple]) -> pa.RecordBatch:
            return rows(**{c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate(_LAID)}, part=np.full(len(found), part, np.int32))

        for b in batches:
            found = []
            for doc_id, width, ids in zip(column(b, "doc_id").to_pylist(), column(b, "width").to_pylist(), column(b, "ids"), strict=True):
                found += layout.add(doc_id, np.frombuffer(ids.as_buffer(), "<u2" if width == 2 else "<u4"))
            yield written(found)
        yield written(list(layout.end()))

    laid = materialize(
        ranged.select("doc_id", "width", "ids").mapInArrow(
            run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, part int"
        ),
        "laid",
    )
    # a row for each partition: where its sequences start among all
    counts = laid.groupBy("part").agg((F.max("sequence") + 1).alias("n")).orderBy("part").collect()
    firsts, seen = [], 0
    for r in counts:
        firsts.append((r.part, seen))
        seen += r.n
    base = F.broadcast(spark.createDataFrame(firsts, "part int, first long"))
    return laid.join(base, "part").select(*_LAID[:5], (F.col("first") + F.col("sequence")).alias("sequence_id"), "offset")


def op10(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
