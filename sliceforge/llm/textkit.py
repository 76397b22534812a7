"""Vectorised word tables: words of many texts at once, each with a 64-bit hash, without a Python object a word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
_BASE, _BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

#: The word separators of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True

#: Everything but ASCII letters, ASCII digits and the bytes of longer characters.
NON_LETTERS = np.ones(256, bool)
NON_LETTERS[128:] = False
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    NON_LETTERS[_lo:_hi] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, others spread over all bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h = h * U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


#: Longer words are hashed one at a time by a 128-bit library hash.
_LONG = 256
_KEYS = (U(0x2545F4914F6CDD1D), U(0xD1342543DE82EF95))
_ODD = (U(0x9FB21C651E98DF25), U(0xDA942042E4DD58B5))
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hash of each word buf[start:end], eight bytes a step; the two lanes are independent functions of the bytes."""
    size = end - start
    h = mix(size.astype(U) * _ODD[1 - lane] + _KEYS[lane])
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate((buf, np.zeros(8, np.uint8))), 8)
    open_ = np.flatnonzero(size <= _LONG)
    at, left = start[open_], size[open_]
    while len(open_):
        step = eight[at].view("<u8")[:, 0] & _MASK[np.minimum(left, 8)]
        h[open_] = mix((h[open_] ^ step) * _ODD[lane])
        more = left > 8
        open_, at, left = open_[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _LONG).tolist():
        both = xxhash.xxh3_128_intdigest(buf[start[i] : end[i]].tobytes(), seed=42)
        h[i : i + 1] = mix(h[i : i + 1] ^ U(both >> 64 * lane & 0xFFFFFFFFFFFFFFFF))
    return h


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base (or of its inverse) modulo 2**64."""
    key = "inv" if inverse else "pow"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 18)
        steps = np.full(size, U(_BASE_INV if inverse else _BASE))
        steps[0] = U(1)
        have = _powers[key] = np.cumprod(steps)
    return have[:n]


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free polynomial hashes of [start, end) from prefix sums of value * base**position."""
    return (prefix[end] - prefix[start]) * powers(len(prefix), True)[start]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


class Words:
    """Words of several texts in one byte buffer.

    start, end: byte offsets of each word; first: index of each text's first word, with the total
    at the end; text_at: byte offset of each text in the buffer.
    """

    def __init__(self, texts: Sequence[bytes], separators: np.ndarray = SPACES, lower: bool = False):
        buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.buf = LOWER[buf] if lower else buf
        lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.text_at = np.concatenate(([0], np.cumsum(lens + 1)))
        inside = ~separators[self.buf]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.text_at)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, longest: int | None = None, lane: int = 0) -> np.ndarray:
        """Hash of each word, or of its first `longest` bytes."""
        end = self.end if longest is None else np.minimum(self.end, self.start + longest)
        return word_hashes(self.buf, self.start, end, lane)

    def text_of(self) -> np.ndarray:
        """Index of the text that holds each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def slices(texts: Sequence[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes together (one longer text stands alone)."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def utf8(values) -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in values]


def column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library keeps its own account
    _trim = None


def give_back() -> None:
    """Hands freed memory back to the system; a reused worker would keep its peak otherwise."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def portions(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20, name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Arrow batches in portions of about `limit` bytes of a text column, each with its texts; so little is held at once.

    Every column of a portion keeps its exact values, whole numbers beside nulls included.
    """
    for b in batches:
        text = column(b, name)
        size = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        edges = (np.flatnonzero(np.diff(size // limit)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, len(size)], strict=True):
            yield b.slice(lo, hi - lo), text.slice(lo, hi - lo).to_pylist()
    give_back()


def rows(**columns) -> pa.RecordBatch:
    """A record batch of named columns: Arrow arrays as they are, lists and numpy arrays converted."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
