"""Media columns: Netpbm and BMP images as numpy arrays, area resizing, NPY tiles and difference hashes.

Decoders read PBM, PGM and PPM (plain and raw, 8 and 16 bit) and uncompressed BMP (1, 4, 8, 24 and 32
bit). Resizing takes the exact mean over each target cell, also where cell borders cut pixels, from an
integral image. Tiles are NPY files of at most a given edge. A difference hash compares neighbours in a
small grey image.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from io import BytesIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.llm.textkit import column, portions, rows
from sliceforge.runtime import ship, table

ROW = 64
#: Rows of a tile in which a text is stored.
TILE = 1024
_BLANK = b" \t\n\x0b\x0c\r"


def _header(data: bytes, fields: int) -> tuple[list[int], int]:
    """Numbers of a Netpbm header (comments allowed) and the offset after the one blank that ends it."""
    out, at = [], 2
    while len(out) < fields:
        while at < len(data) and (data[at] in _BLANK or data[at] == 35):
            if data[at] == 35:
                end = data.find(b"\n", at)
                at = len(data) if end < 0 else end
            else:
                at += 1
        start = at
        while at < len(data) and 48 <= data[at] <= 57:
            at += 1
        if start == at:
            raise ValueError("a Netpbm header is cut short")
        out.append(int(data[start:at]))
    return out, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """(height, width) or (height, width, 3); uint8, or uint16 where the maximum asks for it; PBM gives 0 and 1 (1: black)."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    bits = kind in (b"P1", b"P4")
    nums, at = _header(data, 2 if bits else 3)
    w, h = nums[:2]
    shape = (h, w, 3) if kind in (b"P3", b"P6") else (h, w)
    n = int(np.prod(shape))
    kind_of = np.uint8 if bits or nums[2] < 256 else np.uint16
    if kind == b"P1":
        values = np.frombuffer(bytes(c for c in data[at - 1 :] if c in b"01"), np.uint8) - 48
    elif kind in (b"P2", b"P3"):
        values = np.array(data[at - 1 :].split(), np.int64)
    elif kind == b"P4":
        row = (w + 7) // 8
        raw = np.frombuffer(data, np.uint8, count=row * h, offset=at).reshape(h, row)
        return np.unpackbits(raw, axis=1)[:, :w]
    else:
        values = np.frombuffer(data, np.uint8 if kind_of is np.uint8 else ">u2", count=n, offset=at)
    if len(values) < n:
        raise ValueError("a Netpbm image is cut short")
    return values[:n].astype(kind_of).reshape(shape)


def encode_netpbm(image: np.ndarray) -> bytes:
    """Raw PGM or PPM of a uint8 or uint16 array."""
    top = 255 if image.dtype == np.uint8 else 65535
    kind = b"P6" if image.ndim == 3 else b"P5"
    body = image.tobytes() if top == 255 else image.astype(">u2").tobytes()
    return b"%s\n%d %d\n%d\n" % (kind, image.shape[1], image.shape[0], top) + body


def decode_bmp(data: bytes) -> np.ndarray:
    """(height, width, 3) RGB uint8; palettes are looked up, the unused or alpha byte of 32 bits is dropped."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not a BMP image")
    offset, head, w, h, _, depth, packed = struct.unpack_from("<I", data, 10) + struct.unpack_from("<IiiHHI", data, 14)
    if packed not in (0, 3) or depth not in (1, 4, 8, 24, 32) or w <= 0 or h == 0:
        raise ValueError("a BMP image of an unsupported kind")
    rows, stride = abs(h), (w * depth + 31) // 32 * 4
    raw = np.frombuffer(data, np.uint8, count=stride * rows, offset=offset).reshape(rows, stride)
    if h > 0:
        raw = raw[::-1]
    if depth in (24, 32):
        return raw[:, : w * depth // 8].reshape(rows, w, depth // 8)[:, :, 2::-1].copy()
    used = struct.unpack_from("<I", data, 46)[0] or 1 << depth
    palette = np.zeros((256, 3), np.uint8)
    listed = np.frombuffer(data, np.uint8, count=4 * used, offset=14 + head).reshape(used, 4)
    palette[:used] = listed[:, 2::-1]
    if depth == 8:
        at = raw[:, :w]
    elif depth == 4:
        at = np.stack([raw >> 4, raw & 15], axis=2).reshape(rows, -1)[:, :w]
    else:
        at = np.unpackbits(raw, axis=1)[:, :w]
    return palette[at]


def encode_bmp(image: np.ndarray) -> bytes:
    """24-bit BMP of an RGB array, rows from the bottom."""
    h, w = image.shape[:2]
    stride = (w * 24 + 31) // 32 * 4
    raw = np.zeros((h, stride), np.uint8)
    raw[:, : 3 * w] = image[::-1, :, ::-1].reshape(h, 3 * w)
    return b"BM" + struct.pack("<IHHI", 54 + raw.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, raw.size, 2835, 2835, 0, 0) + raw.tobytes()


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def _cumulative(image: np.ndarray, n: int, axis: int) -> np.ndarray:
    """Means over n even cells along an axis, from the running sum read at fractional borders."""
    size = image.shape[axis]
    total = np.concatenate([np.zeros_like(np.take(image, [0], axis)), np.cumsum(image, axis=axis)], axis=axis)
    edge = np.arange(n + 1) * size / n
    low = np.minimum(edge.astype(np.int64), size - 1)
    part = (edge - low).reshape([-1 if a == axis else 1 for a in range(image.ndim)])
    at = np.take(total, low, axis) * (1 - part) + np.take(total, low + 1, axis) * part
    return np.diff(at, axis=axis) * (n / size)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area mean over each target cell (float64). The integral image is taken one axis after the other."""
    return _cumulative(_cumulative(image.astype(np.float64), height, 0), width, 1)


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])


def difference_hash(image: np.ndarray, side: int = 8) -> str:
    """Bits of neighbours that fall from left to right in a grey image of side x (side + 1), as hex."""
    small = resize(grey(image), side, side + 1)
    return np.packbits(small[:, 1:] < small[:, :-1] - 1e-9).tobytes().hex()


def tiles(image: np.ndarray, edge: int = 256) -> Iterator[tuple[int, int, bytes]]:
    """(row, column, NPY file) of tiles of at most edge x edge."""
    for y in range(0, image.shape[0], edge):
        for x in range(0, image.shape[1], edge):
            out = BytesIO()
            np.save(out, np.ascontiguousarray(image[y : y + edge, x : x + edge]), allow_pickle=False)
            yield y // edge, x // edge, out.getvalue()


def images(media: DataFrame, id_col: str, data: str, height: int, width: int, edge: int = 256) -> DataFrame:
    """Images -> id, tile_row, tile_col, npy binary, dhash, error: the resized image in tiles.

    A null, empty or broken image gives one row with nulls and the reason in error. Repeated rows repeat;
    an empty table gives none; other columns are ignored.
    """
    ship(media.sparkSession)

    kind = media.schema[id_col].dataType
    arrow = {"tile_row": pa.int32(), "tile_col": pa.int32(), "npy": pa.binary(), "dhash": pa.string(), "error": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):  # a row's tiles at a time bound the memory
                raw = column(b, "data")[i].as_py()
                try:
                    if raw is None:
                        raise ValueError("no image")
                    image = decode(raw)
                    small = np.rint(resize(image, height, width)).astype(image.dtype)
                    sign = difference_hash(image)
                    found = [(y, x, npy, sign, None) for y, x, npy in tiles(small, edge)]
                except (ValueError, struct.error, IndexError) as e:
                    found = [(None, None, None, None, str(e))]
                key = column(b, "id").take(pa.array([i] * len(found)))
                yield rows(id=key, **{n: pa.array([f[k] for f in found], t) for k, (n, t) in enumerate(arrow.items())})

    return media.select(F.col(id_col).alias("id"), F.col(data).alias("data")).mapInArrow(run, f"id {kind.simpleString()}, tile_row int, tile_col int, npy binary, dhash string, error string")


def payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 of a text, padded with zero bytes to a positive multiple of 64, and its own length."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
    return raw + b"\0" * (max(1, -(-len(raw) // ROW)) * ROW - len(raw)), len(raw)


def stored(image: np.ndarray, edge: int = TILE) -> bytes:
    """A grey image as NPY tiles one after the other, row by row."""
    return b"".join(npy for _, _, npy in tiles(image, edge))


def read_back(media: bytes) -> np.ndarray:
    """The grey image of stored(): tiles of full width, joined from the top."""
    source, parts = BytesIO(media), []
    while source.tell() < len(media):
        parts.append(np.load(source, allow_pickle=False))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def store_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs -> doc_id, n_bytes, media binary: each text as samples, 64 to a row, in NPY tiles.

    A text becomes a raw Netpbm image, which is decoded as any other and written in tiles. Null counts as
    empty and becomes one row of zeros. Repeated rows repeat; an empty table gives none.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches):
            n, media = [], []
            for t in texts:
                padded, size = payload(t)
                n.append(size)
                media.append(stored(decode(encode_netpbm(np.frombuffer(padded, np.uint8).reshape(-1, ROW)))))
            yield rows(doc_id=column(b, "doc_id"), n_bytes=pa.array(n, pa.int64()), media=pa.array(media, pa.binary()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def measure(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media -> the same rows with digests of the samples read back, of the tiles, and the image's difference hash."""
    ship(media.sparkSession)
    kinds = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}

    def one(raw: bytes) -> tuple:
        image = read_back(raw)
        back = image.tobytes()
        return len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-ROW:]), len(raw), hashlib.sha256(raw).hexdigest(), difference_hash(image)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [one(m.as_py()) for m in column(b, "media")]
            yield rows(doc_id=column(b, "doc_id"), n_bytes=column(b, "n_bytes"), **{c: pa.array([f[i] for f in found], t) for i, (c, t) in enumerate(kinds.items())})

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op8(spark, sf_dir: str) -> DataFrame:
    return measure(store_texts(table(spark, sf_dir, "documents")))
