"""Near copies by Jaccard similarity of word shingles: MinHash buckets propose, exact set comparison decides.

Links from elsewhere (fingerprints, see simhash) may propose too; they are compared like any other.
Each text gets BANDS keys of ROWS minima each; two texts that share a key are candidates. A pair at
similarity s shares none with probability (1 - s**ROWS)**BANDS: under 5e-7 at 0.8, less above it.
Keys link a bucket's members to its smallest one only, so buckets are never expanded into pairs. The
components of these links hold every proposed pair; the texts of a component meet in one place, where
those similar enough are joined by comparing whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.llm.textkit import SPACES, U, Words, mix, portions, utf8
from sliceforge.operators.components import connected_components
from sliceforge.runtime import materialize, release, ship

SHINGLE = 5
#: The least similarity of two near copies, as a fraction.
LEAST = (4, 5)
ROWS, BANDS = 6, 48
_BLOCK = 1 << 16
_rng = np.random.default_rng(11)
_PLACES = _rng.integers(0, 1 << 63, SHINGLE, dtype=U) * U(2) + U(1)
_FLIPS = _rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint32)
_FACTORS = _rng.integers(0, 1 << 31, ROWS * BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_KEYS = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=U) * U(2) + U(1)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased word shingles of each text, repeats included, and where each text's begin.

    A text of at most SHINGLE words is one shingle; a text without words has one, the same for all such texts.
    """
    w = Words(texts, SPACES, lower=True)
    h, n = w.hashes(), np.diff(w.first)
    counts = np.maximum(n - SHINGLE + 1, 1)
    first = np.concatenate(([0], np.cumsum(counts)))
    at = np.repeat(w.first[:-1] - first[:-1], counts) + np.arange(first[-1])
    have = np.repeat(np.minimum(n, SHINGLE), counts)
    out = have.astype(U)
    h = np.concatenate((h, np.zeros(SHINGLE, U)))
    for k in range(SHINGLE):
        out += np.where(k < have, h[at + k], U(0)) * _PLACES[k]
    return mix(out), first


def band_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, BANDS) keys: each from ROWS minima of the text's hashes under ROWS orders."""
    short = (hashes >> U(32)).astype(np.uint32)
    n = len(first) - 1
    low = np.full((n, ROWS * BANDS), np.uint32(0xFFFFFFFF))
    for lo in range(0, len(short), _BLOCK):  # long texts in blocks
        part = short[lo : lo + _BLOCK]
        a, z = np.searchsorted(first, lo, "right") - 1, np.searchsorted(first, lo + len(part), "left")
        starts = np.maximum(first[a:z] - lo, 0)
        for k in range(ROWS * BANDS):
            np.minimum(low[a:z, k], np.minimum.reduceat((part ^ _FLIPS[k]) * _FACTORS[k], starts), out=low[a:z, k])
    keys = (low.reshape(n, BANDS, ROWS).astype(U) * _KEYS).sum(axis=2, dtype=U)
    return mix(keys + np.arange(BANDS, dtype=U) * U(0x9E3779B97F4A7C15))


def clusters(sets: list[np.ndarray]) -> np.ndarray:
    """For each of some sets (distinct hashes each) the index of a member of its component.

    Two sets are linked from a similarity of LEAST on. Sets already reached are compared no more, so a family whose
    members are alike costs one comparison a member.
    """
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    begin = ends - sizes
    mark = np.zeros(ids.max() + 1, np.uint8)
    label = np.full(len(sets), -1)
    rest = np.argsort(sizes, kind="stable")  # by size: only a window of sizes can be similar enough

    def laid(rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.concatenate(([0], np.cumsum(sizes[rest])))
        return ids[np.repeat(begin[rest] - at[:-1], sizes[rest]) + np.arange(at[-1])], at

    flat, at = laid(rest)
    gone = np.zeros(len(sets), bool)
    todo: list[int] = []
    p, q = LEAST
    dead = 0
    for seed in rest.copy():
        if gone[seed]:
            continue
        label[seed], gone[seed], todo = seed, True, [seed]
        dead += 1
        while todo:
            x = todo.pop()
            if 2 * dead > len(rest):
                rest = rest[~gone[rest]]
                if not len(rest):
                    break
                flat, at = laid(rest)
                dead = 0
            s = sizes[rest]
            lo, hi = np.searchsorted(s * q, sizes[x] * p, "left"), np.searchsorted(s * p, sizes[x] * q, "right")
            if lo >= hi:
                continue
            own = ids[begin[x] : ends[x]]
            mark[own] = 1
            common = np.add.reduceat(mark[flat[at[lo] : at[hi]]], at[lo:hi] - at[lo], dtype=np.int64)
            mark[own] = 0
            near = rest[lo:hi][common * q >= (sizes[x] + s[lo:hi] - common) * p]
            near = near[~gone[near]]
            label[near], gone[near] = seed, True
            dead += len(near)
            todo.extend(near.tolist())
    return label


def named_texts(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text, ...) -> (doc_id, tid, text): tid is the hash of the text, null counts as empty."""
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("tid"), "text"
    )


def key_links(texts: DataFrame) -> DataFrame:
    """(tid long, text) -> links (u, v): of the texts that share a key, each with the smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, part in portions(batches, 1 << 20):
            keys = band_keys(*shingles(utf8(part)))
            tids = b.column(b.schema.get_field_index("tid")).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(tids, BANDS)), pa.array(keys.ravel().view(np.int64))], names=["tid", "key"])

    keys = materialize(texts.mapInArrow(run, "tid long, key long"), "keys")
    shared = keys.groupBy("key").agg(F.min("tid").alias("v"), F.max("tid").alias("most")).filter("v < most").select("key", "v")
    links = materialize(keys.join(shared, "key").filter("tid <> v").select(F.col("tid").alias("u"), "v").distinct(), "links")
    release(keys)
    return links


def candidates(texts: DataFrame, proposed: DataFrame | None = None) -> DataFrame:
    """(tid long, text) -> (tid, cand): texts that may have a near copy, by component of shared keys and of links (u, v) proposed."""
    links = key_links(texts)
    if proposed is not None:
        links = links.unionByName(proposed)
    return connected_components(links).select(F.col("node").alias("tid"), F.col("component").alias("cand"))


def verified(texts: DataFrame) -> DataFrame:
    """(tid, text, cand) -> (tid, near): near names the texts of a component of pairs that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cand, tids, sets = None, [], []

        def done() -> pa.RecordBatch:
            label = clusters(sets)
            names = np.array(tids, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[label])], names=["tid", "near"])

        for b, part in portions(batches, 1 << 20):
            hashes, first = shingles(utf8(part))
            for i, (c, t) in enumerate(zip(b.column("cand").to_pylist(), b.column("tid").to_pylist(), strict=True)):
                if c != cand:
                    if sets:
                        yield done()
                    cand, tids, sets = c, [], []
                if not tids or tids[-1] != t:  # repeated rows of a document
                    tids.append(t)
                    sets.append(np.unique(hashes[first[i] : first[i + 1]]))
        if sets:
            yield done()

    return texts.select("tid", "text", "cand").repartition("cand").sortWithinPartitions("cand", "tid").mapInArrow(run, "tid long, near long")


def kept_rows(docs: DataFrame, proposed: DataFrame | None = None) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, tid): the smallest doc_id of each group of near copies, and the hash of its text.

    A group is what links of similarity LEAST or more connect; null texts count as empty, and texts without words are alike.
    Of several texts under that doc_id the one with the smallest hash is named. proposed holds further links (u, v) of hashes to compare.
    """
    ship(docs.sparkSession)
    named = named_texts(docs)
    # of equal texts one row goes on
    owners = materialize(named.groupBy("tid").agg(F.min("doc_id").alias("low")), "owners")
    cand = candidates(named.select("tid", "text"), proposed)
    # few texts have a partner: only theirs move on
    mine = cand.join(owners, "tid").select(F.col("tid").alias("own"), "low", "cand")
    texts = named.join(mine, (F.col("tid") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("low"))).select("tid", "text", "cand")
    near = materialize(verified(texts), "near")
    groups = owners.join(near, "tid", "left").groupBy(F.coalesce("near", "tid").alias("near")).agg(F.min(F.struct(F.col("low").isNull().alias("none"), F.col("low").alias("doc_id"), "tid")).alias("b"))
    return groups.select("b.doc_id", "b.tid").filter("doc_id IS NOT NULL").distinct()


def kept_ids(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id of the rows that kept_rows names."""
    return kept_rows(docs).select("doc_id").distinct()
