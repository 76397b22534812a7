"""Exact substring dedup by recompression.

Recompression names runs of equal tokens, then pairs of neighbours, round by round. A name depends on
the tokens alone: a run is named by its token and length, a pair by its two names, and which neighbours
pair up is decided by a coin that each name carries (a left name merges with a right name next to it).
So equal substrings get the same symbols except near their ends, where neighbours outside have a say.
For every symbol the operator keeps its reach: the span of tokens that decided it. A symbol whose reach
lies inside a window is decided by the window alone, and the same in every copy of that window.

Names are 64-bit hashes, so all tasks agree on them without a dictionary. Words are told apart by two
independent 64-bit functions of their bytes, windows by one hash over each of them, chunks of windows by a
128-bit hash of their windows' bits: nothing is decided by one of the two alone.

1. anchors: each window is led by one symbol inside it, of the highest level there is (a pair symbol of
   the last round, else a run, else a token), chosen by content only. Equal windows have equal anchors.
   Spark counts anchors over the whole corpus (with all tokens in the symbol's reach); an anchor seen once
   has no repeated window.
2. windows under shared anchors are verified by both hashes of all their tokens (96 bits sent; chunks 128). Neighbouring
   windows travel together in chunks cut by content. An equal chunk met before covers all its windows;
   windows of first chunks are compared one by one. Only earlier starts count.
3. covered tokens go back to their documents.

Documents travel in compressed batches. Within a batch each anchor, chunk and window is sent once, so a
passage that a third of all documents share costs a row for each batch, not for each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sliceforge.llm.textkit import U, Words, column, give_back, mix, prefix_sums, rows, slices, span_hash, utf8
from sliceforge.runtime import ship, table

ROUNDS = 2
#: Reach allowed for a pair symbol, and for a run symbol; a token reaches only itself.
REACH = (8, 3, 1)
FAR = 1 << 40
NONE = U(0xFFFFFFFFFFFFFFFF)
BATCH_BYTES = 2 << 20
#: Bytes of texts of a batch whose symbols and windows are in memory at once (a longer text stands alone).
PART_BYTES = 512 << 10
#: Of the 31 bits of a batch's number: those that count within a partition (4 GB of text); the others number a million partitions.
BATCH_BITS = 11
_LOW = (1 << 32) - 1


class Symbols:
    """Symbols of one level: name, first token, reach [lo, hi) and number of tokens."""

    def __init__(self, name, at, lo, hi, size, text):
        self.name, self.at, self.lo, self.hi, self.size, self.text = name, at, lo, hi, size, text


def runs(h: np.ndarray, text: np.ndarray) -> Symbols:
    """Names the maximal runs of equal tokens; a run's reach holds the tokens beside it."""
    n = len(h)
    same_text = np.concatenate(([False], text[1:] == text[:-1]))
    new = ~(np.concatenate(([False], h[1:] == h[:-1])) & same_text)
    at = np.flatnonzero(new)
    end = np.append(at[1:], n)
    size = end - at
    name = np.where(size == 1, h[at], mix(h[at] ^ (size.astype(U) * U(0xA24BAED4963EE407))))
    doc = text[at]
    opens = ~same_text[at]
    closes = np.append(opens[1:], True)
    return Symbols(name, at, np.where(opens, -FAR, at - 1), np.where(closes, FAR, end + 1), size, doc)


def pairs(s: Symbols, level: int) -> Symbols:
    """One round of pairing: a name whose coin is left merges with a following name whose coin is right."""
    coin = (mix(s.name ^ U(level * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF)) & U(1)).astype(bool)
    n = len(s.name)
    joined = np.zeros(n, bool)
    joined[:-1] = ~coin[:-1] & coin[1:] & (s.text[1:] == s.text[:-1])
    second = np.concatenate(([False], joined[:-1]))
    # an unmerged left name depends on the one after it, an unmerged right name on the one before it
    after_hi = np.append(np.where(s.text[1:] == s.text[:-1], s.hi[1:], FAR), FAR)
    before_lo = np.concatenate(([-FAR], np.where(s.text[1:] == s.text[:-1], s.lo[:-1], -FAR)))
    lo, hi = np.where(coin & ~second, np.minimum(s.lo, before_lo), s.lo), np.where(~coin & ~joined, np.maximum(s.hi, after_hi), s.hi)
    heads = np.flatnonzero(joined)
    name, size = s.name.copy(), s.size.copy()
    name[heads] = mix(mix(s.name[heads] + U(level)) ^ (s.name[heads + 1] * U(0x9E6C63D0676A9A99)))
    size[heads] += s.size[heads + 1]
    lo[heads], hi[heads] = np.minimum(s.lo[heads], s.lo[heads + 1]), np.maximum(s.hi[heads], s.hi[heads + 1])
    keep = ~second
    return Symbols(name[keep], s.at[keep], lo[keep], hi[keep], size[keep], s.text[keep])


def _slide(best: np.ndarray, width: int) -> np.ndarray:
    """Minimum over [i, i + width) for every i; positions past the end count as none."""
    out, have = best, 1
    while have < width:
        step = min(have, width - have)
        moved = np.full(len(out), NONE)
        moved[:-step] = out[step:]
        out = np.minimum(out, moved)
        have += step
    return out


class Places:
    """Places of one level that lead windows: token index, rank value, key and text of each, and what leads each window start."""

    def __init__(self, at, value, key, text, width, leader):
        self.at, self.value, self.key, self.text, self.width, self.leader = at, value, key, text, width, leader

    def led(self, chosen: np.ndarray) -> np.ndarray:
        """Starts of the windows that the chosen places lead."""
        at, value = self.at[chosen], self.value[chosen]
        hits = []
        for back in range(self.width):
            start = at - back
            hits.append(start[(start >= 0) & (self.leader[np.maximum(start, 0)] == value)])
        return np.concatenate(hits)


def anchors(h: np.ndarray, text: np.ndarray, starts: np.ndarray, window: int) -> list[Places]:
    """All places that lead a window beginning at one of `starts` (token indices), by level.

    Of the symbols inside a window the one with the smallest rank value leads it. The key that is counted
    over the corpus is the hash of all tokens that the symbol may reach, which the window holds too: it is
    rarer than the symbol's own tokens. A place counts once, however many windows it leads; two places in
    one stretch (periodic text) count as two.
    """
    first = runs(h, text)
    top = first
    for level in range(1, ROUNDS + 1):
        top = pairs(top, level)
    n = len(h)
    sums = prefix_sums(h)
    taken = np.zeros(n, bool)
    is_start = np.zeros(n, bool)
    is_start[starts] = True
    out = []
    for s, reach, rank in ((top, REACH[0], 0), (first, REACH[1], 1), (None, REACH[2], 2)):
        open_ = is_start & ~taken
        if not open_.any():
            break
        if s is None:
            at, value = np.arange(n), mix(h)
        else:
            fit = (s.lo >= 0) & (s.hi <= n) & (s.hi - s.lo <= reach) & (s.lo + reach <= n)
            # longer symbols lead: they are rarer
            at, name, size = s.lo[fit], s.name[fit], s.size[fit]
            value = (mix(name) >> U(4)) | (np.clip(4 - size, 0, 3).astype(U) << U(60))
        best = np.full(n, NONE)
        np.minimum.at(best, at, value)
        width = window - reach + 1
        leader = np.where(open_, _slide(best, width), NONE)
        taken |= leader != NONE
        near = np.concatenate(([0], np.cumsum(leader != NONE)))
        some = near[at + 1] > near[np.maximum(at - width + 1, 0)]
        at, value = at[some], value[some]
        leads = np.zeros(len(at), bool)
        for back in range(width):
            start = at - back
            leads |= (start >= 0) & (leader[np.maximum(start, 0)] == value)
        at, value = at[leads], value[leads]
        key = mix(span_hash(sums, at, at + reach) + U(rank))
        out.append(Places(at, value, key, text[at], width, leader))
    return out


class Batch:
    """Tokens of a batch of texts and its windows."""

    def __init__(self, texts: list[bytes], window: int):
        w = Words(texts)
        self.words, self.window = w, window
        self.h, self.h2, self.text, self.first = w.hashes(), w.hashes(lane=1), w.text_of(), w.first
        count = np.diff(w.first)
        n_windows = np.maximum(count - window + 1, 0)
        self.owner = np.repeat(np.arange(len(texts)), n_windows)
        base = np.concatenate(([0], np.cumsum(n_windows)))[:-1]
        self.pos = np.arange(len(self.owner)) - base[self.owner]  # start within its text
        self.starts = self.pos + w.first[self.owner]
        self.places = anchors(self.h, self.text, self.starts, window) if len(self.starts) else []

    def led_by(self, chosen) -> np.ndarray:
        """Indices of the windows led by places for which chosen(key) holds."""
        mark = np.zeros(len(self.h) + 1, bool)
        for p in self.places:
            mark[p.led(chosen(p.key))] = True
        return np.flatnonzero(mark[self.starts])

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of every window, each from its own hash of the words."""
        a = prefix_sums(self.h)
        b = prefix_sums(self.h2)
        s, e = self.starts, self.starts + self.window
        return mix(span_hash(a, s, e)), mix(span_hash(b, s, e))


def parts(texts: list[bytes], window: int) -> Iterator[tuple[int, Batch]]:
    """The texts in ranges of about PART_BYTES, each with the index of its first text; no symbol or window crosses texts."""
    for lo, hi in slices(texts, PART_BYTES):
        yield lo, Batch(texts[lo:hi], window)


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches joined or cut into others of about BATCH_BYTES of text; the last may hold less."""
    held, size = [], 0
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(column(b, "text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        lo = 0
        while lo < len(b):
            before = int(ends[lo - 1]) if lo else 0
            hi = min(int(np.searchsorted(ends, before + BATCH_BYTES - size)) + 1, len(b))
            held.append(b.slice(lo, hi - lo))
            size, lo = size + int(ends[hi - 1]) - before, hi
            if size >= BATCH_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    give_back()


def packs(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) -> (batch, payload): rows in batches of about BATCH_BYTES, all columns kept, compressed, dealt by batch.

    Every later step reads this one exchange, so a batch has the same number and the same rows in all of them.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << BATCH_BITS
        for b in _filled(batches):
            yield rows(batch=pa.array([number], pa.int64()), payload=pa.array([_sealed(b)], pa.binary()))
            number += 1
        if number - (TaskContext.get().partitionId() << BATCH_BITS) > 1 << BATCH_BITS:
            raise ValueError("a partition holds too many batches to number; read it in smaller splits")

    # the filter that a join would add is there for all readers, so that they share the exchange
    return docs.mapInArrow(run, "batch long, payload binary").filter("batch IS NOT NULL").repartition("batch")


def _sealed(b: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(b)
    return sink.getvalue().to_pybytes()


def _unsealed(batches: Iterator[pa.RecordBatch], *others: str) -> Iterator[tuple]:
    """(batch, its rows, the values of other columns) of each packed batch."""
    for packed in batches:
        for i in range(len(packed)):
            held = pa.ipc.open_stream(column(packed, "payload")[i].as_buffer()).read_next_batch()
            yield column(packed, "batch")[i].as_py(), held, *[column(packed, c)[i] for c in others]
    give_back()


def _judged(held: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    """doc_ids and texts; a row without a doc_id takes no part, so its text counts as empty here."""
    ids = column(held, "doc_id")
    texts = utf8(column(held, "text").to_pylist())
    return pc.fill_null(ids, 0).to_numpy(), [t if ok else b"" for t, ok in zip(texts, ids.is_valid().to_pylist(), strict=True)]


def shared_anchors(packed: DataFrame, window: int) -> DataFrame:
    """packs() -> (batch, anchors array<long>): the anchors of each batch that occur elsewhere too, or more than once in it.

    An anchor costs a batch one row of three numbers, however many of its documents hold it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _unsealed(batches):
            keys = [p.key for _, b in parts(_judged(held)[1], window) for p in b.places]
            if keys:
                names, times = np.unique(np.concatenate(keys), return_counts=True)
                yield rows(anchor=names.view(np.int64), batch=np.full(len(names), number), n=np.minimum(times, 2).astype(np.int32))

    seen = packed.mapInArrow(run, "anchor long, batch long, n int")
    again = seen.withColumn("total", F.sum("n").over(Window.partitionBy("anchor"))).filter("total > 1")
    return again.groupBy("batch").agg(F.collect_list("anchor").alias("anchors"))  # as many as a batch has


#: A window in a chunk: 96 bits of its hash, and its place in the chunk.
_BODY = np.dtype([("a", "<u8"), ("b", "<u4"), ("at", "<u2")])
#: place: start and number of windows; home: batch and row. Two numbers each, in one long, so that rows are short.
_PIECES = "key1 long, key2 long, doc_id long, place long, home long, body binary"


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Windows under shared anchors: chunks, and (without a body) ranges already known to be repeats."""
    for number, held, anchors_ in _unsealed(batches, "anchors"):
        yield from _met(number, *_judged(held), np.unique(anchors_.values.to_numpy().view(U)), window)


def _known(h1: np.ndarray, h2: np.ndarray, doc_id: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which windows have an earlier equal one among them; rows of one doc_id tie at equal starts."""
    order = np.lexsort((pos, doc_id, h2, h1))
    s1, s2, sid, spos = h1[order], h2[order], doc_id[order], pos[order]
    head = np.concatenate(([True], (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])))
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    known = np.zeros(len(h1), bool)
    known[order] = (sid != sid[lead]) | (spos != spos[lead])
    return known


def _met(number: int, ids: np.ndarray, texts: list[bytes], wanted: np.ndarray, window: int) -> Iterator[pa.RecordBatch]:
    """The rows of one batch; wanted: its shared anchors, in order."""

    def shared(key: np.ndarray) -> np.ndarray:
        return wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key

    picked = []
    for lo, b in parts(texts, window):
        pick = b.led_by(shared)
        if len(pick):
            picked.append((*(h[pick] for h in b.hashes()), b.owner[pick] + lo, b.pos[pick]))
    if not picked:
        return
    h1, h2, owner, pos = (np.concatenate(c) for c in zip(*picked, strict=True))
    del picked, b, pick
    n = len(pos)
    known = _known(h1, h2, ids[owner], pos)
    # chunks: cut between windows where they are not neighbours, and where the content says so
    gap = np.concatenate(([True], (owner[1:] != owner[:-1]) | (pos[1:] != pos[:-1] + 1)))
    cut = gap | ((h1 & U(15)) == 0)
    # periodic text may go long without a cut: offsets must fit 16 bits
    since = np.arange(n) - np.maximum.accumulate(np.where(cut, np.arange(n), 0))
    at = np.flatnonzero(cut | ((since & 0xFFFF) == 0xFFFF))
    size = np.diff(np.append(at, n))
    fresh = ~known
    left = np.add.reduceat(fresh.astype(np.int64), at)
    yield _known_ranges(number, ids, owner, pos, known)
    live = np.flatnonzero(left > 0)
    packed = np.empty(n, _BODY)
    packed["a"], packed["b"], packed["at"] = h1, h2 >> U(32), pos - np.repeat(pos[at], size)
    both = np.stack((h1, h2), axis=1)
    bodies, keys = [], np.zeros((len(live), 2), U)
    for k, i in enumerate(live.tolist()):
        part = slice(at[i], at[i] + size[i])
        bodies.append(packed[part][fresh[part]].tobytes())
        keys[k] = np.frombuffer(xxhash.xxh3_128_digest(both[part].tobytes()), U)
    yield _pieces(keys[:, 0].view(np.int64), keys[:, 1].view(np.int64), ids[owner[at[live]]], pos[at[live]], size[live], number, owner[at[live]], pa.array(bodies, pa.binary()))


def _pieces(key1, key2, doc_id, pos, n, number: int, at, body: pa.Array) -> pa.RecordBatch:
    return rows(key1=key1, key2=key2, doc_id=doc_id, place=(pos.astype(np.int64) << 32) | n, home=(number << 32) | at.astype(np.int64), body=body)


def _known_ranges(number: int, doc_ids: np.ndarray, owner: np.ndarray, pos: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(known)
    owner, pos = owner[at], pos[at]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (pos[1:] != pos[:-1] + 1)))[: len(at)]
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    owner, pos = owner[first], pos[first]
    return _pieces((number << 32) | np.arange(len(first)), np.full(len(first), -1), doc_ids[owner], pos, n, number, owner, pa.nulls(len(first), pa.binary()))


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """After chunks are ranked: known ranges and later chunks pass as ranges (key2 -1), first chunks as windows (key2 from 0)."""
    for b in batches:
        first = (column(b, "rn").to_numpy() == 1) & column(b, "body").is_valid().to_numpy(zero_copy_only=False)
        done = b.filter(pa.array(~first))
        yield rows(key1=column(done, "home"), key2=np.full(len(done), -1), **{c: column(done, c) for c in ("doc_id", "place", "home")})
        opened = b.filter(pa.array(first))
        if len(opened):
            bodies = column(opened, "body").to_pylist()
            lens = np.fromiter(map(len, bodies), np.int64) // _BODY.itemsize
            every = np.frombuffer(b"".join(bodies), _BODY)
            doc_id, place, home = (np.repeat(column(opened, c).to_numpy(), lens) for c in ("doc_id", "place", "home"))
            pos = (place >> 32) + every["at"]
            yield rows(key1=np.ascontiguousarray(every["a"]).view(np.int64), key2=every["b"].astype(np.int64), doc_id=doc_id, place=(pos << 32) | 1, home=home)


def repeats(packed: DataFrame, window: int = 20) -> DataFrame:
    """packs() -> (batch, spans array<struct<home, place>>): starts of windows that also start earlier.

    A span's home names a row of the batch, its place the first of some consecutive window starts and their number; spans may overlap. Batches
    without any are absent. Rows without a doc_id take no part.
    """
    met = packed.join(shared_anchors(packed, window), "batch").mapInArrow(lambda it: _windows(it, window), _PIECES)
    by_key = Window.partitionBy("key1", "key2").orderBy("doc_id", F.shiftright("place", 32))
    # equal places tie: two rows of one document are not earlier than each other
    ranked = met.withColumn("rn", F.rank().over(by_key))
    opened = ranked.mapInArrow(_open, "key1 long, key2 long, doc_id long, place long, home long")
    found = opened.withColumn("rn", F.rank().over(by_key)).filter("key2 < 0 OR rn > 1")
    return found.groupBy(F.shiftright("home", 32).alias("batch")).agg(F.collect_list(F.struct("home", "place")).alias("spans"))  # as many as a batch has windows


def _covered(n_words: int, spans: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a repeated window; spans are rows of (pos, n)."""
    mark = np.zeros(n_words + 1, np.int64)
    np.add.at(mark, spans[:, 0], 1)
    np.add.at(mark, np.minimum(n_words, spans[:, 0] + spans[:, 1] + window - 1), -1)
    return np.cumsum(mark[:-1]) > 0


def _strip(text: bytes, spans: np.ndarray | None, window: int) -> tuple[int, int, bytes]:
    words = text.split()
    if spans is None:
        return len(words), 0, b" ".join(words)
    gone = _covered(len(words), spans, window)
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _stripped(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, np.ndarray | None]]]]:
    """Rows of each batch with the UTF-8 text and the spans (or None) of each row."""
    for _, held, spans in _unsealed(batches, "spans"):
        of: dict[int, np.ndarray] = {}
        if spans.is_valid:
            at, place = spans.values.field("home").to_numpy() & _LOW, spans.values.field("place").to_numpy()
            order = np.argsort(at, kind="stable")
            at, both = at[order], np.stack((place >> 32, place & _LOW), axis=1)[order]
            cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            of = dict(zip(at[cut].tolist(), np.split(both, cut[1:]), strict=True))
        yield held, [(t, of.get(i)) for i, t in enumerate(utf8(column(held, "text").to_pylist()))]


def _with_spans(docs: DataFrame, window: int) -> DataFrame:
    packed = packs(docs)
    return packed.join(repeats(packed, window), "batch", "left").select("batch", "payload", "spans")


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_words long, n_removed long, kept string, one row per row.

    A word goes if a window of `window` words that covers it has the same words as a window with an
    earlier start (smaller doc_id, or earlier in the same document). Null texts have no words; texts
    shorter than a window stay whole. Rows with a null doc_id are not compared and stay whole. Rows
    that repeat a doc_id are both judged against smaller ids, and by earlier starts under their own id: of two such rows neither is earlier at equal starts.
    An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    return _counted(docs, window, "kept", lambda kept: kept.decode("utf-8", "surrogatepass"))


def _counted(docs: DataFrame, window: int, name: str, shown) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _stripped(batches, window):
            got = [_strip(t, s, window) for t, s in texts]
            counts = {c: pa.array([g[i] for g in got], pa.int64()) for i, c in enumerate(("n_words", "n_removed"))}
            yield rows(doc_id=column(held, "doc_id"), **counts, **{name: pa.array([shown(g[2]) for g in got], pa.string())})

    return _with_spans(plain(docs), window).mapInArrow(run, f"doc_id long, n_words long, n_removed long, {name} string")


def op7(spark, sf_dir: str) -> DataFrame:
    return _counted(table(spark, sf_dir, "documents"), 20, "kept_sha256", lambda kept: hashlib.sha256(kept).hexdigest())


def strip_stage(docs: DataFrame, window: int = 20) -> DataFrame:
    """The pipeline stage: documents with repeats taken out of their texts; texts without any stay as they are.

    Whole rows travel in the batches, so other columns keep their exact values, whatever their names.
    """
    named = docs.withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _stripped(batches, window):
            at = held.schema.get_field_index("text")
            whole = column(held, "text").to_pylist()
            out = [w if s is None else _strip(t, s, window)[2].decode("utf-8", "surrogatepass") for w, (t, s) in zip(whole, texts, strict=True)]
            yield held.set_column(at, held.schema.field(at), pa.array(out, held.schema.field(at).type))

    return _with_spans(named, window).mapInArrow(run, named.schema)
