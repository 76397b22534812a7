"""Toxicity: a convolutional text classifier in numpy.

A word's vector is the sum of hashed embeddings of the whole word and of its first bytes (two prefix
lengths), so that unseen forms of a known stem keep its vector. Filters of widths 1, 2 and 3 slide over
the words, each filter's maximum over the document is kept, and a linear layer gives the score.
Training is mini-batch Adam; max pooling sends gradient to the winning places only.

Thresholds are calibrated by language. The language is guessed from the text itself (function words
and letters, stated below), never taken from the lang column; a score of 0.5 is the threshold of the
text's own language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.llm.textkit import NON_LETTERS, U, Words, column, portions, rows, slices, utf8
from sliceforge.runtime import ship, table

BUCKETS = 1 << 17
DIM = 8
FILTERS = 12
WIDTHS = (1, 2, 3)
PREFIXES = (4, 6)
#: The most labelled documents that are fitted on, whatever the size of the input, and the bytes they may hold.
TRAIN_DOCS = 6000
TRAIN_BYTES = 24 << 20
#: Passes over the sample, and steps that a small sample is passed over more often for.
EPOCHS, STEPS = 6, 300
#: Errors that a threshold must save for each unit it moves away from the balanced point.
PULL = 0.5

#: Common words that tell languages apart.
MARKERS = {
    "en": "the and of to is was that for with are this by from or it on as at be which",
    "fr": "le les des et est une du dans pour qui sur au avec ne ce il en sont plus par",
    "de": "der die das und ist nicht ein eine zu den von mit sich auf im dem für es werden auch",
    "es": "el los las y del que es una por con para se su al lo como más pero sus le",
}
LANGS = (*MARKERS, "other")


def _spread(h: np.ndarray, salt: int) -> np.ndarray:
    return ((h ^ U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * U(0xD6E8FEB86659FD93) >> U(64 - 17)).astype(np.int32)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word (a column for the word and for each prefix), first word of each text, language of each text."""
    w = Words(texts, NON_LETTERS, lower=True)
    whole = w.hashes()
    cols = [_spread(whole, 1), *(_spread(w.hashes(k), 2 + i) for i, k in enumerate(PREFIXES))]
    return np.stack(cols, axis=1) if len(w) else np.zeros((0, 1 + len(PREFIXES)), np.int32), w.first, languages(whole, w)


_marks: list[tuple[np.ndarray, np.ndarray]] = []


def _mark_table() -> tuple[np.ndarray, np.ndarray]:
    if not _marks:
        words: dict[str, int] = {}
        for i, lang in enumerate(MARKERS):
            for m in MARKERS[lang].split():
                words[m] = words.get(m, 0) | 1 << i
        table_ = Words([" ".join(words).encode()], NON_LETTERS, lower=True)
        h = table_.hashes()
        order = np.argsort(h)
        _marks.append((h[order], np.array(list(words.values()), np.uint8)[order]))
    return _marks[0]


def languages(hashes: np.ndarray, w: Words) -> np.ndarray:
    """Index into LANGS of the language whose common words are most frequent; none at all: other."""
    keys, bits = _mark_table()
    spot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    hit = np.where(keys[spot] == hashes, bits[spot], 0)
    n = len(w.first) - 1
    votes = np.zeros((n, len(MARKERS)), np.int64)
    for i in range(len(MARKERS)):
        total = np.concatenate(([0], np.cumsum(hit >> i & 1)))
        votes[:, i] = total[w.first[1:]] - total[w.first[:-1]]
    return np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(MARKERS))


@dataclass
class Model:
    tables: np.ndarray  # (1 + prefixes, BUCKETS, DIM)
    filters: list[np.ndarray]  # (width * DIM, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    cuts: np.ndarray  # a threshold on the raw score for each language

    def pooled(self, cols: np.ndarray, first: np.ndarray, want_places: bool = False):
        """Max-pooled activations (texts, widths * FILTERS), and the word where each was reached."""
        n_texts = len(first) - 1
        empty = np.zeros((n_texts, len(WIDTHS) * FILTERS), np.float32)
        places = np.full(empty.shape, -1, np.int64)
        if not len(cols):
            return (empty, places, None) if want_places else empty
        emb = self.tables[0][cols[:, 0]]
        for k in range(1, cols.shape[1]):
            emb = emb + self.tables[k][cols[:, k]]
        owner = np.repeat(np.arange(n_texts), np.diff(first))
        for j, width in enumerate(WIDTHS):
            n = len(emb) - width + 1
            if n <= 0:
                continue
            act = self.bias[j] + sum(emb[k : k + n] @ self.filters[j][k * DIM : (k + 1) * DIM] for k in range(width))
            if width > 1:
                act[owner[:n] != owner[width - 1 :]] = 0  # across two texts
            np.maximum(act, 0, out=act)
            some = np.flatnonzero(np.minimum(first[1:], n) > first[:-1])
            if not len(some):
                continue
            block = slice(j * FILTERS, (j + 1) * FILTERS)
            best = np.maximum.reduceat(act, first[:-1][some], axis=0)
            # reduceat runs to the next listed start; texts without words lie between and add none
            empty[some, block] = best
            if want_places:
                for t, b in zip(some, best, strict=True):
                    part = act[first[t] : min(first[t + 1], n)]
                    places[t, block] = np.where(b > 0, first[t] + part.argmax(axis=0), -1)
        return (empty, places, emb) if want_places else empty

    def raw(self, cols: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(cols, first) @ self.out + self.out_bias


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Model:
    """Fits the network on the texts, and the thresholds by language on scores of texts that the scoring network never saw.

    Each half of the texts is scored by a network fitted on the other half. A language's threshold is the
    middle between two such scores with the fewest errors, or a few more nearer to 0 (PULL). Languages with fewer
    than 20 labels of either kind use the overall one, which itself needs 5 of either kind; with fewer it stays
    at 0, where the balanced loss puts it. The network that is kept is fitted on all texts.
    """
    blank = len(texts) // 50 + (len(texts) > 0)  # texts without words count as harmless
    labels = np.concatenate((np.asarray(labels, np.float32), np.zeros(blank, np.float32)))
    parts = [features([t]) for t in [*texts, *[b""] * blank]]
    m = _fit(parts, labels, seed)
    raw = np.zeros(len(parts))
    half = np.zeros(len(parts), bool)
    rng = np.random.default_rng(seed)
    for kind in (0, 1):
        own = rng.permutation(np.flatnonzero(labels == kind))
        half[own[::2]] = True
    for side in (half, ~half):
        fitted, rest = np.flatnonzero(side), np.flatnonzero(~side)
        other = _fit([parts[i] for i in fitted], labels[fitted], seed)
        raw[rest] = [other.raw(parts[i][0], parts[i][1])[0] for i in rest]
    lang = np.array([p[2][0] for p in parts], np.int64)
    overall = _cut(raw, labels) if min(labels.sum(), (1 - labels).sum()) >= 5 else 0.0
    for i in range(len(LANGS)):
        own = lang == i
        m.cuts[i] = _cut(raw[own], labels[own]) if min(labels[own].sum(), (1 - labels[own]).sum()) >= 20 else overall
    return m


def _fit(parts: list[tuple], labels: np.ndarray, seed: int) -> Model:
    """The network without thresholds; labels of one kind alone give a constant."""
    rng = np.random.default_rng(seed)
    k = 1 + len(PREFIXES)
    m = Model(
        (rng.normal(0, 0.1, (k, BUCKETS, DIM))).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
        np.zeros(len(LANGS)),
    )
    if len(parts) == 0 or labels.min() == labels.max():
        m.out[:] = 0
        m.out_bias = -2.0 if len(parts) == 0 or labels[0] == 0 else 2.0
        return m
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
    moments: dict[str, list[np.ndarray]] = {}
    step = 0

    def adam(name: str, value: np.ndarray, grad: np.ndarray, rate: float, rows=None) -> None:
        a, b = moments.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
        at = slice(None) if rows is None else rows
        a[at] = 0.9 * a[at] + 0.1 * grad
        b[at] = 0.99 * b[at] + 0.01 * grad * grad
        value[at] -= rate * a[at] / (np.sqrt(b[at]) + 1e-6)

    size = 48
    epochs = max(EPOCHS, -(-STEPS * size // len(parts)))
    for epoch in range(epochs):
        order = rng.permutation(len(parts))
        for lo in range(0, len(order), size):
            pick = order[lo : lo + size]
            cols = np.concatenate([parts[i][0] for i in pick])
            first = np.concatenate(([0], np.cumsum([len(parts[i][0]) for i in pick])))
            step += 1
            pooled, places, emb = m.pooled(cols, first, True)
            z = np.clip(pooled @ m.out + m.out_bias, -30, 30)
            err = (1 / (1 + np.exp(-z)) - labels[pick]) * weight[pick] / len(pick)
            rate = 0.02 * (1 - epoch / epochs)
            back = err[:, None] * m.out[None, :]
            grad_out = pooled.T @ err + 1e-4 * m.out
            m.out_bias -= rate * float(err.sum())
            text_at, unit = np.nonzero(places >= 0)
            if emb is not None and len(text_at):
                word, g = places[text_at, unit], back[text_at, unit]
                touched, pulls = [], []
                for j, width in enumerate(WIDTHS):
                    mine = unit // FILTERS == j
                    f, w0, gj = unit[mine] % FILTERS, word[mine], g[mine]
                    grad = np.zeros_like(m.filters[j])
                    gb = np.zeros_like(m.bias[j])
                    np.add.at(gb, f, gj)
                    for q in range(width):
                        block = grad[q * DIM : (q + 1) * DIM]
                        np.add.at(block.T, f, gj[:, None] * emb[w0 + q])
                        touched.append(w0 + q)
                        pulls.append(gj[:, None] * m.filters[j][q * DIM : (q + 1) * DIM].T[f])
                    adam(f"f{j}", m.filters[j], grad, rate)
                    adam(f"b{j}", m.bias[j], gb, rate)
                at, pull = np.concatenate(touched), np.concatenate(pulls)
                for c in range(k):
                    rows, inv = np.unique(cols[at, c], return_inverse=True)
                    summed = np.zeros((len(rows), DIM), np.float32)
                    np.add.at(summed, inv, pull)
                    adam(f"e{c}", m.tables[c], summed, rate, rows)
            adam("out", m.out, grad_out.astype(np.float32), rate)
    return m


def _cut(raw: np.ndarray, labels: np.ndarray) -> float:
    order = np.argsort(raw, kind="stable")
    r, y = raw[order], labels[order]
    errors = np.concatenate(([0], np.cumsum(y))) + np.concatenate((np.cumsum((1 - y)[::-1])[::-1], [0]))
    edges = np.concatenate(([r[0] - 2], (r[1:] + r[:-1]) / 2, [r[-1] + 2]))
    # a unit of score away from the balanced point counts as a fraction of an error
    return float(edges[np.argmin(errors + PULL * np.abs(edges))])


def score_texts(m: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Scores in [0, 1] and guessed languages; 0.5 is the threshold of the language."""
    score, lang = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for lo, hi in slices(texts, 1 << 18):
        cols, first, lang[lo:hi] = features(texts[lo:hi])
        score[lo:hi] = 1 / (1 + np.exp(-np.clip(m.raw(cols, first) - m.cuts[lang[lo:hi]], -30, 30)))
    return score, lang


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def fitting(sizes: dict[int, dict[int, int]], limit: int) -> set[int]:
    """label -> id -> bytes: the ids whose texts are taken, which hold at most `limit` bytes together.

    Each label has half the bytes and what the other leaves over, so that neither crowds the other out; the
    longest texts are passed over. A label none of whose texts fits still gets its shortest one.
    """
    ordered = {k: sorted(v, key=lambda i, v=v: (v[i], i)) for k, v in sizes.items()}
    sums = {k: np.cumsum([sizes[k][i] for i in ids]) for k, ids in ordered.items()}
    n = {k: max(1, int(np.searchsorted(sums[k], limit // 2, "right"))) for k in sizes if sizes[k]}
    for k in sorted(n, key=lambda k: int(sums[k][n[k] - 1])):
        others = sum(int(sums[j][n[j] - 1]) for j in n if j != k)
        n[k] = max(n[k], int(np.searchsorted(sums[k], limit - others, "right")))
    return {i for k in n for i in ordered[k][: n[k]]}


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS) -> Model:
    """Learns from labelled rows that are not held out: a bounded sample, chosen by hash of doc_id.

    Null labels, null ids and held-out ids take no part, nor do labels without a document; of a doc_id with
    several labels the largest counts, and of several texts the first by length, then by hash. Where the
    sample holds more than TRAIN_BYTES, its longest texts are passed over.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # only ids, sizes and hashes meet the labels; the texts of the sample are fetched afterwards
    there = texts.select("doc_id", F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("print")).alias("own"))
    drawn = there.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min("own").alias("own")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).collect()
    sizes: dict[int, dict[int, int]] = {}
    for r in drawn:
        sizes.setdefault(r.toxic, {})[r.doc_id] = r.own.size
    taken = fitting(sizes, TRAIN_BYTES)
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(r.doc_id, r.toxic, r.own.print) for r in drawn if r.doc_id in taken], "doc_id long, toxic int, print long")
    # at most max_docs small rows are broadcast
    sample = texts.withColumn("print", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "print"]).dropDuplicates(["doc_id"])
    found = sorted(sample.select("doc_id", "toxic", "text").toLocalIterator(), key=lambda r: r.doc_id)
    return train([r.text.encode("utf-8", "surrogatepass") for r in found], np.array([r.toxic for r in found]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs -> doc_id, score, predicted, language, a row for a row; null and empty texts get the score of no words.

    Only the text is looked at. Repeated rows are scored alike; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)  # size fixed by BUCKETS, DIM and FILTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches, 1 << 20):
            s, lang = score_texts(held.value, utf8(texts))
            yield rows(doc_id=column(b, "doc_id"), score=s, predicted=(s >= 0.5).astype(np.int32), language=[LANGS[i] for i in lang])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int, language string")


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "language")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pipeline stage: documents that the classifier calls toxic go; the others stay as they are."""
    model = fit(docs, labels)
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    # Arrow batches keep every other column as it is, whole numbers beside nulls included
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches, 1 << 20):
            yield b.filter(pa.array(score_texts(held.value, utf8(texts))[0] < 0.5))

    return docs.mapInArrow(run, docs.schema)
