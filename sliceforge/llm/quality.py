"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Tokens are bytes of the lower-cased text (white space as one blank, digits as one digit) in n-grams of
order 5, each an exact 40-bit number. Counts of all trusted text are summed by Spark. The documents are
taken in batches of bounded size; a batch sends each of its n-grams once. The n-grams met are joined, order
by order, with the counts and context weights (shards are Spark's partitions by n-gram or context), and
the log probabilities go back to the batches, which add them up document by document. Neither
the counts nor the probabilities are ever in one place, so the model may grow with the corpus.

A document is kept if its perplexity is at most a quantile of the trusted documents of its language
that were held back from the counts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.llm.textkit import LOWER, SPACES, column, portions, rows, slices, utf8
from sliceforge.runtime import materialize, ship, table

ORDER = 5
SYMBOLS = 256
KEEP = 0.995
#: Bytes of text in a batch (one longer text stands alone).
BATCH = 12 << 20
#: The most bytes of trusted ids that are broadcast.
BROADCAST_BYTES = 16 << 20


def _folding() -> np.ndarray:
    t = LOWER.astype(np.int64)
    t[SPACES] = 32
    t[48:58] = 48
    return t


_FOLD = _folding()


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code of the n-gram ending at each byte, borders of texts); a text begins after blanks."""
    pad = b" " * (ORDER - 1)
    buf = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    s = _FOLD[buf]
    code = s.copy()
    for k in range(1, ORDER):
        code[k:] += s[:-k] << (8 * k)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lens + ORDER - 1)
    keep = np.ones(len(buf), bool)
    for k in range(ORDER - 1):
        keep[ends - lens - 1 - k] = False
    return code[keep], np.concatenate(([0], np.cumsum(lens)))


def distinct(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of some texts in ascending order, and how often each occurs."""
    found, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in slices(texts, 2 << 20):
        u, n = np.unique(codes(texts[lo:hi])[0], return_counts=True)
        found.append(u)
        times.append(n)
    u, at = np.unique(np.concatenate(found), return_inverse=True)
    return u, np.bincount(at, weights=np.concatenate(times), minlength=len(u)).astype(np.int64)


def counts(trusted: DataFrame) -> DataFrame:
    """(text) -> (code, n) over all trusted texts: each batch sends each n-gram once."""
    ship(trusted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in portions(batches, BATCH):
            u, n = distinct(utf8(texts))
            yield rows(code=u, n=n)

    return trusted.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney from the numbers of n-grams seen once to four times."""
    r = level.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (max(1, r[f"n{i}"] or 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3))]


def _last(k: int) -> F.Column:
    """The n-gram of the last k symbols."""
    return F.expr(f"code & {SYMBOLS**k - 1}L")


def _context() -> F.Column:
    return F.shiftright("code", 8)


def model(trusted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (code, own) and (context, weight), tables that grow with the trusted text.

    Highest order: counts; lower orders: numbers of different symbols before. `own` is the discounted
    share of an n-gram in its context, `weight` what the context leaves to the next lower order.
    """
    levels = {ORDER: materialize(counts(trusted), "grams5")}
    for k in range(ORDER - 1, 0, -1):
        # a lower order counts in how many ways an n-gram is continued to the left
        levels[k] = materialize(levels[k + 1].groupBy(_last(k).alias("code")).agg(F.count(F.lit(1)).alias("n")), f"grams{k}")
    out = []
    for k in range(1, ORDER + 1):
        d = _discounts(levels[k])
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        level = levels[k].select("code", "n", _context().alias("context"))
        context = level.groupBy("context").agg(F.sum("n").alias("total"), F.sum(cut).alias("spared"))
        own = level.join(context, "context").select("code", ((F.col("n") - cut) / F.col("total")).alias("own"))
        out.append((own, context.select("context", (F.col("spared") / F.col("total")).alias("weight"))))
    return out


def probabilities(asked: DataFrame, orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Distinct n-grams (code) -> (code, p): the probability of the last symbol after the others."""
    wanted = {len(orders): asked}
    for k in range(len(orders) - 1, 0, -1):
        wanted[k] = wanted[k + 1].select(_last(k).alias("code")).distinct()
    p = None
    for k, (own, weight) in enumerate(orders, 1):
        met = wanted[k].join(own, "code", "left").withColumn("context", _context()).join(weight, "context", "left")
        if p is None:
            met = met.withColumn("lower", F.lit(1 / SYMBOLS))
        else:
            shorter = p.select(F.col("code").alias("tail"), F.col("p").alias("lower"))
            met = met.join(shorter, _last(k - 1) == F.col("tail"))
        p = met.select("code", (F.coalesce("own", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("lower")).alias("p"))
        if 1 < k < len(orders):
            p = materialize(p, f"p{k}")
    return p


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list[bytes]]]:
    """(number, rows, texts) of each batch of a partition; the same rows give the same batches."""
    number = TaskContext.get().partitionId() << 32
    for b, texts in portions(batches, BATCH):
        yield number, b, utf8(texts)
        number += 1


def grams(docs: DataFrame) -> DataFrame:
    """docs (doc_id, lang, text) -> (batch, code): each n-gram of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, texts in _batches(batches):
            u, _ = distinct(texts)
            yield rows(batch=np.full(len(u), number), code=u)

    return docs.mapInArrow(run, "batch long, code long")


def packs(docs: DataFrame) -> DataFrame:
    """docs (doc_id, lang, text) -> (batch, payload): the rows of a batch, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b, texts in _batches(batches):
            payload = zstandard.compress(pickle.dumps((column(b, "doc_id").to_pylist(), column(b, "lang").to_pylist(), texts)), 3)
            yield rows(batch=pa.array([number], pa.int64()), payload=pa.array([payload], pa.binary()))

    return docs.mapInArrow(run, "batch long, payload binary")


def perplexities(known: np.ndarray, logs: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Perplexity of each text from the ascending n-grams `known` and their logs; an empty one has the alphabet's size."""
    out = np.full(len(texts), float(SYMBOLS))
    for lo, hi in slices(texts, 1 << 20):
        code, at = codes(texts[lo:hi])
        if not len(code):
            continue
        spot = np.searchsorted(known, code)
        if not len(known) or spot.max() >= len(known) or (known[spot] != code).any():
            raise ValueError("a batch was cut otherwise than when its n-grams were taken")
        total = np.concatenate(([0], np.cumsum(logs[spot], dtype=np.float64)))
        n = np.diff(at)
        out[lo:hi] = np.where(n > 0, np.exp(-(total[at[1:]] - total[at[:-1]]) / np.maximum(n, 1)), SYMBOLS)
    return out


def score(docs: DataFrame, orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """docs -> doc_id, lang, perplexity, a row for a row; null text counts as empty, null lang stays null.

    docs is read twice and must give the same partitions both times, as files do; a batch whose
    n-grams do not agree raises an error.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    met = materialize(grams(own), "met")
    p = probabilities(met.select("code").distinct(), orders)
    answers = (
        met.join(p, "code")
        .groupBy("batch")  # as many as a batch has n-grams
        .agg(F.array_sort(F.collect_list(F.struct("code", F.log(F.greatest("p", F.lit(1e-12))).cast("float").alias("log")))).alias("a"))
        .select("batch", F.col("a.code").alias("codes"), F.col("a.log").alias("logs"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                ids, lang, texts = pickle.loads(zstandard.decompress(column(b, "payload")[i].as_py()))
                known, logs = column(b, "codes")[i].values, column(b, "logs")[i].values
                known, logs = (np.zeros(0, np.int64), np.zeros(0, np.float32)) if known is None else (known.to_numpy(), logs.to_numpy())
                yield rows(doc_id=pa.array(ids, pa.int64()), lang=pa.array(lang, pa.string()), perplexity=perplexities(known, logs, texts))

    return packs(own).join(answers, "batch", "left").select("payload", "codes", "logs").mapInArrow(run, "doc_id long, lang string, perplexity double")


def _counted() -> F.Column:
    """Four of five trusted documents, by hash of doc_id, are counted; the rest set the thresholds."""
    return F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5)) != 0


def classify(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """docs, labels (doc_id, quality) -> doc_id, lang, perplexity, threshold, kept int, a row for a row.

    Trusted text: documents labelled 1. Four of five are counted; the threshold of a language is the `keep`
    quantile of the perplexity of those held back, which the model never saw. A language without any uses
    the highest; without held-back text all is kept. Repeated rows are scored alike; an empty table gives
    an empty result; other columns are ignored.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    good = materialize(good, "good")
    counted = good.filter(_counted())
    # ids of a checked size are broadcast, so that texts stay where they are; more of them meet the texts by a shuffle
    if good.count() * 8 <= BROADCAST_BYTES:
        counted = F.broadcast(counted)
    scored = materialize(score(own, model(own.join(counted, "doc_id", "left_semi"))), "scored")
    held = scored.join(good.filter(~_counted()), "doc_id", "left_semi")
    cuts = materialize(held.groupBy("lang").agg(F.percentile_approx("perplexity", keep, 10000).alias("cut")), "cuts")
    overall = cuts.agg(F.max("cut").alias("m")).first().m
    known = cuts.select(F.col("lang").alias("of"), "cut")
    out = scored.join(known, F.col("lang") == F.col("of"), "left").withColumn("threshold", F.coalesce("cut", F.lit(float("inf") if overall is None else overall)))
    return out.select("doc_id", "lang", "perplexity", "threshold", (F.col("perplexity") <= F.col("threshold")).cast("int").alias("kept"))


def op3(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
