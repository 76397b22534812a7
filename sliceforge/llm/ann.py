"""Nearest neighbours by additive quantisation.

A vector is coded as a sum of codewords, one from each codebook; all codebooks span the whole space and
each was trained on what the ones before leave (residual k-means on a bounded sample). Encoding keeps a
beam of the best partial sums. The squared norm of the sum is stored with the code, so that the distance
to a query is  |q|^2 + norm - 2 * sum of table[codebook, code],  where the table holds the query's inner
products with all codewords: scoring reads tables only. The best by that score are a query's shortlist.

How close the codes come depends on the rows, so the shortlist alone is no answer. With each code goes how far the
sum misses its vector; the triangle inequality turns distance to the sum and miss into bounds of the distance to the
vector. The k-th smallest distance (or upper bound) of the shortlist bounds the k-th nearest, and every vector whose
lower bound is not above that is compared exactly, in double precision. No nearest vector is lost, whatever the rows;
rows that codes fit badly only rule out fewer vectors.

Executors pack codes into chunks and queries into blocks; every block meets every chunk in tasks that keep a
running best of each query and emit it once a block, so what a task returns does not grow with the codes it
reads. Nothing but the codebooks, their sample and counts passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sliceforge.llm.textkit import column, rows
from sliceforge.runtime import materialize, ship, table

CODEBOOKS = 24
WORDS = 256
BEAM = 4
#: The most vectors that codebooks are fitted on, whatever the size of the input.
TRAIN_VECTORS = 16384
ITERATIONS = 6
#: Queries of a block, codes of a chunk, and chunks that one task takes.
QUERY_BLOCK, CHUNK, CHUNKS_A_TASK = 512, 16384, 16
#: Candidates of each query that are reranked exactly.
RERANK = 256
#: Vectors of a chunk that are compared exactly, in bytes.
CHUNK_BYTES = 1 << 20
#: Scaled components are coded within these bounds, so that single-precision sums stay finite.
FAR = 1e9
#: Allowances for rounding: of the original components (relative), and of double and single precision sums (per dimension).
INPUT, DOUBLE, SINGLE = 1e-12, 1e-15, 2.5e-7


@dataclass
class Books:
    words: np.ndarray  # (codebooks, words, dims) float32


def fit(sample: np.ndarray, codebooks: int = CODEBOOKS, words: int = WORDS, seed: int = 5) -> Books:
    """Residual k-means: each codebook is fitted on the residuals of the sample under the ones before."""
    rng = np.random.default_rng(seed)
    left = sample.astype(np.float32).copy()
    out = np.zeros((codebooks, words, sample.shape[1]), np.float32)
    for m in range(codebooks):
        centres = left[rng.choice(len(left), words, replace=len(left) < words)].copy()
        centres += rng.normal(0, 1e-4, centres.shape)
        for _ in range(ITERATIONS):
            near = (0.5 * (centres**2).sum(1) - left @ centres.T).argmin(1)
            n = np.bincount(near, minlength=words)
            total = np.zeros_like(centres)
            np.add.at(total, near, left)
            centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
        near = (0.5 * (centres**2).sum(1) - left @ centres.T).argmin(1)
        left -= centres[near]
        out[m] = centres
    return Books(out)


def decode(words: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The sums that codes stand for; words in double precision."""
    out = np.zeros((len(codes), words.shape[2]))
    for m in range(len(words)):
        out += words[m][codes[:, m]]
    return out


def encode(books: Books, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (n, codebooks) uint8 by beam search, squared norms of the coded vectors, and how far those miss x."""
    n = len(x)
    m, words, _ = books.words.shape
    codes = np.zeros((n, m), np.uint8)
    norms, misses = np.zeros(n), np.zeros(n)
    half = 0.5 * (books.words**2).sum(2)
    exact = books.words.astype(np.float64)
    for lo in range(0, n, 512):
        part = np.clip(x[lo : lo + 512], -FAR, FAR).astype(np.float32)
        b = len(part)
        left = part[:, None, :]  # (b, beam, dims)
        path = np.zeros((b, 1, 0), np.uint8)
        rows = np.arange(b)[:, None]
        for k in range(m):
            width = left.shape[1]
            gain = half[k] - left @ books.words[k].T  # (b, width, words)
            cost = 0.5 * (left**2).sum(2)[:, :, None] + gain
            flat = cost.reshape(b, -1)
            keep = min(beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
            src, word = best // words, best % words
            assert src.max() < width
            left = left[rows, src] - books.words[k][word]
            path = np.concatenate([path[rows, src], word[:, :, None].astype(np.uint8)], axis=2)
        top = (left**2).sum(2).argmin(1)
        codes[lo : lo + b] = path[np.arange(b), top]
        sums = decode(exact, codes[lo : lo + b])
        norms[lo : lo + b] = (sums**2).sum(1)
        with np.errstate(over="ignore"):
            misses[lo : lo + b] = np.sqrt(((x[lo : lo + b] - sums) ** 2).sum(1))
    return codes, norms, misses


def usable(vector: str) -> F.Column:
    """Neither null nor empty, without null or non-finite components, and not all zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


@dataclass
class Frame:
    """Where the origin of the codes lies, and what distances from it are divided by."""

    centre: np.ndarray
    scale: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.scale

    def rounding(self, x: np.ndarray) -> np.ndarray:
        """No more than this is lost of a scaled distance by moving x into the frame."""
        with np.errstate(over="ignore"):
            return INPUT * (np.sqrt((x**2).sum(1)) + np.sqrt((self.centre**2).sum())) / self.scale


def framed(sample: np.ndarray) -> Frame:
    """Around the component-wise median, in units of the typical largest component."""
    centre = np.sort(sample, axis=0)[len(sample) // 2]
    far = np.abs(sample - centre).max(axis=1)
    some = far[(far > 0) & np.isfinite(far)]
    return Frame(centre, float(np.median(some)) if len(some) else 1.0)


@dataclass
class Index:
    """Codes of all usable vectors: rows (row, id, v, code, norm, miss), codebooks, and the frame that vectors are coded in."""

    rows: DataFrame
    books: Books
    frame: Frame


def index(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> Index | None:
    """Codes every usable vector; None if there is none.

    Vectors of another length than the most frequent one take no part: distances between lengths are not defined.
    """
    spark = vectors.sparkSession
    ship(spark)
    fine = vectors.filter(usable(vector)).filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"))
    sizes = fine.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return None
    fine = fine.filter(F.size("v") == int(sizes.d))
    drawn = fine.orderBy(F.xxhash64("id"), "id", F.xxhash64("v")).limit(TRAIN_VECTORS).select(F.col("v").cast("array<double>").alias("v")).collect()
    sample = np.array([r.v for r in drawn])
    frame = framed(sample)
    books = fit(np.clip(frame.of(sample), -FAR, FAR))
    held = spark.sparkContext.broadcast(books)  # size fixed by codebooks, words and dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = column(b, "v").flatten().to_numpy().astype(np.float64).reshape(len(b), -1)
                codes, norms, misses = encode(held.value, frame.of(x))
                misses = misses * (1 + 1e-9) + frame.rounding(x)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.shape[1]), len(codes), [None, pa.py_buffer(codes)]).cast(pa.binary()), pa.array(norms), pa.array(misses)], names=[*b.schema.names, "code", "norm", "miss"])

    kind = fine.schema["v"].dataType.simpleString()
    numbered = fine.withColumn("row", F.monotonically_increasing_id())
    return Index(materialize(numbered.mapInArrow(run, f"id long, v {kind}, row long, code binary, norm double, miss double"), "codes"), books, frame)


def _packed(table_: DataFrame, size: int, name: str) -> DataFrame:
    """Packs of at most `size` rows, made by executors: (name, a binary column for each column's values end to end)."""
    names = table_.columns

    def flat(values: pa.ChunkedArray) -> bytes:
        if pa.types.is_list(values.type):  # vectors, all of one length
            return values.combine_chunks().flatten().to_numpy().tobytes()
        return b"".join(values.to_pylist()) if pa.types.is_binary(values.type) else values.to_numpy().tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def pack() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            return rows(**{name: pa.array([number], pa.int64())}, **{c: [flat(t.column(c))] for c in names})

        for b in batches:
            at = 0
            while at < len(b):
                take = min(size - n, len(b) - at)
                held.append(b.slice(at, take))
                n, at = n + take, at + take
                if n == size:
                    yield pack()
                    number, held, n = number + 1, [], 0
        if n:
            yield pack()

    return table_.mapInArrow(run, ", ".join([f"{name} long", *(f"{c} binary" for c in names)]))


def _meetings(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every block of queries (columns q_) with every chunk: a task holds some chunks and the blocks that it meets in order."""
    slots = chunks.count() // CHUNKS_A_TASK + 1
    dealt = chunks.withColumn("slot", F.pmod(F.xxhash64("chunk"), F.lit(slots)))
    asked = blocks.select("block", *[F.col(c).alias(f"q_{c}") for c in blocks.columns if c != "block"])
    met = asked.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long")))).join(dealt, "slot")
    return met.repartition(F.col("slot"), F.col("block")).sortWithinPartitions("slot", "block")


def _doubles(body: bytes, lines: int) -> np.ndarray:
    return np.frombuffer(body, np.float64).reshape(lines, -1)


def _best(score: np.ndarray, row: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The `keep` smallest of each line of scores, ties in any order, with their rows."""
    if score.shape[1] > keep:
        pick = np.argpartition(score, keep - 1, axis=1)[:, :keep]
        score, row = np.take_along_axis(score, pick, 1), np.take_along_axis(row, pick, 1)
    return score, row


def shortlist(asked: DataFrame, coded: DataFrame, books: Books, keep: int) -> DataFrame:
    """asked (row, x binary of a query's scaled doubles), coded (row, code, norm) -> (q, row, approx): for each query row q
    the best `keep` codes of each task, its own row left out."""
    spark = asked.sparkSession
    held = spark.sparkContext.broadcast(books)
    chunks = materialize(_packed(coded.select("row", "code", F.col("norm").cast("float")), CHUNK, "chunk"), "chunks")
    blocks = materialize(_packed(asked.select("row", "x"), QUERY_BLOCK, "block"), "blocks")
    met = _meetings(blocks, chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value.words
        now, q_row, tables, score, row = None, None, None, None, None

        def told() -> pa.RecordBatch:
            fine = np.isfinite(score)
            return rows(q=np.repeat(q_row, fine.sum(axis=1)), row=row[fine], approx=score[fine])

        for b in batches:
            for i in range(len(b)):
                key = column(b, "slot")[i].as_py(), column(b, "block")[i].as_py()
                if key != now:
                    if now is not None:
                        yield told()
                    now, q_row = key, np.frombuffer(column(b, "q_row")[i].as_py(), np.int64)
                    q = np.clip(_doubles(column(b, "q_x")[i].as_py(), len(q_row)), -FAR, FAR).astype(np.float32)
                    tables = 2 * np.einsum("qd,mwd->mqw", q, words)
                    score, row = np.zeros((len(q_row), 0), np.float32), np.zeros((len(q_row), 0), np.int64)
                own = np.frombuffer(column(b, "row")[i].as_py(), np.int64)
                code = np.frombuffer(column(b, "code")[i].as_py(), np.uint8).reshape(len(own), -1)
                norm = np.frombuffer(column(b, "norm")[i].as_py(), np.float32)
                for lo in range(0, len(own), 2048):  # a piece of a chunk at a time bounds the scores held
                    part, at = code[lo : lo + 2048], own[lo : lo + 2048]
                    fresh = np.repeat(norm[None, lo : lo + 2048], len(q_row), axis=0)
                    for m in range(len(words)):
                        fresh -= tables[m][:, part[:, m]]
                    fresh[q_row[:, None] == at[None, :]] = np.inf
                    fresh, where = _best(fresh, np.broadcast_to(at, fresh.shape), keep)
                    score, row = _best(np.concatenate((score, fresh), axis=1), np.concatenate((row, where), axis=1), keep)
        if now is not None:
            yield told()

    return met.select("slot", "block", "q_row", "q_x", "row", "code", "norm").mapInArrow(run, "q long, row long, approx float")


class _Nearest:
    """The k nearest so far of each query of a block, by exact distance, ties to the smaller id, then row."""

    def __init__(self, y: np.ndarray, k: int):
        self.y, self.k, self.turned = y, k, np.ascontiguousarray(y.T)
        self.square = (y**2).sum(1)
        self.limit = np.full(len(y), np.inf)  # no candidate of a larger squared distance is among the k nearest
        self.kept = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)  # query, score, id, row

    def meet(self, x: np.ndarray, ids: np.ndarray, row: np.ndarray, asked: np.ndarray) -> None:
        """asked (queries, candidates): which pairs to compare. Products only rule pairs out; scores are summed in order."""
        square = self.square[:, None] + (x**2).sum(1)[None, :]
        about = square - 2 * (self.y @ x.T)
        off = 4 * DOUBLE * (x.shape[1] + 8) * square
        above = np.where(asked, about + off, np.inf)
        above[np.isnan(above)] = np.inf
        if len(x) >= self.k:
            self.limit = np.minimum(self.limit, np.partition(above, self.k - 1, axis=1)[:, self.k - 1])
        q, c = np.nonzero(asked & ~(about - off > self.limit[:, None]))
        turned = np.ascontiguousarray(x.T)
        for lo in range(0, len(q), 1 << 18):
            a, b = q[lo : lo + (1 << 18)], c[lo : lo + (1 << 18)]
            total = np.zeros(len(a))
            for d in range(len(turned)):
                step = turned[d][b] - self.turned[d][a]
                total += step * step
            self._keep(a, np.sqrt(total), ids[b], row[b])

    def _keep(self, *fresh: np.ndarray) -> None:
        q, score, ids, row = (np.concatenate(x) for x in zip(self.kept, fresh, strict=True))
        order = np.lexsort((row, ids, score, q))
        q, score, ids, row = q[order], score[order], ids[order], row[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last = rank == self.k - 1
        self.limit[q[last]] = np.minimum(self.limit[q[last]], score[last] ** 2 * (1 + 1e-12))
        fine = rank < self.k
        self.kept = q[fine], score[fine], ids[fine], row[fine]


def compare(asked: DataFrame, coded: DataFrame, books: Books, dims: int, k: int) -> DataFrame:
    """asked (row, x: scaled, y: original, both binary doubles, bound), coded (row, id, v, code, norm, miss)
    -> (q, row, vec_id, score): for each query row q the exact k nearest of each task, its own row left out, among the
    vectors that the codes do not put beyond the query's bound."""
    spark = asked.sparkSession
    held = spark.sparkContext.broadcast(books)
    width = 4 if coded.schema["v"].dataType.elementType.simpleString() == "float" else 8
    vectors = coded.withColumn("v", F.col("v").cast("array<float>" if width == 4 else "array<double>"))
    chunks = materialize(_packed(vectors, max(1, min(CHUNK, CHUNK_BYTES // (dims * width))), "chunk"), "vectors")
    blocks = materialize(_packed(asked, QUERY_BLOCK, "block"), "bounds")
    met = _meetings(blocks, chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value.words.astype(np.float64)
        now, q_row, q, square, bound, best = None, None, None, None, None, None

        def told() -> pa.RecordBatch:
            at, score, ids, row = best.kept
            return rows(q=q_row[at], row=row, vec_id=ids, score=score)

        with np.errstate(over="ignore", invalid="ignore"):
            for b in batches:
                for i in range(len(b)):
                    cell = lambda name, kind: np.frombuffer(column(b, name)[i].as_py(), kind)  # noqa: B023, E731
                    key = column(b, "slot")[i].as_py(), column(b, "block")[i].as_py()
                    if key != now:
                        if now is not None:
                            yield told()
                        now, q_row, bound = key, cell("q_row", np.int64), cell("q_bound", np.float64)
                        q, best = cell("q_x", np.float64).reshape(len(q_row), -1), _Nearest(cell("q_y", np.float64).reshape(len(q_row), -1), k)
                        square = (q**2).sum(1)
                    own, ids, norm, miss = cell("row", np.int64), cell("id", np.int64), cell("norm", np.float64), cell("miss", np.float64)
                    code = cell("code", np.uint8).reshape(len(own), -1)
                    v = cell("v", np.float32 if width == 4 else np.float64).reshape(len(own), -1)
                    for lo in range(0, len(own), 2048):  # a piece of a chunk at a time bounds the distances held
                        part = slice(lo, lo + 2048)
                        both = square[:, None] + norm[None, part]
                        near = both - 2 * (q @ decode(words, code[part]).T) - 4 * DOUBLE * (dims + 8) * both
                        beyond = np.sqrt(np.maximum(near, 0)) - miss[None, part] > bound[:, None]  # false where not a number
                        open_ = ~beyond & (q_row[:, None] != own[None, part])
                        some = np.flatnonzero(open_.any(axis=0))
                        if len(some):
                            best.meet(v[part][some].astype(np.float64), ids[part][some], own[part][some], open_[:, some])
        if now is not None:
            yield told()

    return met.drop("chunk").mapInArrow(run, "q long, row long, vec_id long, score double")


def search(vectors: DataFrame, is_query, k: int = 10, rerank: int = RERANK, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest of each query: query_id, rank (from 1), vec_id, score, nearest first, ties to the smaller id.

    is_query: a condition on column `id`. Candidates are all usable vectors but the query's own row; with fewer
    than k all of them are returned. Rows that repeat an id are a query each, and a candidate each.
    Unusable vectors (null, empty, zero, with null or non-finite components) take no part. An empty
    table gives an empty result. Other columns are ignored. rerank: how many of the best by code give a query's bound.
    """
    spark = vectors.sparkSession
    built = index(vectors, id_col, vector)
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    frame, dims = built.frame, len(built.frame.centre)

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                y = column(b, "v").flatten().to_numpy().astype(np.float64).reshape(len(b), -1)
                x = frame.of(y)
                as_bytes = lambda part: pa.array([r.tobytes() for r in part], pa.binary())
                with np.errstate(over="ignore"):
                    square = (np.clip(x, -FAR, FAR) ** 2).sum(1)
                    beside = np.sqrt(((x - np.clip(x, -FAR, FAR)) ** 2).sum(1))
                yield rows(row=column(b, "row"), id=column(b, "id"), x=as_bytes(x), y=as_bytes(y), square=square, slack=frame.rounding(y), beside=beside)

    queries = built.rows.filter(is_query).select("row", "id", "v")
    asked = materialize(queries.mapInArrow(bytes_of, "row long, id long, x binary, y binary, square double, slack double, beside double"), "asked")
    keep = max(rerank, k)
    near = shortlist(asked, built.rows, built.books, keep)
    first = Window.partitionBy("q").orderBy("approx", "row")  # as many rows a query as tasks times `keep`
    short = near.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= keep).select("q", "row", "approx")
    double = F.col("v").cast("array<double>")
    there = built.rows.select("row", double.alias("x"), "norm", "miss")
    here = queries.select(F.col("row").alias("q"), double.alias("y")).join(asked.select(F.col("row").alias("q"), "square", "slack", "beside"), "q")
    distance = F.sqrt(F.aggregate(F.zip_with("x", "y", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)) / frame.scale * (1 + 1e-9)
    both = F.col("square") + F.col("norm")
    upper = F.sqrt(F.greatest(F.lit(0.0), F.col("approx") + F.col("square") + SINGLE * (dims + 100) * both)) * (1 + 1e-9) + F.col("miss") + F.col("beside")
    kth = lambda c: F.coalesce(F.try_element_at(F.sort_array(F.collect_list(c)), F.lit(k)), F.lit(float("inf")))
    bounds = short.join(there, "row").join(here, "q").groupBy("q").agg(F.least(kth(distance), kth(upper)).alias("bound"))
    bounded = asked.join(bounds, F.col("row") == F.col("q"), "left").select("row", "x", "y", (F.coalesce("bound", F.lit(float("inf"))) + F.col("slack")).alias("bound"))
    found = compare(bounded, built.rows, built.books, dims, k)
    ranked = Window.partitionBy("q").orderBy("score", "vec_id", "row")
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.join(asked.select(F.col("row").alias("q"), F.col("id").alias("query_id")), "q").select("query_id", "rank", "vec_id", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
