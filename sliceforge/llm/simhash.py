"""SimHash near-duplicate groups by deletion-variant signatures.

A 64-bit fingerprint is cut into just so many segments that of two fingerprints within the allowed
distance one segment differs by at most one bit (distance 2: two segments of 32 bits). Each segment
is indexed once for every bit position with that bit wiped out (a one-wildcard variant); two segments
within one bit share a variant, so an equality join over variants finds every pair, and the whole
distance is verified afterwards.

Only distinct fingerprints are indexed. A variant bucket of two members is a candidate pair; buckets
of more members (families of near copies) are not expanded into pairs: their members are indexed by
the whole-fingerprint one-bit variants instead, whose buckets hold at most 65 fingerprints, all
within two bits of each other, so a star through the smallest member keeps every connection.

The pipeline's stage (keep_one) groups texts of similar word shingles: fingerprints propose pairs, also
farther apart where a variant shows them, an exact comparison decides. Fingerprints of texts just similar
enough may differ in any number of bits, so MinHash keys (neardup) propose as well, for all that is out of reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.llm.neardup import kept_rows, named_texts
from sliceforge.llm.textkit import portions
from sliceforge.operators.components import connected_components
from sliceforge.runtime import materialize, release, ship

BITS = 64
#: Fingerprints whose variants one task makes.
SPREAD = 20_000
#: Bits in which two fingerprints that are alone in a variant may differ for keep_one to compare their texts.
REACH = 12
_xxh = partial(xxhash.xxh64_intdigest, seed=42)
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of the lower-cased word shingles of a text; no words give 0."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(_xxh(joined)).astype(np.int64))
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends]
    n = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, n, _BLOCK):  # long texts in blocks
        hi = min(n, lo + _BLOCK)
        h = np.fromiter(
            map(_xxh, [joined[a : b - 1] for a, b in zip(starts[lo:hi], ends[lo + shingle - 1 : hi + shingle - 1], strict=True)]),
            np.uint64,
            hi - lo,
        )
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """docs -> (doc_id, fp long), a row for each row; null text counts as empty."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in portions(batches):
            fps = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), fps], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def links(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (u, v), none beyond max_distance, whose components hold all pairs within two bits.

    At a distance of 2 they are just the components of those pairs. A wider one also links two fingerprints within it that
    are alone in a variant, which shows only part of the pairs beyond two bits.
    """
    if max_distance < 2:
        raise ValueError("segments and variants are laid out for a distance of 2 or more")
    spark = fps.sparkSession
    # each becomes 64 rows: enough partitions that a task's rows stay in memory, however few bytes they come from
    fps = fps.repartition(max(spark.sparkContext.defaultParallelism, fps.count() // SPREAD + 1))
    half = "CASE WHEN k < 32 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L END"
    signed = (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("k"))
        .select("fp", F.expr(f"shiftleft(CAST(k AS BIGINT), 32) | (({half}) & ~shiftleft(1L, k % 32))").alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
        .filter("n > 1")
    )
    shared = materialize(signed, "variants")
    pairs = shared.filter(f"n = 2 AND bit_count(u ^ v) <= {int(max_distance)}").select("u", "v")
    # A crowded variant stands for two segment values: the wiped bit unset and set.
    crowded = (
        shared.filter("n > 2")
        .select(
            F.expr("CAST(shiftright(key, 37) AS INT)").alias("segment"),
            F.explode(F.expr("array(key & 4294967295L, (key & 4294967295L) | shiftleft(1L, CAST(shiftright(key, 32) % 32 AS INT)))")).alias("value"),
        )
        .distinct()
    )
    members = (
        fps.select("fp", F.explode(F.expr("array(struct(0 AS segment, shiftrightunsigned(fp, 32) AS value), struct(1 AS segment, fp & 4294967295L AS value))")).alias("s"))
        .select("fp", "s.segment", "s.value")
        .join(crowded, ["segment", "value"], "left_semi")
        .select("fp")
        .distinct()
    )
    stars = (
        members.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit"))
        .select("fp", F.expr("CASE WHEN bit < 0 THEN fp ELSE fp ^ shiftleft(1L, bit) END").alias("variant"))
        .groupBy("variant")
        .agg(F.array_sort(F.collect_list("fp")).alias("near"))  # 65 members at most
        .filter(F.size("near") > 1)
        .select(F.col("near")[0].alias("u"), F.explode(F.slice("near", 2, BITS + 1)).alias("v"))
    )
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", max_distance: int = 2) -> DataFrame:
    """docs (doc_id, text, ...) -> one row per row of docs: doc_id, fp, component_id.

    component_id is the smallest doc_id reachable over links of at most max_distance bits. Null and
    empty texts have fingerprint 0 and link like any other. Rows with a null doc_id keep a row; they
    never name a component (a component of such rows only has a null id). Repeated rows stay repeated.
    An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    if max_distance != 2:
        raise ValueError("components are whole for a distance of 2 only")
    prints = materialize(fingerprints(docs, text), "prints")
    owners = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comps = connected_components(links(owners.select("fp"), max_distance))
    grouped = owners.join(comps, owners.fp == comps.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    lowest = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    named = grouped.join(lowest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def op9(spark, sf_dir: str) -> DataFrame:
    from sliceforge.runtime import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def proposals(texts: DataFrame) -> DataFrame:
    """(tid long, text), equal texts of equal tid -> links (u, v) of the tids whose fingerprints are equal, within two bits,
    or within REACH and alone in a variant."""
    prints = materialize(fingerprints(texts.withColumnRenamed("tid", "doc_id")).distinct(), "prints")
    owners = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "fps")
    same = prints.join(owners, "fp").filter("doc_id <> low").select(F.col("doc_id").alias("u"), F.col("low").alias("v"))
    far = links(owners.select("fp"), REACH)
    ends = [owners.select(F.col("fp").alias(c), F.col("low").alias(f"{c}_tid")) for c in ("u", "v")]
    named = far.join(ends[0], "u").join(ends[1], "v").select(F.col("u_tid").alias("u"), F.col("v_tid").alias("v"))
    out = materialize(same.unionByName(named), "proposals")
    release(prints)
    release(owners)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """The pipeline stage: of each group the row with the smallest doc_id stays, with its own columns.

    Fingerprints propose pairs (proposals), MinHash keys those that they do not reach, and five-word shingles of
    similarity 0.8 or more decide (neardup). Rows without a doc_id cannot be told apart and stay. Of rows that
    repeat that doc_id with the same text one stays; under one doc_id with different texts, the text whose hash
    stands for the group stays, and no other.
    """
    spark = docs.sparkSession
    ship(spark)
    names = [f"c{i}" for i in range(len(docs.columns))]  # other columns may have any name
    at = {c: n for c, n in zip(docs.columns, names, strict=True)}
    own = docs.toDF(*names)
    key, body = F.col(at["doc_id"]).cast("long"), F.xxhash64(F.coalesce(at["text"], F.lit("")))
    kept = kept_rows(docs.select("doc_id", "text"), proposals(named_texts(docs).select("tid", "text"))).select(F.col("doc_id").alias("kept_id"), F.col("tid").alias("kept_tid"))
    first = own.join(kept, (key == F.col("kept_id")) & (body == F.col("kept_tid")))
    # repeated rows: the first by all their columns, so that a second run keeps the same one
    best = first.groupBy("kept_id", "kept_tid").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row")).select(*[F.col(f"row.{n}").alias(n) for n in names])
    return best.unionByName(own.filter(F.col(at["doc_id"]).isNull())).toDF(*docs.columns)
