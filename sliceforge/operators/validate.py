"""Checks and distributions of an emitted dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.functions.text import sample_of
from sliceforge.operators.ingest import top
from sliceforge.runtime import materialize
from sliceforge.schemas import REQUIRED_FIELDS, REQUIRED_FILES


def label_distribution(nodes: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share of each label. Counted per label first, so the total is over a few rows."""
    counts = nodes.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select(label, "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))


def sink_reasons(sinks: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent reasons of emitted sinks."""
    return top(sinks, "sink_reason", k)


def type_distribution(nodes: DataFrame, k: int = 10) -> DataFrame:
    return top(nodes, "type", k)


def samples_of(nodes: DataFrame) -> DataFrame:
    """Nodes of each sample, read from the canonical ids."""
    parts = "^(.*):([^:]*):([^:]*)$"
    return (
        nodes.filter(F.col("id").rlike(parts))
        .groupBy(F.regexp_extract("id", parts, 1).alias("patch_id"), F.regexp_extract("id", parts, 2).alias("version"))
        .agg(F.count(F.lit(1)).alias("n_nodes"))
    )


def edge_integrity(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: edges, edges with an unknown end, edges between samples."""
    ids = nodes.select("id").distinct()
    src = ids.select(F.col("id").alias("src"), F.lit(True).alias("has_src"))
    dst = ids.select(F.col("id").alias("dst"), F.lit(True).alias("has_dst"))
    seen = edges.join(src, "src", "left").join(dst, "dst", "left")
    known = F.coalesce(F.col("has_src") & F.col("has_dst"), F.lit(False))
    return seen.agg(
        F.count(F.lit(1)).alias("edges"), F.count_if(~known).alias("unresolved"), F.count_if(known & (sample_of(F.col("src")) != sample_of(F.col("dst")))).alias("cross_sample")
    )


def missing_fields(raw: DataFrame, column: str = "value", fields=REQUIRED_FIELDS) -> DataFrame:
    """Required fields that some JSON record lacks: (field, n)."""
    keys = F.json_object_keys(F.col(column))
    absent = F.array_except(F.array(*[F.lit(f) for f in fields]), F.coalesce(keys, F.array().cast("array<string>")))
    return raw.select(F.explode(absent).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def skip_summary(skipped: DataFrame) -> DataFrame:
    """Rows of each stage with the first reason by patch and version."""
    return skipped.groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("patch_id", F.coalesce("version", F.lit("")).alias("version"), "reason")).alias("first")).select("stage", "n", "first.patch_id", "first.reason")


def run_totals(nodes: DataFrame, skipped: DataFrame, queue: DataFrame) -> DataFrame:
    """One row: patches with a sample, patches without, samples, nodes, positive nodes."""
    per_sample = nodes.groupBy("patch_id", "version").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"))
    done = per_sample.agg(F.count_distinct("patch_id").alias("processed"), F.count(F.lit(1)).alias("samples"), F.sum("n").alias("nodes"), F.sum("p").alias("positives"))
    failed = skipped.select("patch_id").distinct().join(nodes.select("patch_id").distinct(), "patch_id", "left_anti").agg(F.count(F.lit(1)).alias("skipped"))
    return done.join(F.broadcast(failed))


def report(nodes: DataFrame, edges: DataFrame, functions: DataFrame, sinks: DataFrame, skipped: DataFrame, totals: DataFrame, raw_nodes: DataFrame | None = None, have: tuple[str, ...] = REQUIRED_FILES) -> DataFrame:
    """(check, value, is_red_flag), a row for each check.

    totals is the run's row (processed, skipped): a run whose entries were all skipped is flagged, as are
    missing files, an empty dataset, missing fields, no samples, and unresolved or cross-sample edges.
    unresolved_ppm gives unresolved edges in parts per million.
    """
    def one(df: DataFrame, check: str, value, flag) -> DataFrame:
        return df.agg(value.cast("long").alias("value")).select(F.lit(check).alias("check"), "value", flag(F.col("value")).alias("is_red_flag"))

    rows, never = F.count(F.lit(1)), lambda v: v < 0
    spark = nodes.sparkSession
    missing = [n for n in REQUIRED_FILES if n not in have]
    out = spark.createDataFrame([("missing_files", len(missing), bool(missing))], "check string, value long, is_red_flag boolean")
    for name, df, flag in (("nodes", nodes, lambda v: v == 0), ("edges", edges, never), ("functions", functions, never), ("sinks", sinks, never), ("skipped", skipped, never)):
        out = out.unionByName(one(df, name, rows, flag))
    out = out.unionByName(one(totals, "all_skipped", F.max(F.when((F.col("skipped") > 0) & (F.col("processed") == 0), 1).otherwise(0)), lambda v: v > 0))
    out = out.unionByName(one(samples_of(nodes), "samples", rows, lambda v: v == 0))
    walk = materialize(edge_integrity(edges, nodes), "walk")
    for name in ("unresolved", "cross_sample"):
        out = out.unionByName(one(walk, name, F.max(name), lambda v: v > 0))
    out = out.unionByName(one(walk, "unresolved_ppm", F.max(F.coalesce(F.round(F.col("unresolved") * 1e6 / F.nullif(F.col("edges"), F.lit(0))), F.lit(0))), never))
    if raw_nodes is not None:
        out = out.unionByName(one(missing_fields(raw_nodes), "missing_fields", rows, lambda v: v > 0))
    return out


def is_sound(checks: DataFrame) -> bool:
    return checks.filter("is_red_flag").isEmpty()


def remaining(queue: DataFrame, functions: DataFrame) -> DataFrame:
    """Queue entries without a functions row: what a resumed run still has to do."""
    return queue.join(functions.select("patch_id").distinct(), "patch_id", "left_anti")
