"""Risky statements: dimension lookup, lines near the patch, user overrides, in that priority."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceforge.functions.text import normalize_cwe
from sliceforge.operators.joins import near_lines
from sliceforge.schemas import SAMPLE, WEAKNESS_CALLS


def call_dimension(spark: SparkSession) -> DataFrame:
    """(cwe, api): a fixed table."""
    return spark.createDataFrame([(c, a) for c, calls in WEAKNESS_CALLS.items() for a in calls], "cwe string, api string")


def active_calls(samples: DataFrame, dimension: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """samples (keys, cwes array) -> (keys, api): calls of the sample's classes, or all calls if none is known."""
    asked = samples.select(*keys, F.explode("cwes").alias("cwe")).withColumn("cwe", normalize_cwe(F.col("cwe")))
    named = asked.join(dimension, "cwe").select(*keys, "api").distinct()
    rest = samples.select(*keys).distinct().join(named.select(*keys).distinct(), keys, "left_anti")
    # the whole dimension for each of them: its size times the samples without a known class
    every = dimension.select("api").distinct().agg(F.sort_array(F.collect_list("api")).alias("apis"))
    return named.unionByName(rest.join(every).select(*keys, F.explode("apis").alias("api")))


def fallback_notes(samples: DataFrame, dimension: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """(keys, note) of samples whose calls are not limited to their classes: no class is given, or none is listed."""
    asked = samples.select(*keys, "cwes", F.explode_outer("cwes").alias("cwe")).withColumn("cwe", normalize_cwe(F.col("cwe")))
    known = asked.join(dimension.select("cwe").distinct(), "cwe").select(*keys).distinct()
    rest = samples.select(*keys, "cwes").join(known, keys, "left_anti")
    given = F.coalesce(F.size("cwes"), F.lit(0)) > 0
    return rest.select(*keys, F.when(given, F.concat(F.lit("no calls are listed for "), F.array_join("cwes", ", "), F.lit("; all listed calls count"))).otherwise("no weakness is given; all listed calls count").alias("note"))


def mark_sinks(
    nodes: DataFrame,
    samples: DataFrame,
    patched_lines: DataFrame,
    extra: DataFrame | None = None,
    proximity: int = 3,
    keys: list[str] = SAMPLE,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """nodes (keys, nid, file, line, stmt_type, called_function, ...) with is_sink and sink_reason.

    samples (keys, cwes), patched_lines (keys, file, line), extra (keys, file, line). The first rule that
    holds gives the reason: a call of an active function; a call of any listed function near a patched
    line of the same file; a line that the user named, of any statement type.
    """
    dimension = call_dimension(nodes.sparkSession) if dimension is None else dimension
    calls = nodes.filter("stmt_type = 'CALL' AND called_function IS NOT NULL")
    by_class = calls.join(active_calls(samples, dimension, keys).withColumnRenamed("api", "called_function"), [*keys, "called_function"], "left_semi").select(*keys, "nid", F.lit(0).alias("rule"))
    listed = calls.join(dimension.select(F.col("api").alias("called_function")).distinct(), "called_function", "left_semi")
    by_line = near_lines(listed, patched_lines, [*keys, "file"], proximity).select(*keys, "nid", F.lit(1).alias("rule"))
    found = by_class.unionByName(by_line)
    if extra is not None:
        found = found.unionByName(nodes.join(extra, [*keys, "file", "line"], "left_semi").select(*keys, "nid", F.lit(2).alias("rule")))
    first = found.groupBy(*keys, "nid").agg(F.min("rule").alias("rule"))
    reason = (
        F.when(F.col("rule") == 0, F.concat(F.lit("cwe_api:"), "called_function")).when(F.col("rule") == 1, F.concat(F.lit("patch_proximity:"), "called_function")).when(F.col("rule") == 2, "user")
    )
    return nodes.join(first, [*keys, "nid"], "left").withColumn("is_sink", F.col("rule").isNotNull()).withColumn("sink_reason", reason).drop("rule")


def sink_report(marked: DataFrame, keys: list[str] = SAMPLE, notes: DataFrame | None = None) -> DataFrame:
    """A row for each sample with sinks: totals, counts by kind and by reason, and the calls that were hit.

    by_reason and calls are maps of counts; user marks add no call. top_calls lists the five most frequent
    calls, ties by name. notes (keys, note) from fallback_notes() also gives rows to samples without sinks.
    """
    kind = F.substring_index("sink_reason", ":", 1)
    hit = marked.filter("is_sink").select(*keys, "sink_reason", kind.alias("kind"), F.when(kind != "user", F.col("called_function")).alias("api"))
    totals = hit.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kind") == "cwe_api").alias("cwe_api"),
        F.count_if(F.col("kind") == "patch_proximity").alias("patch_proximity"),
        F.count_if(F.col("kind") == "user").alias("user_marked"),
    )

    def counted(column: str, name: str) -> DataFrame:
        pairs = hit.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
        return pairs.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(column, "n")))).alias(name))

    apis = counted("api", "calls")
    ranked = F.array_sort(F.map_entries("calls"), lambda a, b: F.when(a["value"] != b["value"], (b["value"] - a["value"]).cast("int")).when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    out = totals.join(counted("sink_reason", "by_reason"), keys, "left").join(apis, keys, "left")
    if notes is not None:
        out = out.join(notes, keys, "full").fillna(0, ["total", "cwe_api", "patch_proximity", "user_marked"])
    return out.withColumn("top_calls", F.transform(F.slice(ranked, 1, 5), lambda e: e["key"])).withColumn("apis_hit", F.array_join(F.map_keys("calls"), ","))
