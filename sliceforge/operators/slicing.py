"""Bounded bidirectional slices, distances to the patch and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.operators.graph import bfs, both_ways, symmetric
from sliceforge.runtime import materialize
from sliceforge.schemas import EMPTY_SLICE, NO_PATCH_NODES, SAMPLE, TRAVERSED


def traversed(edges: DataFrame) -> DataFrame:
    """Edges that a slice follows; the key stands in for a missing type."""
    return edges.filter(F.coalesce(F.col("edge_type"), F.col("edge_key")).isin(*TRAVERSED))


def patch_nodes(nodes: DataFrame, functions: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """Nodes on modified lines of patched functions (line 0 does not count): (keys, id)."""
    lines = functions.filter("role = 'patch'").select(*keys, F.col("function_full").alias("function"), F.explode("modified_lines").alias("line")).filter("line <> 0")
    return nodes.join(lines, [*keys, "function", "line"], "left_semi").select(*keys, F.col("nid").alias("id"))


def compute_slice(nodes: DataFrame, edges: DataFrame, patch: DataFrame, sinks: DataFrame, keys: list[str] = SAMPLE, max_backward: int = 10, max_forward: int = 10):
    """Slice membership and a report for each sample.

    Forward from the patch and backward from the sinks (from the patch where a sample has none); the slice
    is what both reach, and where that is empty the anchors themselves. A sample without patch
    nodes has an empty slice. Returns (slice (keys, id), report).
    """
    patch = materialize(patch.select(*keys, "id").distinct(), "patch")
    real = sinks.select(*keys, "id").distinct()
    has_sinks = real.select(*keys).distinct()
    anchors = materialize(real.join(patch.select(*keys).distinct(), keys, "left_semi").unionByName(patch.join(has_sinks, keys, "left_anti")), "anchors")
    forward, backward = both_ways(traversed(edges), patch, anchors, keys, max_forward, max_backward)
    common = forward.select(*keys, "id").join(backward.select(*keys, "id"), [*keys, "id"], "left_semi")
    common = materialize(common, "slice")
    fallback = patch.unionByName(anchors).distinct().join(common.select(*keys).distinct(), keys, "left_anti")
    chosen = common.withColumn("fallback", F.lit(False)).unionByName(fallback.withColumn("fallback", F.lit(True)))
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    report = nodes.select(*keys).distinct()
    for df, name in ((patch, "n_patch"), (real, "n_sinks"), (forward, "n_forward"), (backward, "n_backward"), (chosen, "n_slice")):
        report = report.join(count(df, name), keys, "left")
    report = report.join(chosen.groupBy(*keys).agg(F.bool_or("fallback").alias("used_fallback")), keys, "left").fillna(0, ["n_patch", "n_sinks", "n_forward", "n_backward", "n_slice"])
    skipped = F.when(F.col("n_patch") == 0, NO_PATCH_NODES).when(F.col("used_fallback"), EMPTY_SLICE)
    report = report.withColumn("patch_as_sink", (F.col("n_sinks") == 0) & (F.col("n_patch") > 0)).withColumn("skipped", skipped).drop("used_fallback")
    return chosen.select(*keys, "id"), report


def slice_by_role(nodes: DataFrame, chosen: DataFrame, functions: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    roles = functions.select(*keys, F.col("function_full").alias("function"), "role").dropDuplicates([*keys, "function"])
    members = nodes.join(chosen.withColumnRenamed("id", "nid"), [*keys, "nid"], "left_semi")
    return members.join(roles, [*keys, "function"], "left").groupBy(*keys, F.coalesce("role", F.lit("unknown")).alias("role")).agg(F.count(F.lit(1)).alias("n"))


def patch_distance(edges: DataFrame, patch: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """Undirected distance to the nearest patch node: (keys, id, depth); unreachable nodes are absent."""
    return bfs(symmetric(traversed(edges), keys), patch, keys)
