"""Final node records: canonical ids, neighbour lists, distances and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sliceforge.functions.text import canonical_id, short_name
from sliceforge.operators.slicing import patch_distance
from sliceforge.runtime import materialize
from sliceforge.schemas import SAMPLE

#: List field of each edge type and direction.
LISTS = {
    ("CFG", "out"): "CFG_successors",
    ("CFG", "in"): "CFG_predecessors",
    ("DFG", "out"): "DFG_successors",
    ("DFG", "in"): "DFG_predecessors",
    ("CALL", "out"): "CALL_edges",
    ("CALL", "in"): "CALL_predecessors",
    ("PARAM_BIND", "out"): "PARAM_BIND_edges",
    ("PARAM_BIND", "in"): "PARAM_BIND_predecessors",
}


def canonical_ids(nodes: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """(keys, nid, canonical): dense numbers by function, line, column and raw id as text, from 0 in each sample.

    Nodes are dealt by range, numbered within each range, and moved by what the sample has in earlier ranges;
    so a large sample is ordered by many tasks.
    """
    order = ["function", "line", "column", "raw"]
    own = nodes.select(*keys, "nid", "function", "line", "column").withColumn("raw", F.col("nid").cast("string"))
    ranged = materialize(own.repartitionByRange(*keys, *order).withColumn("part", F.spark_partition_id()), "ranged")
    inside = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("part", *keys).orderBy(*order)) - 1)
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = ranged.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return inside.join(starts, [*keys, "part"]).select(*keys, "nid", canonical_id(F.col(keys[0]), F.col(keys[1]), F.col("first") + F.col("nth")).alias("canonical"))


def neighbour_lists(edges: DataFrame, ids: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """(keys, nid, one list for each edge type and direction): distinct neighbours by raw id, as canonical ids."""
    ends = edges.select(*keys, F.col("src").alias("nid"), F.col("dst").alias("other"), "edge_type", F.lit("out").alias("way")).unionByName(
        edges.select(*keys, F.col("dst").alias("nid"), F.col("src").alias("other"), "edge_type", F.lit("in").alias("way"))
    )
    named = ends.join(ids.select(*keys, F.col("nid").alias("other"), "canonical"), [*keys, "other"], "left")
    pair = F.struct(F.col("other").cast("string").alias("raw"), F.coalesce("canonical", F.col("other").cast("string")).alias("id"))
    lists = [
        F.transform(F.array_sort(F.collect_set(F.when((F.col("edge_type") == kind) & (F.col("way") == way), pair))), lambda p: p["id"]).alias(name) for (kind, way), name in LISTS.items()
    ]
    return named.groupBy(*keys, "nid").agg(*lists)


def cross_function(edges: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """Nodes at either end of a call or argument edge: (keys, nid)."""
    touching = edges.filter(F.col("edge_type").isin("CALL", "PARAM_BIND"))
    return touching.select(*keys, F.explode(F.array("src", "dst")).alias("nid")).distinct()


def annotate_counts(records: DataFrame, keys: list[str] = SAMPLE) -> DataFrame:
    """Nodes, labelled nodes and cross-function nodes of each sample."""
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("label") == 1).alias("labelled"), F.count_if("is_cross_function").alias("cross_function"))


def annotate(nodes: DataFrame, edges: DataFrame, patch: DataFrame, chosen: DataFrame, functions: DataFrame, commits: DataFrame | None = None, keys: list[str] = SAMPLE, ids: DataFrame | None = None) -> DataFrame:
    """The emitted node relation. nodes must carry is_sink and sink_reason; chosen is the slice (keys, id)."""
    ids = canonical_ids(nodes, keys) if ids is None else ids
    meta = functions.select(*keys, F.col("function_full").alias("function"), "role", F.col("file").alias("function_file"), "modified_lines").dropDuplicates([*keys, "function"])
    empty = F.array().cast("array<string>")
    out = (
        nodes.join(ids, [*keys, "nid"])
        .join(neighbour_lists(edges, ids, keys), [*keys, "nid"], "left")
        .join(patch_distance(edges, patch, keys).select(*keys, F.col("id").alias("nid"), F.col("depth").alias("distance_to_patch")), [*keys, "nid"], "left")
        .join(cross_function(edges, keys).withColumn("is_cross_function", F.lit(True)), [*keys, "nid"], "left")
        .join(chosen.select(*keys, F.col("id").alias("nid")).distinct().withColumn("in_slice", F.lit(True)), [*keys, "nid"], "left")
        .join(meta, [*keys, "function"], "left")
    )
    if commits is not None:
        out = out.join(commits, keys, "left")
    in_slice = F.coalesce("in_slice", F.lit(False))
    return out.select(
        F.col("canonical").alias("id"),
        *keys,
        (F.col("commit") if "commit" in out.columns else F.lit(None).cast("string")).alias("commit"),
        short_name(F.col("function")).alias("function"),
        F.col("function").alias("function_full"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("function_file", F.lit("")).alias("file"),
        F.coalesce("modified_lines", F.array().cast("array<int>")).alias("modified_lines"),
        F.col("code").alias("statement"),
        F.col("stmt_type").alias("type"),
        "line",
        F.col("depth_cfg").alias("depth"),
        "depth_cfg",
        "depth_ast",
        "variables_used",
        "variables_defined",
        "in_loop",
        "in_branch",
        "called_function",
        F.coalesce("is_sink", F.lit(False)).alias("is_sink"),
        "sink_reason",
        F.col("distance_to_patch").isNotNull().alias("is_patch_related"),
        "distance_to_patch",
        F.coalesce("is_cross_function", F.lit(False)).alias("is_cross_function"),
        *[F.coalesce(F.col(name), empty).alias(name) for name in LISTS.values()],
        in_slice.alias("in_slice"),
        in_slice.cast("int").alias("label"),
    )
