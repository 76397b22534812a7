"""Bounded and unbounded traversals of property graphs, all samples in one loop."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sliceforge.runtime import _written, materialize, release, shared_dir


#: Hops that one job follows before its finds are written.
STRIDE = 4


def search(edges: DataFrame, seeds: DataFrame, keys: list[str], labels: list[str] | None = None, max_hops: int | None = None, stride: int = STRIDE) -> DataFrame:
    """edges (keys, src, dst), seeds (keys, labels, id) -> (keys, labels, id, depth): first visits, each label by itself.

    The edges are written once, so that no hop derives them again. A job follows `stride` hops from the last
    frontier (the small side of each join), takes the least depth of what it met, leaves out what was visited
    before, and writes the rest; plans stay small and a lost executor costs one job at most. The search ends at
    max_hops, or when the last hop of a job found nothing. A chain of n edges takes n / stride jobs.
    """
    labels = labels or []
    spark = edges.sparkSession
    base = f"{shared_dir(spark)}/sliceforge-search-{uuid.uuid4().hex}"
    _written.append((spark, base))
    arcs = materialize(edges.select(*keys, F.col("src").alias("id"), F.col("dst").alias("next")).filter("id <> next").distinct(), "arcs")
    state = [*keys, *labels, "id"]
    found = seeds.select(*state).distinct().withColumn("depth", F.lit(0))
    schema = found.schema
    paths: list[str] = []
    depth = 0
    while True:
        seen = Observation()
        path = f"{base}/{len(paths)}"
        found.observe(seen, F.count_if(F.col("depth") == depth).alias("n")).write.parquet(path)
        paths.append(path)
        if seen.get["n"] == 0 or (max_hops is not None and depth >= max_hops):
            break
        frontier = spark.read.schema(schema).parquet(path).filter(F.col("depth") == depth).select(*state)
        hops = stride if max_hops is None else min(stride, max_hops - depth)
        met = None
        for step in range(1, hops + 1):
            frontier = frontier.join(arcs, [*keys, "id"]).select(*keys, *labels, F.col("next").alias("id")).distinct()
            level = frontier.withColumn("depth", F.lit(depth + step))
            met = level if met is None else met.unionByName(level)
        visited = spark.read.schema(schema).parquet(*paths).select(*state)
        found = met.groupBy(*state).agg(F.min("depth").alias("depth")).join(visited, state, "left_anti").select(*schema.names)
        depth += hops
    release(arcs)
    return spark.read.schema(schema).parquet(*paths)


def bfs(edges: DataFrame, seeds: DataFrame, keys: list[str], max_hops: int | None = None) -> DataFrame:
    """edges (keys, src, dst), seeds (keys, id) -> (keys, id, depth): first visits of a multi-source search."""
    return search(edges, seeds, keys, max_hops=max_hops)


def symmetric(edges: DataFrame, keys: list[str]) -> DataFrame:
    return edges.select(*keys, "src", "dst").unionByName(edges.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def reversed_edges(edges: DataFrame, keys: list[str]) -> DataFrame:
    return edges.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))


def both_ways(edges: DataFrame, forward_seeds: DataFrame, backward_seeds: DataFrame, keys: list[str], max_forward: int, max_backward: int) -> tuple[DataFrame, DataFrame]:
    """Forward and backward searches in one loop: the direction is one more key."""
    arcs = edges.select(*keys, F.lit("f").alias("way"), "src", "dst").unionByName(reversed_edges(edges, keys).withColumn("way", F.lit("b")))
    seeds = forward_seeds.select(*keys, F.lit("f").alias("way"), "id").unionByName(backward_seeds.select(*keys, F.lit("b").alias("way"), "id"))
    reached = bfs(arcs, seeds, [*keys, "way"], max(max_forward, max_backward))
    one = lambda way, hops: reached.filter((F.col("way") == way) & (F.col("depth") <= hops)).drop("way")
    return one("f", max_forward), one("b", max_backward)


def khop_roles(calls: DataFrame, patched: DataFrame, keys: list[str], hops: int) -> DataFrame:
    """calls (keys, caller, callee), patched (keys, id) -> (keys, id, hop, role): who calls or is called.

    Patched functions are left out. A level takes callers and callees of the level before; where both
    reach a function in the same level it is a caller.
    """
    visited = patched.select(*keys, "id").distinct().withColumn("hop", F.lit(0)).withColumn("role", F.lit("patch"))
    visited = materialize(visited, "khop")
    frontier = visited
    arcs = materialize(
        calls.select(*keys, F.col("callee").alias("id"), F.col("caller").alias("next"), F.lit("caller").alias("as"))
        .unionByName(calls.select(*keys, F.col("caller").alias("id"), F.col("callee").alias("next"), F.lit("callee").alias("as")))
        .distinct(),
        "khop",
    )
    for hop in range(1, hops + 1):
        found = frontier.select(*keys, "id").join(arcs, [*keys, "id"]).groupBy(*keys, F.col("next").alias("id")).agg(F.max("as").alias("role"))
        level = found.join(visited.select(*keys, "id"), [*keys, "id"], "left_anti").withColumn("hop", F.lit(hop)).select(*keys, "id", "hop", "role")
        frontier = materialize(level, "khop")
        visited = visited.unionByName(frontier)
    return visited.filter("hop > 0")


def bfs_labelled(edges: DataFrame, seeds: DataFrame, keys: list[str], label: str, max_hops: int | None = None) -> DataFrame:
    """Like bfs(), but each label spreads by itself: (keys, label, id, depth)."""
    return search(edges, seeds, keys, [label], max_hops)


def climb(parents: DataFrame, keys: list[str], flags: list[str], rounds: int = 7) -> DataFrame:
    """Pointer jumping: parents (keys, id, parent, flags bool of the parent) -> (keys, id, flags): whether any of the
    2**rounds nearest strict ancestors carries each flag."""
    cur = materialize(parents.select(*keys, "id", F.col("parent").alias("ptr"), *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags]), "climb")
    for _ in range(rounds):
        up = cur.select(*keys, F.col("id").alias("ptr"), F.col("ptr").alias("next"), *[F.col(f).alias(f"{f}_up") for f in flags])
        nxt = cur.join(up, [*keys, "ptr"], "left").select(*keys, "id", F.col("next").alias("ptr"), *[(F.col(f) | F.coalesce(F.col(f"{f}_up"), F.lit(False))).alias(f) for f in flags])
        cur, old = materialize(nxt, "climb"), cur
        release(old)
        if cur.filter("ptr IS NOT NULL").isEmpty():
            break
    return cur.select(*keys, "id", *flags)


def nearest_marked(parents: DataFrame, keys: list[str], rounds: int = 7) -> DataFrame:
    """parents (keys, id, parent, marked bool) -> (keys, id, found): the nearest marked node among a node and its
    2**rounds - 1 nearest ancestors."""
    cur = materialize(parents.select(*keys, "id", F.when(F.col("marked"), F.col("id")).alias("found"), F.when(~F.col("marked"), F.col("parent")).alias("ptr")), "lift")
    for _ in range(rounds):
        if cur.filter("ptr IS NOT NULL").isEmpty():
            break
        up = cur.select(*keys, F.col("id").alias("ptr"), F.col("found").alias("up_found"), F.col("ptr").alias("next"))
        old = cur
        cur = materialize(cur.join(up, [*keys, "ptr"], "left").select(*keys, "id", F.coalesce("found", "up_found").alias("found"), F.when(F.col("found").isNull() & F.col("up_found").isNull(), F.col("next")).alias("ptr")), "lift")
        release(old)
    return cur.select(*keys, "id", "found")
