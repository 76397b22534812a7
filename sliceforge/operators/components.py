"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceforge.runtime import materialize, release


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x or 0


def _named(stars: DataFrame) -> DataFrame:
    """Each node with its centre; a centre names itself."""
    centres = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres.withColumn("component", F.col("node")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u long, v long) -> (node long, component long), component = smallest node reachable.

    Nodes without an edge do not appear; self loops and repeated edges are harmless. Every round
    replaces edges by stars around smaller nodes, so the edge count never grows and the number of
    rounds is logarithmic even on long chains. Each round is written to the shared folder. Hot
    centres are pre-aggregated (min) and joined back by an ordinary join that AQE may split.
    """
    cur = materialize(
        edges.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "cc",
    )
    before = _state(cur)
    if before[0] == 0:
        return _named(cur)
    for _ in range(max_rounds):
        # large star: every larger neighbour of u moves to the smallest neighbour of u
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        )
        # small star: u and its smaller neighbours move to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select(F.col("e.a").alias("u"), F.col("e.b").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        nxt = materialize(small, "cc")
        after = _state(nxt)
        release(cur)
        cur = nxt
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    return _named(cur)
