"""Range, nearest and band joins as equality joins over buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bucket sizes: a span lies in the first that is at least as wide, so it meets two buckets at most.
BUCKETS = tuple(64 * 8**k for k in range(9))


def containing_or_nearest(lines: DataFrame, spans: DataFrame, keys: list[str], fuzz: int = 3) -> DataFrame:
    """lines (keys, line), spans (keys, name, start, end) -> keys, line, name, kind, cost.

    The narrowest span that holds the line (kind 0, cost its width), else the span whose nearer border is
    within `fuzz` (kind 1, cost the distance); ties go to the lowest start, then name. Lines without
    either are left out; spans that start at 0 never match; a missing end is the start. Spans are laid
    over buckets of a size that fits them, and a line asks one bucket of each size, so the join is an
    equality join and no span, however wide, takes more than two rows; one row per line is kept by a
    minimum that is taken before the shuffle as well.
    """
    ends = spans.filter("start <> 0").withColumn("stop", F.coalesce(F.nullif(F.col("end"), F.lit(0)), F.col("start")))
    wide = F.col("stop").cast("long") - F.col("start") + 2 * fuzz + 1
    size = F.lit(BUCKETS[-1])
    for b in reversed(BUCKETS[:-1]):
        size = F.when(wide <= b, b).otherwise(size)
    first, last = F.floor((F.col("start").cast("long") - fuzz) / F.col("size")), F.floor((F.col("stop").cast("long") + fuzz) / F.col("size"))
    laid = ends.filter(F.col("stop") >= F.col("start")).withColumn("size", size.cast("long")).withColumn("bucket", F.explode(F.sequence(first, last)))
    sizes = F.array(*[F.lit(b).cast("long") for b in BUCKETS])
    asked = lines.select(*keys, "line").distinct().withColumn("size", F.explode(sizes)).withColumn("bucket", F.floor(F.col("line") / F.col("size")))
    inside = F.col("line").between(F.col("start"), F.col("stop"))
    kind = F.when(inside, 0).otherwise(1)
    cost = F.when(inside, F.col("stop") - F.col("start")).otherwise(F.least(F.abs(F.col("line") - F.col("start")), F.abs(F.col("line") - F.col("stop"))))
    met = asked.join(laid, [*keys, "size", "bucket"]).filter(F.col("line").between(F.col("start") - fuzz, F.col("stop") + fuzz))
    best = met.groupBy(*keys, "line").agg(F.min(F.struct(kind.alias("kind"), cost.alias("cost"), "start", "name")).alias("b"))
    return best.select(*keys, "line", F.col("b.name").alias("name"), F.col("b.kind").alias("kind"), F.col("b.cost").alias("cost"))


def near_lines(points: DataFrame, lines: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Points (keys, line) with some line within `reach`; line 0 never matches, a negative reach finds nothing."""
    if reach < 0:
        return points.limit(0)
    spread = lines.filter("line <> 0").select(*keys, F.explode(F.sequence(F.col("line") - reach, F.col("line") + reach)).alias("line")).distinct()
    return points.filter("line <> 0").join(spread, [*keys, "line"], "left_semi")
