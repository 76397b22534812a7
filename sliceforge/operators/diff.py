"""Unified diffs as rows: modified lines of both versions by windows over the line order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sliceforge.functions.text import LINE_BREAK, strip

HUNK = "^@@ -([0-9]+)(?:,[0-9]+)? \\+([0-9]+)(?:,[0-9]+)? @@"


def lines(diffs: DataFrame, key: str = "patch_id", text: str = "diff") -> DataFrame:
    """One row for each line of a diff text: key, pos, raw."""
    parts = F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"(?:{LINE_BREAK})\\z", ""), LINE_BREAK)
    return diffs.select(key, F.posexplode(parts).alias("pos", "raw"))


def walked(diff_lines: DataFrame, key: str = "patch_id", strict_headers: bool = False) -> DataFrame:
    """Lines inside hunks with their file, segment, tag and numbers in the old and the new version."""
    order = Window.partitionBy(key).orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = diff_lines.filter("raw IS NOT NULL AND raw <> ''")
    header = F.col("raw").startswith("+++ ")
    if strict_headers:
        old_header = F.col("raw").startswith("--- ") & F.coalesce(F.lead("raw").over(order).startswith("+++ "), F.lit(False))
        rows = rows.withColumn("skip", old_header)
    else:
        rows = rows.withColumn("skip", F.lit(False))
    path = strip(F.substring(F.col("raw"), F.lit(5), F.length("raw")))
    path = F.when(path == "/dev/null", "").otherwise(F.regexp_replace(path, "^b/", ""))
    rows = (
        rows.withColumn("header", header)
        .withColumn("hunk", ~header & F.col("raw").rlike(HUNK))
        .withColumn("file", F.last(F.when(header, path), ignorenulls=True).over(so_far))
        .withColumn("seg", F.sum(F.when(F.col("header") | F.col("hunk"), 1).otherwise(0)).over(so_far))
    )
    in_seg = Window.partitionBy(key, "seg").orderBy("pos")
    seg_so_far = in_seg.rowsBetween(Window.unboundedPreceding, 0)
    tag = F.when(~F.col("header") & ~F.col("hunk") & ~F.col("skip") & (F.col("file") != "") & F.left("raw", F.lit(1)).isin(" ", "+", "-"), F.left("raw", F.lit(1)))
    rows = (
        rows.withColumn("tag", tag)
        .withColumn("old0", F.first(F.when(F.col("hunk"), F.regexp_extract("raw", HUNK, 1).try_cast("int")), ignorenulls=True).over(seg_so_far))
        .withColumn("new0", F.first(F.when(F.col("hunk"), F.regexp_extract("raw", HUNK, 2).try_cast("int")), ignorenulls=True).over(seg_so_far))
    )
    before = in_seg.rowsBetween(Window.unboundedPreceding, -1)
    seen = lambda *tags: F.coalesce(F.sum(F.when(F.col("tag").isin(*tags), 1).otherwise(0)).over(before), F.lit(0))
    return rows.withColumn("old", F.col("old0") + seen(" ", "-")).withColumn("new", F.col("new0") + seen(" ", "+")).filter("tag IS NOT NULL AND old0 IS NOT NULL")


def modified_lines(diff_lines: DataFrame, key: str = "patch_id", strict_headers: bool = False, window: int = 2, fill: bool = True) -> DataFrame:
    """(key, pos, raw) -> (key, file, version, line), distinct.

    By default only `+++ ` lines are headers, so the `--- ` line of a following file counts as a removed
    line of the file before it; strict_headers leaves such lines out. With fill, a file without removed
    lines gets the context lines next to its added ones (the first hunk that has any).
    """
    steps = walked(diff_lines, key, strict_headers)
    removed = steps.filter("tag = '-'").select(key, "file", F.lit("vulnerable").alias("version"), F.col("old").cast("int").alias("line"))
    added = steps.filter("tag = '+'").select(key, "file", F.lit("fixed").alias("version"), F.col("new").cast("int").alias("line"))
    out = removed.unionByName(added)
    if fill:
        out = out.unionByName(context_lines(steps, key, window).select(key, "file", F.lit("vulnerable").alias("version"), "line"))
    return out.distinct()


def context_lines(steps: DataFrame, key: str = "patch_id", window: int = 2) -> DataFrame:
    """Context lines beside pure additions: among the first `window` after an added line, or among the last
    `window` before one with no removed line between."""
    order = Window.partitionBy(key, "seg").orderBy("pos")
    back, ahead = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    counted = steps.withColumn("cc", F.sum(F.when(F.col("tag") == " ", 1).otherwise(0)).over(back)).withColumn("mc", F.sum(F.when(F.col("tag") == "-", 1).otherwise(0)).over(back))
    plus = F.col("tag") == "+"
    counted = (
        counted.withColumn("cc_last", F.last(F.when(plus, F.col("cc")), ignorenulls=True).over(back))
        .withColumn("cc_next", F.first(F.when(plus, F.col("cc")), ignorenulls=True).over(ahead))
        .withColumn("mc_next", F.first(F.when(plus, F.col("mc")), ignorenulls=True).over(ahead))
    )
    kept = counted.filter(
        (F.col("tag") == " ") & ((F.col("cc") - F.col("cc_last") <= window) | ((F.col("mc_next") == F.col("mc")) & (F.col("cc_next") - F.col("cc") < window)))
    )
    first_seg = kept.groupBy(key, "file").agg(F.min("seg").alias("seg"))
    with_removed = steps.filter("tag = '-'").select(key, "file").distinct()
    return kept.join(first_seg, [key, "file", "seg"]).join(with_removed, [key, "file"], "left_anti").select(key, "file", F.col("old").cast("int").alias("line"))
