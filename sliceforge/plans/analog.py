"""Statement graphs and source rows derived from the star-schema tables, in Spark and as SQL.

The tables hold no code, so operators run on analogs: users are functions, events are statements in time
order, and the number in an event's properties steers calls, patches and sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sliceforge.runtime import table

KEYS = ["patch_id", "version"]


def nodes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "props")
    line = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(
        F.lit("p").alias("patch_id"),
        F.lit("v").alias("version"),
        F.col("event_id").alias("nid"),
        F.col("user_id").alias("function"),
        line.alias("line"),
        F.lit(0).alias("column"),
        F.col("event_type").alias("stmt_type"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k"),
        "ts",
    )


def edges(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d)
    order = ["ts", "nid"]
    cfg = n.select(*KEYS, F.col("nid").alias("src"), F.lead("nid").over(Window.partitionBy("function").orderBy(*order)).alias("dst"), F.lit("CFG").alias("edge_type"))
    dfg = n.select(*KEYS, F.col("nid").alias("src"), F.lead("nid").over(Window.partitionBy("function", "stmt_type").orderBy(*order)).alias("dst"), F.lit("DFG").alias("edge_type"))
    users = n.agg((F.max("function") + 1).alias("users"))
    heads = n.filter("line = 1").select(F.col("function").alias("target"), F.col("nid").alias("dst"))
    call = (
        n.filter("stmt_type = 'error' AND k < 30")
        .join(F.broadcast(users))
        .withColumn("target", (F.col("function") * 7 + F.col("k")) % F.col("users"))
        .join(heads, "target")
        .select(*KEYS, F.col("nid").alias("src"), "dst", F.lit("CALL").alias("edge_type"))
    )
    out = cfg.unionByName(dfg).unionByName(call).filter("dst IS NOT NULL AND src <> dst")
    return out.withColumn("edge_key", F.col("edge_type"))


def patch(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).filter("stmt_type = 'signup' AND k < 2").select(*KEYS, F.col("nid").alias("id"))


def sinks(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).filter("stmt_type = 'purchase' AND k >= 97").select(*KEYS, F.col("nid").alias("id"))


#: The same relations for the SQL side.
GRAPH_SQL = """
n AS (
  SELECT event_id AS nid, user_id AS function, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS line,
         event_type AS stmt_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, ts FROM events
), e0 AS (
  SELECT nid AS src, lead(nid) OVER (PARTITION BY function ORDER BY ts, nid) AS dst, 'CFG' AS edge_type FROM n
  UNION ALL SELECT nid, lead(nid) OVER (PARTITION BY function, stmt_type ORDER BY ts, nid), 'DFG' FROM n
  UNION ALL SELECT a.nid, b.nid, 'CALL' FROM n a JOIN n b ON b.line = 1 AND b.function = (a.function * 7 + a.k) % (SELECT max(function) + 1 FROM n)
            WHERE a.stmt_type = 'error' AND a.k < 30
), e AS (SELECT * FROM e0 WHERE dst IS NOT NULL AND src <> dst),
patch AS (SELECT nid AS id FROM n WHERE stmt_type = 'signup' AND k < 2),
sink AS (SELECT nid AS id FROM n WHERE stmt_type = 'purchase' AND k >= 97)
"""

SEARCH_SQL = """
f(id, depth) AS (SELECT id, 0 FROM patch UNION SELECT e.dst, f.depth + 1 FROM f JOIN e ON e.src = f.id WHERE f.depth < 10),
b(id, depth) AS (SELECT id, 0 FROM sink UNION SELECT e.src, b.depth + 1 FROM b JOIN e ON e.dst = b.id WHERE b.depth < 10),
fd AS (SELECT id, min(depth) AS depth FROM f GROUP BY id),
bd AS (SELECT id, min(depth) AS depth FROM b GROUP BY id),
s AS (SELECT id FROM fd INTERSECT SELECT id FROM bd)
"""


def spans(spark: SparkSession, d: str) -> DataFrame:
    """Functions with line intervals: suppliers by nation."""
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        F.col("s_nationkey").alias("file"), k.alias("name"), (k * 13 % 90).cast("int").alias("start"), F.when(k % 5 == 0, 0).otherwise(k * 13 % 90 + k * 7 % 23).cast("int").alias("end")
    )


def lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("file"), (F.col("c_custkey") % 100).cast("int").alias("line"))


SPANS_SQL = """
sp AS (SELECT s_nationkey AS file, s_suppkey AS name, CAST(s_suppkey * 13 % 90 AS INTEGER) AS start,
              CAST(CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE s_suppkey * 13 % 90 + s_suppkey * 7 % 23 END AS INTEGER) AS "end" FROM supplier),
sx AS (SELECT file, name, start, coalesce(nullif("end", 0), start) AS stop FROM sp WHERE start <> 0),
ln AS (SELECT DISTINCT c_nationkey AS file, CAST(c_custkey % 100 AS INTEGER) AS line FROM customer)
"""
