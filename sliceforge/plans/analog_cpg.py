"""Exported graphs derived from the star-schema tables, in Spark and as SQL.

A nation is a graph, a customer a method, an order a node under the method's block, a line item a node under its
order. An order's kind is its key modulo 8: assignment, call, IF, WHILE, RETURN, local, a listed call, identifier.
Orders after an IF or WHILE of the same customer stand in its block, so control structures nest. Line items hang in
two chains under their order: the first two are its children, each other one is a child of the one two before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sliceforge.runtime import materialize, table

G = ["graph_id"]


def customers(spark: SparkSession, d: str) -> DataFrame:
    """(c, g, r, m, file, start): rank and number within the nation, file and first line of the method."""
    own = Window.partitionBy("c_nationkey")
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("c"),
        F.concat(F.lit("g"), "c_nationkey").alias("g"),
        F.row_number().over(own.orderBy("c_custkey")).alias("r"),
        F.count(F.lit(1)).over(own).alias("m"),
    ).select("*", F.expr("concat('file', c % 5, '.c')").alias("file"), (F.col("r") * 100).alias("start"))


def orders(spark: SparkSession, d: str) -> DataFrame:
    """(o, c, g, seq, kind, ctl, nxt, target, line): place among the customer's orders, last control structure before, next order."""
    own = Window.partitionBy("c").orderBy("o")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("o"), F.col("o_custkey").alias("c")).join(customers(spark, d), "c").withColumn("kind", (F.col("o") % 8).cast("int"))
    placed = rows.select(
        "o", "c", "g", "r", "m", "kind", "file", "start",
        F.row_number().over(own).alias("seq"),
        F.last(F.when(F.col("kind").isin(2, 3), F.col("o")), ignorenulls=True).over(before).alias("ctl"),
        F.lead("o").over(own).alias("nxt"),
        ((F.col("r") + F.col("o")) % F.col("m") + 1).alias("target_r"),
    )
    named = customers(spark, d).select("g", F.col("r").alias("target_r"), F.col("c").alias("target"))
    return placed.join(named, ["g", "target_r"]).withColumn("line", F.col("start") + F.col("seq"))


def leaves(spark: SparkSession, d: str) -> DataFrame:
    """(o, rn, ident, name) of line items."""
    own = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o"), F.row_number().over(own).alias("rn"), (F.col("l_partkey") % 3 != 0).alias("ident"), F.expr("concat('v', l_partkey % 11)").alias("name")
    )


_PROPS = "name string, fullName string, filename string, lineNumber bigint, lineNumberEnd bigint, code string, methodFullName string, controlStructureType string, argumentIndex bigint, columnNumber bigint"


def _node(rows: DataFrame, node_id: str, label: str, **props: str) -> DataFrame:
    typed = [x.split() for x in _PROPS.split(", ")]
    return rows.select(F.col("g").alias("graph_id"), F.expr(node_id).alias("id"), F.expr(label).alias("_label"), *[F.expr(props.get(n, "NULL")).cast(t).alias(n) for n, t in typed])


def graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) as an export gives them."""
    c, o = customers(spark, d), materialize(orders(spark, d), "orders")
    leaf = materialize(leaves(spark, d).join(o.select("o", "g", "kind", "line", "nxt"), "o"), "leaves")
    odd = c.filter("r = 1")
    nodes = (
        _node(c, "concat('m', c)", "'METHOD'", name="concat('f', c)", fullName="concat('f', c)", filename="file", lineNumber="start", lineNumberEnd="start + 60")
        .unionByName(_node(odd, "concat('x', g)", "'METHOD'", name="'<operator>.addition'", fullName="'<operator>.addition'", filename="'<empty>'"))
        .unionByName(_node(odd, "concat('y', g)", "'METHOD'", name="'<global>'", fullName="concat(file, ':<global>')", filename="file", lineNumber="1", lineNumberEnd="99999"))
        .unionByName(_node(c, "concat('b', c)", "'BLOCK'"))
        .unionByName(_node(o.filter("kind IN (2, 3)"), "concat('k', o)", "'BLOCK'"))
        .unionByName(
            _node(
                o,
                "concat('s', o)",
                "CASE kind WHEN 0 THEN 'CALL' WHEN 1 THEN 'CALL' WHEN 2 THEN 'CONTROL_STRUCTURE' WHEN 3 THEN 'CONTROL_STRUCTURE' WHEN 4 THEN 'RETURN' WHEN 5 THEN 'LOCAL' WHEN 6 THEN 'CALL' ELSE 'IDENTIFIER' END",
                name="CASE kind WHEN 0 THEN '<operator>.assignment' WHEN 1 THEN concat('f', target) WHEN 5 THEN concat('v', o % 11) WHEN 6 THEN element_at(array('memcpy', 'strlen', 'puts'), CAST(o % 3 + 1 AS INT)) WHEN 7 THEN concat('v', o % 11) END",
                methodFullName="CASE kind WHEN 0 THEN '<operator>.assignment' WHEN 1 THEN CASE WHEN o % 16 = 9 THEN concat('ext', o % 7) ELSE concat('f', target) END END",
                controlStructureType="CASE kind WHEN 2 THEN 'IF' WHEN 3 THEN 'WHILE' END",
                lineNumber="line",
                columnNumber="kind",
                code="concat('  code ', o, ' ')",
            )
        )
        .unionByName(
            _node(leaf, "concat('i', o, '_', rn)", "CASE WHEN ident THEN 'IDENTIFIER' ELSE 'CALL' END", name="CASE WHEN ident THEN name ELSE '<operator>.addition' END", methodFullName="CASE WHEN NOT ident THEN '<operator>.addition' END", lineNumber="line", argumentIndex="rn")
        )
    )

    def edge(rows: DataFrame, src: str, dst: str, kind: str, pos: str = "0") -> DataFrame:
        return rows.select(F.col("g").alias("graph_id"), F.expr(src).alias("src"), F.expr(dst).alias("dst"), F.lit(kind).alias("etype"), F.expr(pos).cast("bigint").alias("child_pos"))

    one = leaf.filter("rn = 1").select("o", "g", "nxt")
    pairs = one.join(one.select(F.col("o").alias("nxt")), "nxt")
    edges = (
        edge(c, "concat('m', c)", "concat('b', c)", "AST")
        .unionByName(edge(o, "coalesce(concat('k', ctl), concat('b', c))", "concat('s', o)", "AST", "seq"))
        .unionByName(edge(o, "concat('m', c)", "concat('s', o)", "CONTAINS", "seq"))
        .unionByName(edge(o.filter("kind IN (2, 3)"), "concat('s', o)", "concat('k', o)", "AST", "100"))
        .unionByName(edge(leaf, "CASE WHEN rn <= 2 THEN concat('s', o) ELSE concat('i', o, '_', rn - 2) END", "concat('i', o, '_', rn)", "AST", "rn"))
        .unionByName(edge(o.filter("seq = 1"), "concat('m', c)", "concat('s', o)", "CFG"))
        .unionByName(edge(o.filter("nxt IS NOT NULL"), "concat('s', o)", "concat('s', nxt)", "CFG"))
        .unionByName(edge(leaf.filter("rn = 2"), "concat('i', o, '_1')", "concat('i', o, '_2')", "CFG"))
        .unionByName(edge(pairs, "concat('i', o, '_1')", "concat('i', nxt, '_1')", "REACHING_DEF"))
        .unionByName(edge(o.filter("kind = 1 AND o % 16 <> 9"), "concat('s', o)", "concat('m', target)", "CALL"))
        .unionByName(edge(leaf.filter("kind IN (1, 6) AND rn <= 2"), "concat('s', o)", "concat('i', o, '_', rn)", "ARGUMENT", "rn"))
    )
    return nodes, edges


def modified(spark: SparkSession, d: str) -> DataFrame:
    """Changed lines: inside a method, just before one, or far from any."""
    shift = F.expr("CASE c % 9 WHEN 0 THEN 2 WHEN 1 THEN -2 WHEN 2 THEN -10 END")
    return customers(spark, d).select(F.col("g").alias("graph_id"), "file", (F.col("start") + shift).cast("int").alias("line")).filter("line IS NOT NULL")


#: The same relations for the SQL side; statements are worked out from the rule that made the graph.
CPG_SQL = """
cu AS (
  SELECT c_custkey AS c, 'g' || c_nationkey AS g, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r, count(*) OVER (PARTITION BY c_nationkey) AS m,
         'file' || (c_custkey % 5) || '.c' AS file FROM customer
), od0 AS (
  SELECT o_orderkey AS o, cu.c, cu.g, cu.r, cu.m, cu.file, o_orderkey % 8 AS kind, row_number() OVER w AS seq, lead(o_orderkey) OVER w AS nxt,
         max(CASE WHEN o_orderkey % 8 IN (2, 3) THEN o_orderkey END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ctl
  FROM orders JOIN cu ON cu.c = o_custkey WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)
), od AS (
  SELECT od0.*, t.c AS target, od0.r * 100 + seq AS line, CASE WHEN kind <> 7 THEN 's' || o WHEN ctl IS NOT NULL THEN 's' || ctl ELSE 'm' || od0.c END AS stmt
  FROM od0 JOIN cu t ON t.g = od0.g AND t.r = (od0.r + o) % od0.m + 1
), lf AS (
  SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn, l_partkey % 3 <> 0 AS ident, 'v' || (l_partkey % 11) AS name
  FROM lineitem WHERE l_orderkey IN (SELECT o FROM od0)
), calls AS (
  SELECT DISTINCT g, c AS caller, target AS callee FROM od WHERE kind = 1 AND o % 16 <> 9
), hit AS (
  SELECT g, c, CASE c % 9 WHEN 0 THEN r * 100 + 2 ELSE r * 100 - 2 END AS line FROM cu WHERE c % 9 IN (0, 1)
)
"""
