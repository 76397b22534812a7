"""Queries over derived graphs: methods, calls, candidates, statements, edges, bindings; and the whole build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceforge.operators import diff, graph, program, sinks
from sliceforge.plans import analog_cpg as C
from sliceforge.plans import build
from sliceforge.runtime import materialize, table

_W = f"WITH {C.CPG_SQL}"


def _whole(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges unwritten: a filter on a label or a kind then reads only the tables it is made of."""
    return C.graph(spark, d)


def methods(spark: SparkSession, d: str) -> DataFrame:
    return program.methods(C.graph(spark, d)[0]).select("graph_id", "full_name", "file", "start", "end")


METHODS_SQL = _W + """SELECT g AS graph_id, 'f' || c AS full_name, file, r * 100 AS start, r * 100 + 60 AS "end" FROM cu"""


def ownership(spark: SparkSession, d: str) -> DataFrame:
    """Nodes that each method owns."""
    nodes, edges = _whole(spark, d)
    return program.ownership(nodes, edges, program.methods(nodes)).groupBy("graph_id", "owner").agg(F.count(F.lit(1)).alias("n"))


OWNERSHIP_SQL = _W + """SELECT g AS graph_id, 'm' || c AS owner, 2 + count(DISTINCT od.o) + count(DISTINCT CASE WHEN kind IN (2, 3) THEN od.o END) + count(lf.o) AS n
FROM (SELECT g, c FROM cu) x LEFT JOIN (SELECT o, kind, c FROM od) od USING (c) LEFT JOIN lf ON lf.o = od.o GROUP BY 1, 2"""


def call_status(spark: SparkSession, d: str) -> DataFrame:
    """Resolved, external and orphan calls of each graph; calls of unowned nodes are added as orphans."""
    nodes, edges = C.graph(spark, d)
    lost = nodes.filter("id LIKE 's%' AND _label = 'CALL' AND methodFullName LIKE 'f%' AND CAST(substring(id, 2) AS BIGINT) % 24 = 1").withColumn("id", F.concat(F.lit("lost"), "id"))
    calls, stats = program.call_graph(nodes.unionByName(lost), edges)
    return stats.withColumn("unknown_targets", F.array_join("unknown_targets", ","))


STATUS_SQL = _W + """SELECT g AS graph_id, count(*) FILTER (kind = 1 AND o % 16 <> 9) AS resolved, count(*) FILTER (kind = 1 AND o % 16 = 9) AS external,
count(*) FILTER (kind = 1 AND o % 16 <> 9 AND o % 24 = 1) AS orphan, coalesce(array_to_string(list_sort(list(DISTINCT 'ext' || (o % 7)) FILTER (kind = 1 AND o % 16 = 9))[1:5], ','), '') AS unknown_targets
FROM od GROUP BY 1"""


def call_pairs(spark: SparkSession, d: str) -> DataFrame:
    return program.call_graph(*_whole(spark, d))[0]


PAIRS_SQL = _W + "SELECT g AS graph_id, 'f' || caller AS caller, 'f' || callee AS callee FROM calls"


def khop_two(spark: SparkSession, d: str) -> DataFrame:
    """Callers and callees within two calls of the methods whose customer key ends a run of 40."""
    calls, _ = program.call_graph(*_whole(spark, d))
    patched = C.customers(spark, d).filter("c % 40 = 0").select(F.col("g").alias("graph_id"), F.expr("concat('f', c)").alias("id"))
    return graph.khop_roles(calls, patched, C.G, 2)


KHOP_SQL = _W + """, p AS (SELECT DISTINCT g, c FROM cu WHERE c % 40 = 0), a AS (SELECT g, callee AS x, caller AS y, 'caller' AS role FROM calls UNION SELECT g, caller, callee, 'callee' FROM calls),
h1 AS (SELECT a.g, y AS c, max(role) AS role FROM a JOIN p ON p.g = a.g AND p.c = a.x WHERE (a.g, y) NOT IN (SELECT (g, c) FROM p) GROUP BY 1, 2),
h2 AS (SELECT a.g, y AS c, max(a.role) AS role FROM a JOIN h1 ON h1.g = a.g AND h1.c = a.x WHERE (a.g, y) NOT IN (SELECT (g, c) FROM p UNION SELECT (g, c) FROM h1) GROUP BY 1, 2)
SELECT g AS graph_id, 'f' || c AS id, 1 AS hop, role FROM h1 UNION ALL SELECT g, 'f' || c, 2, role FROM h2"""


def _candidates(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    nodes, edges = _whole(spark, d)
    calls, _ = program.call_graph(nodes, edges)
    found, skipped = program.candidate_functions(C.modified(spark, d), program.methods(nodes), calls, C.G, 1)
    return nodes, edges, found, skipped


def candidates(spark: SparkSession, d: str) -> DataFrame:
    out = _candidates(spark, d)[2]
    return out.select("graph_id", "function_full", "name", "role", "hop_distance", F.array_join("modified_lines", ",").alias("modified_lines"), "file")


_CANDIDATES = """, near AS (
  SELECT calls.g, caller AS c, 'caller' AS role FROM calls JOIN hit ON hit.g = calls.g AND hit.c = callee UNION SELECT calls.g, callee, 'callee' FROM calls JOIN hit ON hit.g = calls.g AND hit.c = caller
), cand AS (
  SELECT g, c, 'patch' AS role, 0 AS hop, CAST(line AS VARCHAR) AS lines FROM hit
  UNION ALL SELECT g, c, max(role), 1, '' FROM near WHERE c NOT IN (SELECT c FROM hit) GROUP BY 1, 2
)"""
CANDIDATES_SQL = _W + _CANDIDATES + "SELECT cand.g AS graph_id, 'f' || c AS function_full, 'f' || c AS name, role, hop AS hop_distance, lines AS modified_lines, file FROM cand JOIN cu USING (c)"


def scoped(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and edges inside the candidates, and candidates without a method node (two made-up ones a graph)."""
    nodes, edges, found, _ = _candidates(spark, d)
    more = found.select("graph_id").distinct().select("graph_id", F.lit("gone").alias("function_full"))
    inside, between, missing = program.scoped(nodes, edges, found.select("graph_id", "function_full").unionByName(more))
    part = lambda df, name: df.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit(name))
    return part(inside, "nodes").unionByName(part(between.filter("etype = 'AST'"), "tree")).unionByName(part(missing, "missing"))


SCOPED_SQL = _W + _CANDIDATES + """, size AS (SELECT cand.g, cand.c, 2 + count(DISTINCT od.o) + count(DISTINCT CASE WHEN kind IN (2, 3) THEN od.o END) + count(lf.o) AS n
FROM cand LEFT JOIN (SELECT o, kind, c FROM od) od USING (c) LEFT JOIN lf ON lf.o = od.o GROUP BY 1, 2)
SELECT g AS graph_id, CAST(sum(n) AS BIGINT) AS n, 'nodes' AS what FROM size GROUP BY 1 UNION ALL SELECT g, CAST(sum(n - 1) AS BIGINT), 'tree' FROM size GROUP BY 1 UNION ALL SELECT g, 1, 'missing' FROM size GROUP BY 1"""


def _statements(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    nodes, edges = _whole(spark, d)
    every = program.methods(nodes).select("graph_id", F.col("full_name").alias("function_full"))
    inside, between, _ = program.scoped(nodes, edges, every)
    inside, between = materialize(inside, "inside"), materialize(between, "between")
    return inside, between, *program.statement_graph(inside, between)


def statement_nodes(spark: SparkSession, d: str) -> DataFrame:
    listed = lambda c: F.array_join(c, ",").alias(c)
    return _statements(spark, d)[2].select(
        "graph_id", "nid", "function", "line", "column", "stmt_type", "code", "depth_cfg", "depth_ast", listed("variables_used"), listed("variables_defined"), "in_loop", "in_branch", "called_function", "file"
    )


_SCOPE = """, sc AS (
  SELECT a.o AS root, b.o, b.kind FROM od a JOIN od b ON b.c = a.c AND (b.o = a.o OR (a.kind IN (2, 3) AND b.o > a.o)) WHERE a.kind <> 7
), nm AS (
  SELECT 's' || root AS nid, lf.name, 'u' AS how FROM sc JOIN lf ON lf.o = sc.o WHERE ident
  UNION SELECT 's' || root, 'v' || (o % 11), CASE kind WHEN 7 THEN 'u' ELSE 'd' END FROM sc WHERE kind IN (5, 7)
  UNION SELECT 'm' || od.c, lf.name, 'u' FROM od JOIN lf ON lf.o = od.o WHERE ident
  UNION SELECT 'm' || c, 'v' || (o % 11), CASE kind WHEN 7 THEN 'u' ELSE 'd' END FROM od WHERE kind IN (5, 7)
), lhs AS (
  SELECT 's' || od.o AS nid, min_by(lf.name, rn) AS name FROM od JOIN lf ON lf.o = od.o WHERE kind = 0 AND rn % 2 = 1 AND ident GROUP BY 1
), used AS (
  SELECT nm.nid, coalesce(string_agg(DISTINCT nm.name, ',' ORDER BY nm.name) FILTER (how = 'u' AND nm.name IS DISTINCT FROM lhs.name), '') AS used FROM nm LEFT JOIN lhs USING (nid) GROUP BY 1
), def AS (
  SELECT nid, string_agg(DISTINCT name, ',' ORDER BY name) AS defined FROM (SELECT nid, name FROM nm WHERE how = 'd' UNION SELECT * FROM lhs) GROUP BY 1
), st AS (
  SELECT g, 's' || o AS nid, c, line, kind, seq AS depth_cfg, 2 + 2 * (SELECT count(*) FROM od b WHERE b.c = od.c AND b.o < od.o AND b.kind IN (2, 3)) AS depth_ast,
         EXISTS (SELECT 1 FROM od b WHERE b.c = od.c AND b.o < od.o AND b.kind = 3) AS in_loop, EXISTS (SELECT 1 FROM od b WHERE b.c = od.c AND b.o < od.o AND b.kind = 2) AS in_branch,
         CASE kind WHEN 0 THEN 'ASSIGN' WHEN 1 THEN 'CALL' WHEN 2 THEN 'IF' WHEN 3 THEN 'WHILE' WHEN 4 THEN 'RETURN' WHEN 5 THEN 'DECL' ELSE 'CALL' END AS stmt_type, 'code ' || o AS code,
         CASE kind WHEN 1 THEN 'f' || target WHEN 6 THEN ['memcpy', 'strlen', 'puts'][o % 3 + 1] END AS called, file FROM od WHERE kind <> 7
  UNION ALL SELECT g, 'm' || c, c, r * 100, 0, 0, 0, false, false, 'METHOD_ENTRY', '', NULL, file FROM cu
)"""
STATEMENTS_SQL = _W + _SCOPE + """SELECT g AS graph_id, nid, 'f' || c AS function, CAST(line AS INTEGER) AS line, CAST(kind AS INTEGER) AS "column", stmt_type, code, CAST(depth_cfg AS INTEGER) AS depth_cfg,
CAST(depth_ast AS INTEGER) AS depth_ast, coalesce(used, '') AS variables_used, coalesce(defined, '') AS variables_defined, in_loop, in_branch, called AS called_function, file
FROM st LEFT JOIN used USING (nid) LEFT JOIN def USING (nid)"""


def statement_edges(spark: SparkSession, d: str) -> DataFrame:
    return _statements(spark, d)[3]


_FLOWS = """, fl AS (
  SELECT g, 'm' || c AS a, stmt AS b, 'CFG' AS kind FROM od WHERE seq = 1
  UNION SELECT x.g, x.stmt, y.stmt, 'CFG' FROM od x JOIN od y ON y.o = x.nxt
  UNION SELECT x.g, x.stmt, y.stmt, 'DFG' FROM od x JOIN od y ON y.o = x.nxt JOIN lf p ON p.o = x.o AND p.rn = 1 JOIN lf q ON q.o = y.o AND q.rn = 1
  UNION SELECT g, 's' || o, 'm' || target, 'CALL' FROM od WHERE kind = 1 AND o % 16 <> 9
)"""
EDGES_SQL = _W + _FLOWS + "SELECT g AS graph_id, a AS src, b AS dst, kind AS edge_key, kind AS edge_type FROM fl WHERE a <> b"


def bindings(spark: SparkSession, d: str) -> DataFrame:
    inside, between, _, _, lifted = _statements(spark, d)
    return program.param_bindings(inside, between, lifted)


BINDINGS_SQL = _W + """SELECT g AS graph_id, 's' || od.o AS src, 'm' || target AS dst, 'PARAM_BIND_' || rn AS edge_key, 'PARAM_BIND' AS edge_type, CAST(rn AS INTEGER) AS arg_index
FROM od JOIN lf ON lf.o = od.o WHERE kind = 1 AND o % 16 <> 9 AND rn <= 2""".replace("od JOIN lf ON lf.o = od.o WHERE kind = 1 AND o % 16", "od JOIN lf ON lf.o = od.o WHERE kind = 1 AND od.o % 16")


def function_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes need no traits of the statements, only which nodes are some."""
    nodes, edges = _whole(spark, d)
    every = program.methods(nodes).select("graph_id", F.col("full_name").alias("function_full"))
    inside = materialize(program.scoped(nodes, edges, every)[0].select("graph_id", "id", "owner", "_label", "name", "fullName"), "inside")
    return program.size_report(program.statements(inside, edges), warn=10)


SIZES_SQL = _W + _SCOPE + "SELECT g AS graph_id, 'f' || c AS function, count(*) AS n, count(*) > 10 AS large FROM st GROUP BY 1, 2"


# --- diffs of orders --------------------------------------------------------------------------------

_TAG = "CASE l_returnflag WHEN 'R' THEN '-' WHEN 'A' THEN '+' ELSE ' ' END"


def _diffs(spark: SparkSession, d: str) -> DataFrame:
    """A diff text of each order: its line items are the lines of one hunk; items of odd orders are never removed."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(f"CASE WHEN l_orderkey % 2 = 1 AND l_returnflag = 'R' THEN ' ' ELSE {_TAG} END").alias("tag"))
    body = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "tag"))).alias("items"))
    head = "'--- a/dir/f' || l_orderkey % 50 || '.c\\n+++ b/dir/f' || l_orderkey % 50 || '.c\\n@@ -' || (l_orderkey % 90 + 1) || ',9 +' || (l_orderkey % 70 + 1) || ',9 @@ int g()'"
    return body.select(F.col("l_orderkey").cast("string").alias("patch_id"), F.concat(F.expr(head), F.expr("array_join(transform(items, x -> '\\n' || x.tag || 'x' || x.l_partkey), '')"), F.lit("\n")).alias("diff"))


_DIFF_SQL = f"""
WITH t AS (SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS i, CASE WHEN l_orderkey % 2 = 1 AND l_returnflag = 'R' THEN ' ' ELSE {_TAG} END AS tag FROM lineitem),
w AS (SELECT *, o % 90 + 1 + count(*) FILTER (tag <> '+') OVER b AS old, o % 70 + 1 + count(*) FILTER (tag <> '-') OVER b AS new,
  count(*) FILTER (tag = ' ') OVER (PARTITION BY o ORDER BY i) AS cc FROM t WINDOW b AS (PARTITION BY o ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT DISTINCT o FROM w WHERE tag = '+' AND o NOT IN (SELECT o FROM w WHERE tag = '-')),
x AS (SELECT w.*, (SELECT max(v.cc) FROM w v WHERE v.o = w.o AND v.tag = '+' AND v.i < w.i) AS before, (SELECT min(v.cc) FROM w v WHERE v.o = w.o AND v.tag = '+' AND v.i > w.i) AS after FROM w WHERE tag = ' ' AND o IN (SELECT o FROM p)),
m AS (SELECT o, 'vulnerable' AS version, old AS line FROM w WHERE tag = '-' UNION SELECT o, 'fixed', new FROM w WHERE tag = '+' UNION SELECT o, 'vulnerable', old FROM x WHERE cc - before <= 2 OR after - cc < 2)
"""


def modified_lines(spark: SparkSession, d: str) -> DataFrame:
    return diff.modified_lines(diff.lines(_diffs(spark, d)))


MODIFIED_SQL = _DIFF_SQL + "SELECT CAST(o AS VARCHAR) AS patch_id, 'dir/f' || (o % 50) || '.c' AS file, version, CAST(line AS INTEGER) AS line FROM m"


def addition_context(spark: SparkSession, d: str) -> DataFrame:
    return diff.context_lines(diff.walked(diff.lines(_diffs(spark, d)))).distinct()


CONTEXT_SQL = _DIFF_SQL + "SELECT DISTINCT CAST(o AS VARCHAR) AS patch_id, 'dir/f' || (o % 50) || '.c' AS file, CAST(old AS INTEGER) AS line FROM x WHERE cc - before <= 2 OR after - cc < 2"


def strict_headers(spark: SparkSession, d: str) -> DataFrame:
    """Two files a diff: read plainly, the second file's old header counts as a removed line of the first; strictly, it does not."""
    one = _diffs(spark, d)
    two = one.withColumn("diff", F.concat("diff", F.lit("--- a/z.c\n+++ b/z.c\n@@ -1,1 +1,1 @@\n-a\n+b")))
    count = lambda strict: diff.modified_lines(diff.lines(two), strict_headers=strict, fill=False).groupBy("version").agg(F.count(F.lit(1)).alias("n")).withColumn("strict", F.lit(strict))
    return count(False).unionByName(count(True))


STRICT_SQL = _DIFF_SQL + """, k AS (SELECT o, count(*) FILTER (tag = '-') AS r, count(DISTINCT CASE WHEN tag = '+' THEN new END) AS a FROM w GROUP BY 1)
SELECT 'vulnerable' AS version, CAST(sum(r + 2) AS BIGINT) AS n, false AS strict FROM k UNION ALL SELECT 'fixed', CAST(sum(a + 1) AS BIGINT), false FROM k
UNION ALL SELECT 'vulnerable', CAST(sum(r + 1) AS BIGINT), true FROM k UNION ALL SELECT 'fixed', CAST(sum(a + 1) AS BIGINT), true FROM k"""


# --- the build --------------------------------------------------------------------------------------


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A patch from each nation's graph to the next one's; nation 5's diff and the last one's fixed graph are missing.

    The diff of patch n removes line 2 of every ninth method of nation n and adds line 2 of every ninth of the next.
    """
    nodes, edges = C.graph(spark, d)
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    cwes = F.expr("CASE k % 3 WHEN 0 THEN array('cwe 120') WHEN 1 THEN array('CWE-9999') ELSE array() END").cast("array<string>")
    extra = F.expr("CASE WHEN k % 4 = 0 THEN array(named_struct('file', 'file1.c', 'line', 101)) ELSE array() END").cast("array<struct<file:string,line:int>>")
    queue = n.select(F.expr("'p' || k").alias("patch_id"), F.expr("'g' || k").alias("commit_vuln"), F.expr("'g' || (k + 1)").alias("commit_fix"), cwes.alias("cwes"), extra.alias("extra_sinks"))
    nine = C.customers(spark, d).filter("c % 9 = 0").withColumn("k", F.expr("CAST(substring(g, 2) AS INT)"))
    sides = nine.select("k", "file", F.expr("'--- a/' || file || '\\n+++ b/' || file || '\\n@@ -' || (start + 2) || ',1 +1,0 @@\\n-x\\n'").alias("t")).unionByName(
        nine.filter("k > 0").select((F.col("k") - 1).alias("k"), "file", F.expr("'--- a/' || file || '\\n+++ b/' || file || '\\n@@ -1,0 +' || (start + 2) || ',1 @@\\n+x\\n'").alias("t"))
    )
    # headers of one form only: strict reading is not the default, so old headers stay away from hunks
    texts = sides.filter("k <> 5").groupBy(F.expr("'p' || k").alias("patch_id")).agg(F.array_join(F.array_sort(F.collect_list(F.expr("substring(t, instr(t, '+++'))"))), "").alias("diff"))
    return queue, texts, nodes, edges


_datasets: dict[tuple[str, str], build.Dataset] = {}


def _built(spark: SparkSession, d: str) -> build.Dataset:
    """The dataset of a data directory; its relations are written tables, which the queries of a session share."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _datasets:
        _datasets[key] = build.build(*_inputs(spark, d))
    return _datasets[key]


_BUILD = """, samples AS (
  SELECT 'p' || n_nationkey AS patch_id, v.version, 'g' || (n_nationkey + v.i) AS g, n_nationkey AS k FROM nation, (VALUES ('vulnerable', 0), ('fixed', 1)) v(version, i) WHERE n_nationkey <> 5 AND n_nationkey < 24
), bhit AS (
  SELECT patch_id, version, cu.g, c, r * 100 + 2 AS line, file FROM samples JOIN cu USING (g) WHERE c % 9 = 0
), bnear AS (
  SELECT patch_id, version, caller AS c, 'caller' AS role FROM bhit JOIN calls ON calls.g = bhit.g AND callee = bhit.c UNION SELECT patch_id, version, callee, 'callee' FROM bhit JOIN calls ON calls.g = bhit.g AND caller = bhit.c
), bcand AS (
  SELECT patch_id, version, c, 'patch' AS role FROM bhit UNION ALL
  SELECT patch_id, version, c, max(role) FROM bnear WHERE (patch_id, version, c) NOT IN (SELECT (patch_id, version, c) FROM bhit) GROUP BY 1, 2, 3
), bst AS (
  SELECT b.patch_id, b.version, k, st.*, b.role FROM bcand b JOIN st USING (c) JOIN samples s ON s.patch_id = b.patch_id AND s.version = b.version
), bfl AS (
  SELECT x.patch_id, x.version, f.a, f.b, f.kind FROM (SELECT * FROM fl UNION SELECT g, 's' || od.o, 'm' || target, 'PARAM_BIND_' || rn FROM od JOIN lf ON lf.o = od.o WHERE od.kind = 1 AND od.o % 16 <> 9 AND rn <= 2) f
  JOIN bst x ON x.nid = f.a JOIN bst y ON y.nid = f.b AND y.patch_id = x.patch_id AND y.version = x.version WHERE a <> b
), bsink AS (
  SELECT patch_id, version, nid, CASE
    WHEN stmt_type = 'CALL' AND (called = 'memcpy' OR (called = 'strlen' AND k % 3 <> 0)) THEN 'cwe_api:' || called
    WHEN stmt_type = 'CALL' AND called = 'strlen' AND EXISTS (SELECT 1 FROM bhit h WHERE h.patch_id = bst.patch_id AND h.version = bst.version AND h.file = bst.file AND abs(h.line - bst.line) <= 3) THEN 'patch_proximity:strlen'
    WHEN k % 4 = 0 AND file = 'file1.c' AND line = 101 THEN 'user' END AS reason FROM bst
), bpatch AS (
  SELECT DISTINCT bst.patch_id, bst.version, nid AS id FROM bst JOIN bhit h ON h.patch_id = bst.patch_id AND h.version = bst.version AND h.c = bst.c AND h.line = bst.line
)"""
_BUILD_W = "WITH RECURSIVE " + C.CPG_SQL + _SCOPE + _FLOWS + _BUILD


def build_functions(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d).functions.select("patch_id", "version", "function_full", "role", F.array_join("modified_lines", ",").alias("modified_lines"), "file")


FUNCTIONS_SQL = _BUILD_W + """SELECT b.patch_id, b.version, 'f' || b.c AS function_full, b.role, coalesce(CAST(h.line AS VARCHAR), '') AS modified_lines, cu.file
FROM bcand b JOIN cu USING (c) LEFT JOIN bhit h ON h.patch_id = b.patch_id AND h.version = b.version AND h.c = b.c"""


def build_sinks(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d).sink_statements.select("patch_id", "version", "function", "line", "sink_reason")


SINKS_SQL = _BUILD_W + "SELECT b.patch_id, b.version, 'f' || b.c AS function, CAST(b.line AS INTEGER) AS line, reason AS sink_reason FROM bst b JOIN bsink s ON s.patch_id = b.patch_id AND s.version = b.version AND s.nid = b.nid WHERE reason IS NOT NULL"


def build_labels(spark: SparkSession, d: str) -> DataFrame:
    """Nodes, labelled nodes, patch-related and cross-function nodes of each sample."""
    return _built(spark, d).nodes.groupBy("patch_id", "version").agg(
        F.count(F.lit(1)).alias("nodes"), F.sum("label").alias("labelled"), F.count_if("is_patch_related").alias("related"), F.sum("distance_to_patch").alias("distance"), F.count_if("is_cross_function").alias("crossing")
    )


LABELS_SQL = _BUILD_W + """, anchor AS (
  SELECT patch_id, version, nid AS id FROM bsink WHERE reason IS NOT NULL UNION
  SELECT patch_id, version, id FROM bpatch WHERE (patch_id, version) NOT IN (SELECT (patch_id, version) FROM bsink WHERE reason IS NOT NULL)
), f(patch_id, version, id, depth) AS (
  SELECT patch_id, version, id, 0 FROM bpatch UNION SELECT f.patch_id, f.version, e.b, depth + 1 FROM f JOIN bfl e ON e.patch_id = f.patch_id AND e.version = f.version AND e.a = f.id WHERE depth < 10
), b(patch_id, version, id, depth) AS (
  SELECT patch_id, version, id, 0 FROM anchor UNION SELECT b.patch_id, b.version, e.a, depth + 1 FROM b JOIN bfl e ON e.patch_id = b.patch_id AND e.version = b.version AND e.b = b.id WHERE depth < 10
), common AS (
  SELECT DISTINCT patch_id, version, id FROM f INTERSECT SELECT DISTINCT patch_id, version, id FROM b
), chosen AS (
  SELECT * FROM common UNION SELECT * FROM (SELECT * FROM bpatch UNION SELECT * FROM anchor) u WHERE (patch_id, version) NOT IN (SELECT (patch_id, version) FROM common) AND (patch_id, version) IN (SELECT (patch_id, version) FROM bpatch)
), u AS (
  SELECT patch_id, version, a, b FROM bfl UNION SELECT patch_id, version, b, a FROM bfl
), w(patch_id, version, id, depth) AS (
  SELECT patch_id, version, id, 0 FROM bpatch UNION SELECT w.patch_id, w.version, u.b, depth + 1 FROM w JOIN u ON u.patch_id = w.patch_id AND u.version = w.version AND u.a = w.id WHERE depth < 40
), dist AS (
  SELECT patch_id, version, id, min(depth) AS depth FROM w GROUP BY ALL
), cross_ AS (
  SELECT patch_id, version, a AS id FROM bfl WHERE kind LIKE 'PARAM%' OR kind = 'CALL' UNION SELECT patch_id, version, b FROM bfl WHERE kind LIKE 'PARAM%' OR kind = 'CALL'
)
SELECT n.patch_id, n.version, count(*) AS nodes, CAST(count(chosen.id) AS BIGINT) AS labelled, count(dist.id) AS related, CAST(sum(dist.depth) AS BIGINT) AS distance, count(cross_.id) AS crossing
FROM bst n LEFT JOIN chosen ON chosen.patch_id = n.patch_id AND chosen.version = n.version AND chosen.id = n.nid
LEFT JOIN dist ON dist.patch_id = n.patch_id AND dist.version = n.version AND dist.id = n.nid
LEFT JOIN cross_ ON cross_.patch_id = n.patch_id AND cross_.version = n.version AND cross_.id = n.nid GROUP BY 1, 2"""


def build_edges(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d).edges.groupBy("patch_id", "version", "edge_type").agg(F.count(F.lit(1)).alias("n"))


BUILD_EDGES_SQL = _BUILD_W + "SELECT patch_id, version, kind AS edge_type, count(*) AS n FROM bfl GROUP BY 1, 2, 3"


def build_skipped(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d).skipped.select("patch_id", "version", "stage", "reason")


SKIPPED_SQL = "SELECT * FROM (VALUES ('p5', CAST(NULL AS VARCHAR), 'clone/fetch', 'no diff of this patch'), ('p24', NULL, 'step1/cpg_build', 'no exported graph of a version')) t(patch_id, version, stage, reason)"


def build_totals(spark: SparkSession, d: str) -> DataFrame:
    queue, *rest = _inputs(spark, d)
    return build.totals(build.build(queue, *rest), queue).select("processed", "skipped", "samples", "nodes")


TOTALS_SQL = _BUILD_W + "SELECT count(DISTINCT patch_id) AS processed, (SELECT count(*) FROM nation) - count(DISTINCT patch_id) AS skipped, count(DISTINCT (patch_id, version)) AS samples, count(*) AS nodes FROM bst"


def build_sink_reports(spark: SparkSession, d: str) -> DataFrame:
    show = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias(c)
    return _built(spark, d).sink_reports.select("patch_id", "version", "total", show("by_reason"), show("calls"), F.array_join("top_calls", ",").alias("top_calls"), "note")


REPORTS_SQL = _BUILD_W + """, r AS (SELECT s.*, k FROM bsink s JOIN samples USING (patch_id, version) WHERE reason IS NOT NULL), t AS (SELECT patch_id, version, count(*) AS total FROM r GROUP BY ALL),
y AS (SELECT patch_id, version, string_agg(reason || '=' || n, ',' ORDER BY reason) AS by_reason FROM (SELECT patch_id, version, reason, count(*) AS n FROM r GROUP BY ALL) GROUP BY ALL),
c AS (SELECT patch_id, version, string_agg(api || '=' || n, ',' ORDER BY api) AS calls, string_agg(api, ',' ORDER BY n DESC, api) AS top_calls FROM (SELECT patch_id, version, split_part(reason, ':', 2) AS api, count(*) AS n FROM r WHERE reason <> 'user' GROUP BY ALL) GROUP BY ALL),
present AS (SELECT DISTINCT patch_id, version, k FROM bst)
SELECT present.patch_id, present.version, coalesce(total, 0) AS total, by_reason, calls, top_calls,
CASE k % 3 WHEN 1 THEN 'no calls are listed for CWE-9999; all listed calls count' WHEN 2 THEN 'no weakness is given; all listed calls count' END AS note
FROM present LEFT JOIN t USING (patch_id, version) LEFT JOIN y USING (patch_id, version) LEFT JOIN c USING (patch_id, version) WHERE total IS NOT NULL OR k % 3 <> 0"""


def custom_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Sinks under a caller's own table of calls, where no class is given."""
    rows = C.orders(spark, d).filter("kind = 6").select("g", F.col("o").alias("nid"), "file", "line", F.lit("CALL").alias("stmt_type"), F.expr("element_at(array('memcpy', 'strlen', 'puts'), CAST(o % 3 + 1 AS INT))").alias("called_function"))
    samples = rows.select("g").distinct().withColumn("cwes", F.array().cast("array<string>"))
    own = spark.createDataFrame([("CWE-1", "puts")], "cwe string, api string")
    none = rows.select("g", "file", "line").limit(0)
    return sinks.mark_sinks(rows, samples, none, keys=["g"], dimension=own).filter("is_sink").select("g", "nid", "sink_reason")


DIMENSION_SQL = _W + "SELECT g, o AS nid, 'cwe_api:puts' AS sink_reason FROM od WHERE kind = 6 AND o % 3 = 2"

QUERIES = {
    "methods_kept": (methods, METHODS_SQL),
    "ownership": (ownership, OWNERSHIP_SQL),
    "call_resolve_status": (call_status, STATUS_SQL),
    "call_pairs": (call_pairs, PAIRS_SQL),
    "khop_two": (khop_two, KHOP_SQL),
    "candidate_functions": (candidates, CANDIDATES_SQL),
    "scoped_nodes": (scoped, SCOPED_SQL),
    "statement_nodes": (statement_nodes, STATEMENTS_SQL),
    "edge_lift_dedupe": (statement_edges, EDGES_SQL),
    "param_bindings": (bindings, BINDINGS_SQL),
    "function_sizes": (function_sizes, SIZES_SQL),
    "diff_modified_lines": (modified_lines, MODIFIED_SQL),
    "diff_pure_addition_context": (addition_context, CONTEXT_SQL),
    "diff_strict_headers": (strict_headers, STRICT_SQL),
    "sink_custom_dimension": (custom_dimension, DIMENSION_SQL),
    "build_functions": (build_functions, FUNCTIONS_SQL),
    "build_sinks": (build_sinks, SINKS_SQL),
    "build_labels": (build_labels, LABELS_SQL),
    "build_edges": (build_edges, BUILD_EDGES_SQL),
    "build_skipped": (build_skipped, SKIPPED_SQL),
    "build_totals": (build_totals, TOTALS_SQL),
    "build_sink_reports": (build_sink_reports, REPORTS_SQL),
}
