"""Registered queries and the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceforge.functions import text as tx
from sliceforge.operators import annotate, graph, ingest, joins, program, sinks, slicing, validate
from sliceforge.plans import analog as A
from sliceforge.plans import catalogue, cpg, datasets
from sliceforge.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _graph(sql: str) -> str:
    return f"WITH {A.GRAPH_SQL} {sql}"


def _search(sql: str) -> str:
    return f"WITH RECURSIVE {A.GRAPH_SQL}, {A.SEARCH_SQL} {sql}"


# --- ingest ---------------------------------------------------------------------------------------

_ORDERS = """
WITH r AS (
  SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS VARCHAR) AS d, c.c_acctbal, c.c_mktsegment, n.n_name
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_nationkey < 20
)"""
_REASON = "CASE WHEN n_name IS NULL THEN 'no_nation' WHEN c_acctbal < 0 THEN 'negative' WHEN c_mktsegment = 'BUILDING' THEN 'segment' END"


def _orders(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").filter("n_nationkey < 20")
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("d"), "c_acctbal", "c_mktsegment", "n_name")


@query(
    f"{_ORDERS} SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS rn FROM r WHERE {_REASON} IS NULL) WHERE rn = 1"
)
def ingest_dedupe_first(spark, d):
    kept = _orders(spark, d).withColumn("reject_reason", F.expr(_REASON)).filter("reject_reason IS NULL")
    return ingest.earliest(kept.select("o_custkey", "o_orderkey", "d"), "o_custkey", "d", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1")
def ingest_group_concat(spark, d):
    return ingest.concat_ordered(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", "flags")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def ingest_top_projects(spark, d):
    return ingest.top(table(spark, d, "customer"), "c_mktsegment")


_HOSTED = "'http://' || CASE WHEN page_id % 4 = 0 THEN 'GitHub.com/' WHEN page_id % 4 = 1 THEN 'gitlab.com/' WHEN page_id % 4 = 2 THEN 'Bitbucket.org/' ELSE 'other.org/' END || 'Own' || (page_id % 7) || '/Proj' || page_id || CASE WHEN page_id % 3 = 0 THEN '.git' WHEN page_id % 3 = 1 THEN '/' ELSE '' END"


@query(
    f"SELECT page_id, CASE WHEN page_id % 4 = 3 THEN NULL ELSE 'https://' || lower(regexp_extract(u, '^http://([^/]*/)', 1)) || regexp_extract(u, '^http://[^/]*/([^/]*/[^/]*?)(\\.git|/)?$', 1) END AS url_norm FROM (SELECT page_id, {_HOSTED} AS u FROM pages)"
)
def url_normalize(spark, d):
    return table(spark, d, "pages").select("page_id", tx.normalize_repo_url(F.expr(_HOSTED)).alias("url_norm"))


_LISTED = "CASE WHEN o_orderkey % 3 = 0 THEN '[''' || o_orderkey || ''', ''' || o_custkey || ''']' WHEN o_orderkey % 3 = 1 THEN o_orderkey || ' ' || o_custkey ELSE '[]' END"


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE o_orderkey || '|' || o_custkey END AS parents FROM orders")
def parents_parse(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.array_join(tx.parse_parents(F.expr(_LISTED)), "|").alias("parents"))


@query("SELECT p_partkey, 'CWE-' || p_size AS cwe FROM part")
def cwe_normalize(spark, d):
    raw = F.expr("CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN concat('cwe', p_size) WHEN 2 THEN concat(' CWE- ', p_size) ELSE concat('Cwe-', p_size) END")
    return table(spark, d, "part").select("p_partkey", tx.normalize_cwe(raw).alias("cwe"))


# --- joins ----------------------------------------------------------------------------------------

_NEAREST = f"""WITH {A.SPANS_SQL}, m AS (
  SELECT ln.file, line, name, start, CASE WHEN line BETWEEN start AND stop THEN 0 ELSE 1 END AS kind,
         CASE WHEN line BETWEEN start AND stop THEN stop - start ELSE least(abs(line - start), abs(line - stop)) END AS cost
  FROM ln JOIN sx ON sx.file = ln.file AND line BETWEEN start - 3 AND stop + 3
), w AS (SELECT *, row_number() OVER (PARTITION BY file, line ORDER BY kind, cost, start, name) AS rn FROM m)
SELECT file, line, name, CAST(cost AS INTEGER) AS cost FROM w WHERE rn = 1 AND kind = """


def _placed(spark, d, kind):
    return joins.containing_or_nearest(A.lines(spark, d), A.spans(spark, d), ["file"]).filter(F.col("kind") == kind).drop("kind")


@query(_NEAREST + "0")
def range_join_narrowest(spark, d):
    return _placed(spark, d, 0)


@query(_NEAREST + "1")
def nearest_join_orphan(spark, d):
    return _placed(spark, d, 1)


@query(f"WITH {A.SPANS_SQL} SELECT DISTINCT ln.file, ln.line FROM ln WHERE line <> 0 AND EXISTS (SELECT 1 FROM sx WHERE sx.file = ln.file AND abs(ln.line - sx.start) <= 3)")
def band_join(spark, d):
    marks = A.spans(spark, d).select("file", F.col("start").alias("line"))
    return joins.near_lines(A.lines(spark, d).distinct(), marks, ["file"], 3)


# --- graphs ---------------------------------------------------------------------------------------


@query(
    _graph(
        """, c AS (SELECT DISTINCT a.function AS caller, b.function AS callee FROM e JOIN n a ON a.nid = e.src JOIN n b ON b.nid = e.dst WHERE edge_type = 'CALL'),
p AS (SELECT DISTINCT function AS id FROM n JOIN patch ON patch.id = n.nid),
h AS (SELECT c.caller AS id, 'caller' AS role FROM c JOIN p ON p.id = c.callee UNION SELECT c.callee, 'callee' FROM c JOIN p ON p.id = c.caller)
SELECT id, max(role) AS role FROM h WHERE id NOT IN (SELECT id FROM p) GROUP BY id"""
    ).replace("n WHERE stmt_type = 'purchase' AND k >= 97)\n ,", "n WHERE stmt_type = 'purchase' AND k >= 97),")
)
def khop_expand_roles(spark, d):
    n = A.nodes(spark, d).select(*A.KEYS, "nid", "function")
    calls = A.edges(spark, d).filter("edge_type = 'CALL'")
    named = calls.join(n.select("nid", F.col("function").alias("caller")), calls.src == F.col("nid")).drop("nid").join(n.select("nid", F.col("function").alias("callee")), calls.dst == F.col("nid"))
    hit = n.join(A.patch(spark, d).withColumnRenamed("id", "nid"), [*A.KEYS, "nid"], "left_semi").select(*A.KEYS, F.col("function").alias("id")).distinct()
    return graph.khop_roles(named.select(*A.KEYS, "caller", "callee").distinct(), hit, A.KEYS, 1).select("id", "role")


@query(
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'ASSIGN' WHEN 1 THEN 'CALL' WHEN 2 THEN 'DO_WHILE' WHEN 3 THEN 'CONTROL' ELSE 'DECL' END AS stmt_type FROM part"""
)
def stmt_classify(spark, d):
    label = F.expr("CASE p_partkey % 5 WHEN 0 THEN 'CALL' WHEN 1 THEN 'CALL' WHEN 2 THEN 'CONTROL_STRUCTURE' WHEN 3 THEN 'CONTROL_STRUCTURE' ELSE 'LOCAL' END")
    name = F.expr("CASE p_partkey % 5 WHEN 0 THEN '<operator>.assignmentPlus' ELSE p_name END")
    return table(spark, d, "part").select("p_partkey", program.statement_type(label, name, F.expr("CASE p_partkey % 5 WHEN 2 THEN 'DO' ELSE 'UNSEEN' END")).alias("stmt_type"))


@query(f"WITH RECURSIVE {A.GRAPH_SQL}, {A.SEARCH_SQL} SELECT depth, count(*) AS n FROM fd GROUP BY 1")
def bfs_depth(spark, d):
    return graph.bfs(A.edges(spark, d), A.patch(spark, d), A.KEYS, 10).groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


def _slice(spark, d):
    return slicing.compute_slice(A.nodes(spark, d), A.edges(spark, d), A.patch(spark, d), A.sinks(spark, d), A.KEYS)


@query(_search("SELECT id, depth FROM bd"))
def slice_backward(spark, d):
    return graph.bfs(graph.reversed_edges(A.edges(spark, d), A.KEYS), A.sinks(spark, d), A.KEYS, 10).select("id", "depth")


@query(_search("SELECT CAST(label AS INTEGER) AS label, count(*) AS n FROM (SELECT CASE WHEN nid IN (SELECT id FROM s) THEN 1 ELSE 0 END AS label FROM n) GROUP BY 1"))
def slice_label(spark, d):
    chosen, _ = _slice(spark, d)
    marked = A.nodes(spark, d).join(chosen.select(*A.KEYS, F.col("id").alias("nid"), F.lit(1).alias("hit")), [*A.KEYS, "nid"], "left")
    return marked.groupBy(F.coalesce("hit", F.lit(0)).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    _search("SELECT (SELECT count(*) FROM patch) AS n_patch, (SELECT count(*) FROM sink) AS n_sinks, (SELECT count(*) FROM fd) AS n_forward, (SELECT count(*) FROM bd) AS n_backward, (SELECT count(*) FROM s) AS n_slice")
)
def slice_report(spark, d):
    return _slice(spark, d)[1].select("n_patch", "n_sinks", "n_forward", "n_backward", "n_slice")


@query(_graph("SELECT id FROM patch"))
def patch_nodes(spark, d):
    n = A.nodes(spark, d)
    fns = n.filter("stmt_type = 'signup' AND k < 2").groupBy(*A.KEYS, F.col("function").alias("function_full")).agg(F.collect_set("line").alias("modified_lines")).withColumn("role", F.lit("patch"))
    return slicing.patch_nodes(n, fns, A.KEYS).select("id")


@query(
    f"""WITH RECURSIVE {A.GRAPH_SQL}, u AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
w(id, depth) AS (SELECT id, 0 FROM patch UNION SELECT u.dst, w.depth + 1 FROM w JOIN u ON u.src = w.id WHERE w.depth < 30)
SELECT depth, count(*) AS n FROM (SELECT id, min(depth) AS depth FROM w GROUP BY id) GROUP BY 1"""
)
def patch_distance(spark, d):
    return slicing.patch_distance(A.edges(spark, d), A.patch(spark, d), A.KEYS).groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


_RULES = "CASE WHEN stmt_type = 'click' AND k >= 90 THEN 'cwe_api:click' WHEN stmt_type = 'click' AND near THEN 'patch_proximity:click' WHEN line = 2 THEN 'user' END"
_RULES_SQL = f""", x AS (SELECT n.*, EXISTS (SELECT 1 FROM n m JOIN patch ON patch.id = m.nid WHERE m.function = n.function AND abs(m.line - n.line) <= 3) AS near FROM n),
y AS (SELECT nid, {_RULES} AS sink_reason FROM x)"""


def _marked(spark, d):
    n = A.nodes(spark, d).select(*A.KEYS, "nid", "line", "k", F.col("function").alias("file"), F.when(F.col("stmt_type") == "click", "CALL").otherwise("OTHER").alias("stmt_type"))
    n = n.withColumn("called_function", F.when(F.col("stmt_type") == "CALL", F.when(F.col("k") >= 90, "memcpy").otherwise("strlen")))
    samples = spark.createDataFrame([("p", "v", ["cwe 120"])], "patch_id string, version string, cwes array<string>")
    lines = A.nodes(spark, d).join(A.patch(spark, d).withColumnRenamed("id", "nid"), [*A.KEYS, "nid"], "left_semi").select(*A.KEYS, F.col("function").alias("file"), "line")
    return sinks.mark_sinks(n, samples, lines, n.filter("line = 2").select(*A.KEYS, "file", "line").distinct(), 3, A.KEYS)


@query(f"WITH {A.GRAPH_SQL.rstrip()}{_RULES_SQL} SELECT nid, replace(replace(sink_reason, 'cwe_api:click', 'cwe_api:memcpy'), 'patch_proximity:click', 'patch_proximity:strlen') AS sink_reason FROM y WHERE sink_reason IS NOT NULL")
def sink_rules(spark, d):
    return _marked(spark, d).filter("is_sink").select("nid", "sink_reason")


@query(
    f"""WITH {A.GRAPH_SQL.rstrip()}{_RULES_SQL} SELECT count(*) AS total, count(*) FILTER (sink_reason LIKE 'cwe_api%') AS cwe_api, count(*) FILTER (sink_reason LIKE 'patch_prox%') AS patch_proximity,
count(*) FILTER (sink_reason = 'user') AS user_marked, 'memcpy,strlen' AS apis_hit FROM y WHERE sink_reason IS NOT NULL"""
)
def sink_report(spark, d):
    return sinks.sink_report(_marked(spark, d), A.KEYS).select("total", "cwe_api", "patch_proximity", "user_marked", "apis_hit")


@query(_graph("""SELECT nid, printf('p:v:%05d', row_number() OVER (ORDER BY function, line, CAST(nid AS VARCHAR)) - 1) AS canonical FROM n"""))
def canonical_ids(spark, d):
    return annotate.canonical_ids(A.nodes(spark, d), A.KEYS).select("nid", "canonical")


@query(_graph("SELECT DISTINCT nid FROM (SELECT src AS nid FROM e WHERE edge_type = 'CALL' UNION SELECT dst FROM e WHERE edge_type = 'CALL')"))
def cross_function(spark, d):
    return annotate.cross_function(A.edges(spark, d), A.KEYS).select("nid")


# --- datasets -------------------------------------------------------------------------------------


@query("SELECT toxic AS label, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM labels) AS percent FROM labels GROUP BY 1")
def label_distribution(spark, d):
    return validate.label_distribution(table(spark, d, "labels").withColumnRenamed("toxic", "label"))


@query("SELECT event_type AS type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def type_distribution(spark, d):
    return validate.type_distribution(table(spark, d, "events").withColumnRenamed("event_type", "type"))


@query("SELECT event_type AS stage, count(*) AS n, min(user_id) AS patch_id FROM events GROUP BY 1")
def skip_summary(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("stage"), F.col("user_id").alias("patch_id"), F.lit("").alias("version"), F.lit("r").alias("reason"))
    return validate.skip_summary(rows).drop("reason")


@query(
    """SELECT count(DISTINCT o_custkey) AS processed, count(*) AS samples, CAST(sum(n) AS BIGINT) AS nodes, CAST(sum(p) AS BIGINT) AS positives,
(SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS skipped
FROM (SELECT o_custkey, o_orderstatus, count(*) AS n, sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS p FROM orders GROUP BY 1, 2)"""
)
def run_totals(spark, d):
    n = table(spark, d, "orders").select(F.col("o_custkey").alias("patch_id"), F.col("o_orderstatus").alias("version"), F.expr("CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END").alias("label"))
    queue = table(spark, d, "customer").select(F.col("c_custkey").alias("patch_id"))
    return validate.run_totals(n, queue, queue)


for _name, (_run, _sql) in (catalogue.QUERIES | cpg.QUERIES | datasets.QUERIES).items():
    QUERIES[_name] = _run
    ORACLES[_name] = _sql
