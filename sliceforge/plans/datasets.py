"""Queries over emitted datasets: checks, resumption, slices of several samples, text functions, neighbour lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceforge.functions import text as tx
from sliceforge.operators import annotate, slicing, validate
from sliceforge.plans import analog as A
from sliceforge.runtime import table
from sliceforge.schemas import REQUIRED_FIELDS, SAMPLE


def text_functions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    url = F.expr("element_at(array('https://github.com/a/b' || o_custkey || '.git', 'git@host.org:x/y' || o_custkey, 'short/one'), CAST(o_orderkey % 3 + 1 AS INT))")
    canonical = tx.canonical_id(F.expr("'a:b/' || o_custkey"), F.lit("fixed"), F.col("o_orderkey"))
    return o.select(
        "o_orderkey",
        tx.short_name(F.expr("'pkg:mod:fn' || o_custkey")).alias("short_name"),
        canonical.alias("canonical"),
        tx.sample_of(canonical).alias("sample"),
        tx.cache_key(url, F.col("o_orderkey").cast("string")).alias("cache_key"),
        tx.repo_folder(url).alias("folder"),
        tx.path_safe(F.expr("'p/' || o_custkey || '/v'")).alias("safe"),
        tx.tail(F.expr("'message ' || o_orderkey"), 4).alias("tail"),
        tx.default_patch_id(F.lit("repo"), F.expr("'abcdef' || o_orderkey")).alias("patch"),
        tx.patch_id(F.expr("'https://github.com/o/r' || o_custkey || '/'"), F.lit("CVE-1")).alias("patch_id"),
        tx.below(F.expr("element_at(array('/w/t/src/a.c', '/w/tree/a.c'), CAST(o_orderkey % 2 + 1 AS INT))"), "/w/t").alias("below"),
    )


TEXT_SQL = """SELECT o_orderkey, 'fn' || o_custkey AS short_name, printf('a:b/%d:fixed:%05d', o_custkey, o_orderkey) AS canonical, 'a:b/' || o_custkey || ':fixed' AS sample,
left(sha1(CASE o_orderkey % 3 WHEN 0 THEN 'https://github.com/a/b' || o_custkey || '.git' WHEN 1 THEN 'git@host.org:x/y' || o_custkey ELSE 'short/one' END || '::' || o_orderkey), 16) AS cache_key,
CASE o_orderkey % 3 WHEN 0 THEN 'a__b' || o_custkey WHEN 1 THEN 'x__y' || o_custkey ELSE 'short__one' END AS folder, 'p__' || o_custkey || '__v' AS safe, right('message ' || o_orderkey, 4) AS tail,
'repo:' || left('abcdef' || o_orderkey, 8) AS patch, 'r' || o_custkey || '/CVE-1' AS patch_id, CASE WHEN o_orderkey % 2 = 0 THEN 'src/a.c' ELSE '/w/tree/a.c' END AS below FROM orders"""


def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    """Entries that a resumed run still has to do: those without a functions row, however many rows the others have."""
    queue = table(spark, d, "customer").select(F.col("c_custkey").alias("patch_id"))
    done = table(spark, d, "orders").filter("o_custkey % 3 <> 0").select(F.col("o_custkey").alias("patch_id"))
    return validate.remaining(queue, done)


RESUME_SQL = "SELECT c_custkey AS patch_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 3 <> 0)"


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Emitted nodes and edges: line items of part of the orders are nodes, each points to the next key and some to missing ones."""
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_suppkey").alias("s"))
    name = lambda o, n: F.expr(f"'p:' || ({o}) || ':fixed:' || ({n})")
    nodes = rows.filter("o % 10 <> 0").select(name("o", "n").alias("id")).distinct()
    return nodes, rows.select(name("o", "n").alias("src"), name("o + CASE WHEN s % 50 = 0 THEN 1 ELSE 0 END", "n").alias("dst"))


_RECORDS = """WITH r AS (SELECT 'p:' || l_orderkey || ':fixed:' || l_linenumber AS src, 'p:' || (l_orderkey + CASE WHEN l_suppkey % 50 = 0 THEN 1 ELSE 0 END) || ':fixed:' || l_linenumber AS dst, l_orderkey AS o FROM lineitem),
n AS (SELECT DISTINCT src AS id, o FROM r WHERE o % 10 <> 0),
e AS (SELECT count(*) AS edges, count(*) FILTER (NOT (src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n))) AS unresolved,
  count(*) FILTER (src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n) AND regexp_replace(src, ':[^:]*$', '') <> regexp_replace(dst, ':[^:]*$', '')) AS cross_sample FROM r) """


def edge_integrity(spark: SparkSession, d: str) -> DataFrame:
    nodes, edges = _records(spark, d)
    return validate.edge_integrity(edges, nodes)


INTEGRITY_SQL = _RECORDS + "SELECT * FROM e"


def samples_seen(spark: SparkSession, d: str) -> DataFrame:
    return validate.samples_of(_records(spark, d)[0])


SAMPLES_SQL = _RECORDS + "SELECT 'p:' || o AS patch_id, 'fixed' AS version, count(*) AS n_nodes FROM n GROUP BY o"


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """JSON records that lack a field each, but for some."""
    part = "{" + ", ".join(f'"{f}": 1' for f in REQUIRED_FIELDS) + "}"
    gap = F.concat(F.lit('"'), F.element_at(F.array(*[F.lit(f) for f in REQUIRED_FIELDS]), (F.col("p_partkey") % 5 + 1).cast("int")), F.lit('": 1, '))
    return table(spark, d, "part").select(F.when(F.col("p_partkey") % 5 < 3, F.replace(F.lit(part), gap, F.lit(""))).otherwise(F.lit(part)).alias("value"))


def missing_fields(spark: SparkSession, d: str) -> DataFrame:
    return validate.missing_fields(_raw(spark, d))


FIELDS_SQL = f"SELECT ['{REQUIRED_FIELDS[0]}', '{REQUIRED_FIELDS[1]}', '{REQUIRED_FIELDS[2]}'][p_partkey % 5 + 1] AS field, count(*) AS n FROM part WHERE p_partkey % 5 < 3 GROUP BY 1"


def validator_report(spark: SparkSession, d: str) -> DataFrame:
    nodes, edges = _records(spark, d)
    other = table(spark, d, "nation")
    run = spark.createDataFrame([(0, 7)], "processed long, skipped long")
    return validate.report(nodes, edges, other, other.limit(0), table(spark, d, "region"), run, _raw(spark, d), ("nodes", "edges", "functions", "sinks", "skipped"))


REPORT_SQL = _RECORDS + """SELECT 'missing_files' AS "check", 1 AS value, true AS is_red_flag UNION ALL SELECT 'nodes', count(*), count(*) = 0 FROM n UNION ALL SELECT 'edges', edges, false FROM e
UNION ALL SELECT 'functions', count(*), false FROM nation UNION ALL SELECT 'sinks', 0, false UNION ALL SELECT 'skipped', count(*), false FROM region UNION ALL SELECT 'all_skipped', 1, true
UNION ALL SELECT 'samples', count(DISTINCT o), false FROM n UNION ALL SELECT 'unresolved', unresolved, unresolved > 0 FROM e UNION ALL SELECT 'cross_sample', cross_sample, cross_sample > 0 FROM e
UNION ALL SELECT 'unresolved_ppm', CAST(round(unresolved * 1e6 / edges) AS BIGINT), false FROM e UNION ALL SELECT 'missing_fields', 3, true"""


def sink_reasons(spark: SparkSession, d: str) -> DataFrame:
    return validate.sink_reasons(table(spark, d, "part").select(F.expr("CASE WHEN p_size % 4 = 0 THEN 'user' ELSE 'cwe_api:' || p_brand END").alias("sink_reason")))


REASONS_SQL = "SELECT CASE WHEN p_size % 4 = 0 THEN 'user' ELSE 'cwe_api:' || p_brand END AS sink_reason, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5"


# --- slices of several samples ----------------------------------------------------------------------


def _groups(spark: SparkSession, d: str):
    """Users in seven samples: sample 0 has no patch, 1 no sinks, 2 a patch that reaches none of its sinks."""
    of = F.concat(F.lit("p"), F.col("function") % 7)
    nodes = A.nodes(spark, d).withColumn("patch_id", of)
    ends = nodes.select("nid", F.col("patch_id").alias("own"))
    raw = A.edges(spark, d).drop("patch_id")
    edges = raw.join(ends.withColumnRenamed("nid", "src").withColumnRenamed("own", "patch_id"), "src").join(ends.withColumnRenamed("nid", "dst"), "dst").filter("own = patch_id").drop("own")
    pick = lambda cond: nodes.filter(cond).select(*SAMPLE, F.col("nid").alias("id"))
    patch = pick("stmt_type = 'signup' AND k < 8 AND patch_id <> 'p0' AND (patch_id <> 'p2' OR line > 3)")
    marks = pick("patch_id <> 'p1' AND ((patch_id <> 'p2' AND stmt_type = 'purchase' AND k >= 97) OR (patch_id = 'p2' AND line = 1))")
    keep = edges.filter("patch_id <> 'p2' OR edge_type <> 'CALL'")
    return nodes, keep, patch, marks


_GROUPS = f"""WITH RECURSIVE {A.GRAPH_SQL.rstrip()}, gn AS (SELECT *, 'p' || (function % 7) AS p FROM n),
ge AS (SELECT a.p, e.src, e.dst FROM e JOIN gn a ON a.nid = e.src JOIN gn b ON b.nid = e.dst WHERE a.p = b.p AND (a.p <> 'p2' OR edge_type <> 'CALL')),
gp AS (SELECT p, nid AS id FROM gn WHERE stmt_type = 'signup' AND k < 8 AND p <> 'p0' AND (p <> 'p2' OR line > 3)),
gs AS (SELECT p, nid AS id FROM gn WHERE p <> 'p1' AND ((p <> 'p2' AND stmt_type = 'purchase' AND k >= 97) OR (p = 'p2' AND line = 1))),
ga AS (SELECT * FROM gs WHERE p IN (SELECT p FROM gp) UNION ALL SELECT * FROM gp WHERE p NOT IN (SELECT p FROM gs)),
gf(p, id, depth) AS (SELECT p, id, 0 FROM gp UNION SELECT f.p, e.dst, depth + 1 FROM gf f JOIN ge e ON e.src = f.id WHERE depth < 6),
gb(p, id, depth) AS (SELECT p, id, 0 FROM ga UNION SELECT b.p, e.src, depth + 1 FROM gb b JOIN ge e ON e.dst = b.id WHERE depth < 4),
gc AS (SELECT p, id FROM gf INTERSECT SELECT p, id FROM gb),
gx AS (SELECT p, id, false AS fallback FROM gc UNION ALL SELECT p, id, true FROM (SELECT * FROM gp UNION SELECT * FROM ga) WHERE p NOT IN (SELECT p FROM gc))
"""


def slice_samples(spark: SparkSession, d: str) -> DataFrame:
    """Reports of slices with unequal bounds (4 back, 6 forward), fallback and skipped samples included."""
    return slicing.compute_slice(*_groups(spark, d), max_backward=4, max_forward=6)[1].drop("version")


SAMPLES_SLICE_SQL = _GROUPS + """SELECT p AS patch_id, (SELECT count(*) FROM gp WHERE gp.p = g.p) AS n_patch, (SELECT count(*) FROM gs WHERE gs.p = g.p) AS n_sinks,
(SELECT count(DISTINCT id) FROM gf WHERE gf.p = g.p) AS n_forward, (SELECT count(DISTINCT id) FROM gb WHERE gb.p = g.p) AS n_backward, (SELECT count(*) FROM gx WHERE gx.p = g.p) AS n_slice,
p NOT IN (SELECT p FROM gs) AND p IN (SELECT p FROM gp) AS patch_as_sink,
CASE WHEN p NOT IN (SELECT p FROM gp) THEN 'no patch nodes on this version' WHEN p IN (SELECT p FROM gx WHERE fallback) THEN 'empty intersection; used anchor-union fallback' END AS skipped
FROM (SELECT DISTINCT p FROM gn) g"""


def slice_roles(spark: SparkSession, d: str) -> DataFrame:
    """Members of each sample's slice by the role of their function; functions without one are unknown."""
    nodes, edges, patch, marks = _groups(spark, d)
    chosen, _ = slicing.compute_slice(nodes, edges, patch, marks, max_backward=4, max_forward=6)
    functions = nodes.filter("function % 4 < 3").select(*SAMPLE, F.col("function").alias("function_full"), F.expr("element_at(array('patch', 'caller', 'callee'), CAST(function % 4 + 1 AS INT))").alias("role")).distinct()
    return slicing.slice_by_role(nodes, chosen, functions).drop("version")


ROLES_SQL = _GROUPS + """SELECT gx.p AS patch_id, CASE function % 4 WHEN 0 THEN 'patch' WHEN 1 THEN 'caller' WHEN 2 THEN 'callee' ELSE 'unknown' END AS role, count(*) AS n FROM gx JOIN gn ON gn.nid = gx.id GROUP BY 1, 2"""


def neighbor_lists(spark: SparkSession, d: str) -> DataFrame:
    """All lists of a node, joined; calls into every fifth user stand for argument bindings as well."""
    ids = A.nodes(spark, d).select(*A.KEYS, "nid", F.col("nid").cast("string").alias("canonical"))
    edges = A.edges(spark, d)
    bound = edges.filter("edge_type = 'CALL' AND dst % 5 = 0").withColumn("edge_type", F.lit("PARAM_BIND"))
    out = annotate.neighbour_lists(edges.unionByName(bound), ids, A.KEYS)
    return out.select("nid", *[F.array_join(c, ",").alias(c) for c in annotate.LISTS.values()])


def _list(kind: str, way: str, name: str) -> str:
    return f"coalesce(string_agg(o, ',' ORDER BY o) FILTER (k = '{kind}' AND way = '{way}'), '') AS {name}"


LISTS_SQL = (
    f"WITH {A.GRAPH_SQL.rstrip()}, x AS (SELECT src, dst, edge_type AS k FROM e UNION ALL SELECT src, dst, 'PARAM_BIND' FROM e WHERE edge_type = 'CALL' AND dst % 5 = 0), "
    "y AS (SELECT DISTINCT src AS nid, CAST(dst AS VARCHAR) AS o, k, 'out' AS way FROM x UNION SELECT DISTINCT dst, CAST(src AS VARCHAR), k, 'in' FROM x) "
    "SELECT nid, " + ", ".join(_list(k, w, n) for (k, w), n in annotate.LISTS.items()) + " FROM y GROUP BY 1"
)

QUERIES = {
    "text_functions": (text_functions, TEXT_SQL),
    "resume_anti": (resume_anti, RESUME_SQL),
    "edge_integrity": (edge_integrity, INTEGRITY_SQL),
    "samples_seen": (samples_seen, SAMPLES_SQL),
    "missing_fields": (missing_fields, FIELDS_SQL),
    "validator_report": (validator_report, REPORT_SQL),
    "sink_reasons": (sink_reasons, REASONS_SQL),
    "slice_samples": (slice_samples, SAMPLES_SLICE_SQL),
    "slice_roles": (slice_roles, ROLES_SQL),
    "neighbor_lists": (neighbor_lists, LISTS_SQL),
}
