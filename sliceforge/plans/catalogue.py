"""Queries of the catalogue side: fixes of entries become a work queue. Orders stand for fixes, customers for entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceforge.operators import ingest
from sliceforge.runtime import materialize, table

_URL = (
    "CASE o_orderkey % 9 WHEN 0 THEN 'https://github.com/torvalds/linux/' || o_custkey WHEN 1 THEN 'https://example.org/a/' || o_custkey WHEN 2 THEN '' "
    "ELSE 'http://GitHub.com/Own' || (o_custkey % 7) || '/Proj' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN '.git' ELSE '/' END END"
)
_HASH = "CASE WHEN o_orderkey % 17 = 0 THEN 'h' || o_orderkey ELSE 'commit' || o_orderkey END"
_PARENTS = (
    'CASE o_orderkey % 5 WHEN 0 THEN \'[]\' WHEN 1 THEN "[\'parent" || o_orderkey || "\']" WHEN 2 THEN \'parent\' || o_orderkey || \' second99\' '
    'WHEN 3 THEN "[\'p\']" ELSE "[\'parent" || o_orderkey || "\', \'other77\']" END'
)
_LANGUAGE = "CASE o_custkey % 6 WHEN 0 THEN 'C++' WHEN 1 THEN ' c ' WHEN 2 THEN 'C Language' WHEN 3 THEN 'C' END"

#: What the operators should make of it, from the rules themselves.
_SQL = f"""
WITH fx AS (SELECT 'CVE-' || o_custkey AS cve, o_orderkey, o_custkey, {_HASH} AS hash, coalesce(lower(trim({_LANGUAGE})), '') AS language, o_orderkey % 5 AS kind,
    CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS d FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 9 <> 2),
r AS (SELECT *, CASE WHEN language NOT IN ('', 'c', 'c language') THEN 'non_c_language' WHEN o_orderkey % 9 = 1 THEN 'bad_url' WHEN o_orderkey % 9 = 0 THEN 'banned_project'
    WHEN o_custkey % 7 = 0 THEN 'no_cwe' WHEN kind IN (0, 3) THEN 'no_parent' WHEN length(hash) < 7 THEN 'bad_fix_hash' END AS reason FROM fx),
q AS (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN 'CWE-119|CWE-787' ELSE 'CWE-20' END AS cwes FROM (SELECT *, row_number() OVER (PARTITION BY cve ORDER BY d = '', d, hash) AS rn FROM r WHERE reason IS NULL) WHERE rn = 1)
"""


def _source(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    fixes = o.select(F.expr("'CVE-' || o_custkey").alias("cve_id"), F.expr(_HASH).alias("hash"), F.expr(_URL).alias("repo_url"))
    date = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    commits = o.filter("o_orderkey % 11 <> 0").select(F.expr(_HASH).alias("hash"), F.expr(_PARENTS).alias("parents"), date.alias("author_date"))
    listed = F.expr("CASE WHEN c_custkey % 2 = 0 THEN array('CWE-787', 'NVD-CWE-noinfo', 'CWE-119') ELSE array('CWE-20') END")
    cwe = c.filter("c_custkey % 7 <> 0").select(F.expr("'CVE-' || c_custkey").alias("cve_id"), F.explode(listed).alias("cwe_id"))
    repository = o.select(F.expr(_URL).alias("repo_url"), F.expr(_LANGUAGE).alias("Repo_Language")).filter("repo_url <> ''").distinct()
    return ingest.source_rows(fixes, commits, cwe, repository)


def source_rows(spark: SparkSession, d: str) -> DataFrame:
    out = _source(spark, d)
    return out.select("cve_id", "hash", "author_date", "cwe_list", "language")


SOURCE_SQL = (
    _SQL
    + f"""SELECT cve AS cve_id, hash, d AS author_date, CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'CWE-119,CWE-787,NVD-CWE-noinfo' ELSE 'CWE-20' END AS cwe_list,
{_LANGUAGE} AS language FROM fx"""
)


def reject_counts(spark: SparkSession, d: str) -> DataFrame:
    return ingest.reject_counts(_source(spark, d))


REJECT_SQL = _SQL + "SELECT reason AS reject_reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1"


def work_queue(spark: SparkSession, d: str) -> DataFrame:
    return ingest.work_queue(_source(spark, d)).withColumn("cwes", F.array_join("cwes", "|"))


QUEUE_SQL = (
    _SQL
    + """SELECT 'Proj' || o_custkey || '/' || cve AS patch_id, 'https://github.com/Own' || (o_custkey % 7) || '/Proj' || o_custkey AS repo_url,
'parent' || o_orderkey AS commit_vuln, hash AS commit_fix, cve, cwes FROM q"""
)


def queue_limited(spark: SparkSession, d: str) -> DataFrame:
    return ingest.work_queue(_source(spark, d), limit=25).select("cve", "patch_id")


LIMITED_SQL = _SQL + "SELECT cve, 'Proj' || o_custkey || '/' || cve AS patch_id FROM q ORDER BY cve LIMIT 25"


def queue_counts(spark: SparkSession, d: str) -> DataFrame:
    queue = materialize(ingest.work_queue(_source(spark, d)), "queue")
    project = ingest.project_counts(queue, 5).select(F.lit("project").alias("what"), F.col("project").alias("name"), "n")
    return project.unionByName(ingest.weakness_counts(queue).select(F.lit("cwe").alias("what"), F.col("cwe").alias("name"), "n"))


COUNTS_SQL = (
    _SQL
    + """SELECT * FROM (SELECT 'project' AS what, 'Proj' || o_custkey AS name, count(*) AS n FROM q GROUP BY 2 ORDER BY n DESC, 2 LIMIT 5)
UNION ALL SELECT 'cwe', name, count(*) FROM (SELECT unnest(string_split(cwes, '|')) AS name FROM q) GROUP BY 2"""
)

QUERIES = {
    "ingest_source_rows": (source_rows, SOURCE_SQL),
    "ingest_filter_reasons": (reject_counts, REJECT_SQL),
    "ingest_work_queue": (work_queue, QUEUE_SQL),
    "ingest_queue_limited": (queue_limited, LIMITED_SQL),
    "ingest_queue_counts": (queue_counts, COUNTS_SQL),
}
