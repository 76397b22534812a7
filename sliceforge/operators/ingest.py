"""Source catalogue to work queue: joins, ordered rejection reasons, first fix of each entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sliceforge.functions import text as tx
from sliceforge.schemas import BANNED, C_LANGUAGES, LANGUAGE_COLUMNS

REQUIRED = ("cve", "fixes", "commits", "cwe_classification")


def missing_tables(have, names=REQUIRED) -> list[str]:
    """Required tables that a catalogue lacks; `have` lists its tables."""
    present = {n.lower() for n in have}
    return [n for n in names if n not in present]


def banned_projects(more=()) -> tuple[str, ...]:
    """The fixed list and the user's own, each once."""
    return tuple(dict.fromkeys([*BANNED, *(m.strip().lower() for m in more if m.strip())]))


def language_column(repository: DataFrame | None) -> str | None:
    """The first known spelling of the language column."""
    if repository is None:
        return None
    have = {c.lower(): c for c in repository.columns}
    return next((have[c] for c in LANGUAGE_COLUMNS if c in have), None)


def concat_ordered(values: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Comma list of the values of each key, in order (duplicates kept)."""
    return values.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(value)), ",").alias(alias))


def source_rows(fixes: DataFrame, commits: DataFrame, cwe: DataFrame, repository: DataFrame | None = None) -> DataFrame:
    """One row for each fix whose commit is known, with its weakness list and language."""
    lists = concat_ordered(cwe, "cve_id", "cwe_id", "cwe_list")
    rows = (
        fixes.filter("repo_url IS NOT NULL AND repo_url <> '' AND hash IS NOT NULL AND hash <> ''")
        .join(commits.select("hash", "parents", "author_date"), "hash")
        .join(lists, "cve_id", "left")
    )
    column = language_column(repository)
    if column is None:
        return rows.withColumn("language", F.lit(None).cast("string"))
    langs = repository.select("repo_url", F.col(column).alias("language"))
    return rows.join(langs, "repo_url", "left")


def reject_reason(c_only: bool = True, banned=BANNED) -> Column:
    """The first test that a row fails, null if it passes all. Needs language, repo_norm, cwes, parents and hash."""
    lang = F.coalesce(F.lower(tx.strip(F.col("language"))), F.lit(""))
    out = F.when(~lang.isin("", *C_LANGUAGES), "non_c_language") if c_only else F.when(F.lit(False), "")
    return (
        out.when(F.col("repo_norm").isNull(), "bad_url")
        .when(tx.is_banned(F.col("repo_norm"), banned), "banned_project")
        .when(F.size("cwes") == 0, "no_cwe")
        .when((F.size("parent_list") == 0) | (F.length(F.get("parent_list", F.lit(0))) < 7), "no_parent")
        .when(F.length("hash") < 7, "bad_fix_hash")
    )


def tagged(rows: DataFrame, c_only: bool = True, banned=BANNED) -> DataFrame:
    worked = F.struct(tx.normalize_repo_url(F.col("repo_url")).alias("repo_norm"), tx.cwe_items(F.col("cwe_list")).alias("cwes"), tx.parse_parents(F.col("parents")).alias("parent_list"))
    # one row in, one row out: the patterns run once a row instead of once for each test that a filter copies them into
    once = rows.withColumn("worked", F.explode(F.array(worked)))
    return once.select(*rows.columns, "worked.*").withColumn("reject_reason", reject_reason(c_only, banned))


def earliest(rows: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    """The earliest row of each key; empty dates come last. A minimum per key, so no group is sorted."""
    order = F.struct((F.coalesce(F.col(date), F.lit("")) == "").alias("undated"), F.coalesce(F.col(date), F.lit("")).alias("at"), F.col(tie).alias("tie"))
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("row"))
    return best.select(key, *[F.col(f"row.`{c}`").alias(c) for c in rest])


def work_queue(rows: DataFrame, c_only: bool = True, banned=BANNED, limit: int | None = None) -> DataFrame:
    """Accepted entries, one for each cve id."""
    kept = earliest(tagged(rows, c_only, banned).filter("reject_reason IS NULL"), "cve_id", "author_date", "hash")
    queue = kept.select(
        tx.patch_id(F.col("repo_norm"), F.col("cve_id")).alias("patch_id"),
        F.col("repo_norm").alias("repo_url"),
        F.col("parent_list")[0].alias("commit_vuln"),
        F.col("hash").alias("commit_fix"),
        F.col("cve_id").alias("cve"),
        "cwes",
    )
    # a limit that cuts nothing orders nothing
    return queue if limit is None or queue.limit(limit + 1).count() <= limit else queue.orderBy("cve", "patch_id").limit(limit)


def weakness_counts(queue: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent weakness ids of a queue: (cwe, n)."""
    return top(queue.select(F.explode("cwes").alias("cwe")), "cwe", k)


def project_counts(queue: DataFrame, k: int = 10) -> DataFrame:
    """The projects with the most entries: (project, n)."""
    return top(queue.select(F.substring_index("repo_url", "/", -1).alias("project")), "project", k)


def reject_counts(rows: DataFrame, c_only: bool = True, banned=BANNED) -> DataFrame:
    return tagged(rows, c_only, banned).filter("reject_reason IS NOT NULL").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def top(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(k)


def first_rows(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """row_number() = 1 of each key, where the order is richer than a date."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("rn = 1").drop("rn")
