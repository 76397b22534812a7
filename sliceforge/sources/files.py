"""Queue files, exported graphs, source lines and emitted datasets."""

from __future__ import annotations

import re
import sqlite3

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceforge.functions.text import LINE_BREAK, camel, path_safe
from sliceforge.runtime import drop_path, matching, path_exists, shared_path
from sliceforge.schemas import CPG_NODE_COLUMNS, QUEUE_DDL

_KEYS = ("patch_id", "commit_vuln", "commit_fix")


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a work queue; blank, commented and malformed lines and those without a patch or its commits are left out."""
    rows = spark.read.text(path).select(F.trim("value").alias("raw")).filter("raw <> '' AND NOT startswith(raw, '#')")
    parsed = rows.select(F.from_json("raw", QUEUE_DDL, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    none = F.array().cast("array<string>")
    return parsed.filter(" AND ".join(f"{k} IS NOT NULL" for k in _KEYS)).fillna("", ["repo_url", "cve"]).withColumn("cwes", F.coalesce("cwes", none)).withColumn("extra_sinks", extra_sinks(F.col("extra_sinks")))


def extra_sinks(raw: Column) -> Column:
    """User sinks given as {file, line} objects or [file, line, ...] lists; others are dropped."""
    items = F.from_json(raw, "array<string>")

    def one(x: Column) -> Column:
        named = F.from_json(x, "file string, line int")
        listed = F.from_json(x, "array<string>")
        return F.when(x.startswith("{"), named).when(x.startswith("["), F.struct(F.get(listed, F.lit(0)).alias("file"), F.get(listed, F.lit(1)).try_cast("int").alias("line")))

    found = F.filter(F.transform(items, one), lambda s: s["file"].isNotNull() & s["line"].isNotNull())
    return F.coalesce(found, F.array().cast("array<struct<file:string,line:int>>"))


def read_sqlite(spark: SparkSession, path: str, name: str, rows: int = 100_000) -> DataFrame:
    """One table of a local SQLite catalogue, read-only, landed in the shared folder `rows` rows at a time.

    The driver holds one portion; all columns come as text, nulls as null. An empty table has its columns.
    """
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        cursor = con.execute(f'SELECT * FROM "{name}"')
        names = [c[0] for c in cursor.description]
        ddl = ", ".join(f"`{n}` string" for n in names)
        out = shared_path(spark, f"sqlite-{name}")
        spark.createDataFrame([], ddl).write.mode("append").parquet(out)
        while part := cursor.fetchmany(rows):
            text = [tuple(None if v is None else v if isinstance(v, str) else str(v) for v in r) for r in part]
            spark.createDataFrame(text, ddl).write.mode("append").parquet(out)
    return spark.read.schema(ddl).parquet(out)


def sqlite_tables(path: str) -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        return [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table'")]


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tolerant JSON lines; a missing path is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def diff_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole diff files: patch_id (file name without extension), diff."""
    name = F.regexp_extract(F.input_file_name(), "([^/]+?)(\\.[a-z]+)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias("patch_id"), F.col("value").alias("diff"))


def source_lines(files: DataFrame, name: str = "file", text: str = "text", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, file, line from 1, text) of source texts."""
    parts = F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), LINE_BREAK)).alias("at", "text")
    return files.select(*keys, F.col(name).alias("file"), parts).select(*keys, "file", (F.col("at") + 1).alias("line"), "text")


def parse_header(raw: str) -> list[tuple[str, str]]:
    """Columns of an exported header: (name, suffix); special columns come as :ID, :LABEL, :START_ID, :END_ID, :TYPE."""
    out = []
    for cell in raw.rstrip("\r\n").split(","):
        name, _, suffix = cell.strip().strip('"').rpartition(":")
        out.append((f":{suffix}", "string") if suffix in ("ID", "LABEL", "START_ID", "END_ID", "TYPE") else (name or suffix, suffix if name else "string"))
    return out


def coerce(c: Column, suffix: str) -> Column:
    """A typed cell: empty and unreadable cells are null."""
    filled = F.nullif(c, F.lit(""))
    if suffix in ("int", "long"):
        return filled.try_cast("bigint")
    if suffix == "boolean":
        return F.when(filled.isNotNull(), F.lower(filled).isin("true", "1", "yes"))
    if suffix == "string[]":
        items = F.filter(F.split(filled, ";"), lambda x: x != "")
        return F.when(F.size(items) > 0, items)
    return filled


def _graph_of() -> Column:
    """The folder that holds the file being read."""
    return F.element_at(F.split(F.input_file_name(), "/"), -2)


def _part(spark: SparkSession, columns: list[tuple[str, str]], data: list[str], order: int, graph: Column) -> tuple[DataFrame | None, DataFrame | None]:
    """(nodes, edges) of data files with one header; one of them is None, both where there are no id columns."""
    at = {name: i for i, (name, _) in enumerate(columns)}
    ddl = ", ".join([*(f"`c{i}` string" for i in range(len(columns))), "short string"])
    if ":ID" not in at and not (":START_ID" in at and ":END_ID" in at):
        return None, None
    rows = spark.read.schema(ddl).csv(data, multiLine=True, escape='"', quote='"', mode="PERMISSIVE", columnNameOfCorruptRecord="short")
    rows = rows.withColumn("graph_id", graph).withColumn("at", F.monotonically_increasing_id())
    if ":ID" in at:
        props = {camel(name): coerce(F.col(f"c{i}"), suffix) for i, (name, suffix) in enumerate(columns) if not name.startswith(":")}
        # a blank label of a whole row stays blank; in a short row, or without the column, it is unknown
        blank = F.when(F.col("short").isNull(), "").otherwise("UNKNOWN")
        label = F.coalesce(F.col(f"c{at[':LABEL']}"), blank) if ":LABEL" in at else F.lit("UNKNOWN")
        return rows.select("graph_id", F.col(f"c{at[':ID']}").alias("id"), F.struct(F.lit(order).alias("part"), "at").alias("place"), label.alias("_label"), *[c.alias(n) for n, c in props.items()]).filter("id <> ''"), None
    kind = F.col(f"c{at[':TYPE']}") if ":TYPE" in at else F.lit("UNKNOWN")
    return None, rows.select("graph_id", F.col(f"c{at[':START_ID']}").alias("src"), F.col(f"c{at[':END_ID']}").alias("dst"), kind.alias("etype"), F.col("at").alias("child_pos")).filter("src <> '' AND dst <> ''")


def _united(parts: list[tuple[DataFrame | None, DataFrame | None]], spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    nodes: DataFrame | None = None
    edges: DataFrame | None = None
    for n, e in parts:
        if n is not None:
            nodes = n if nodes is None else nodes.unionByName(n, allowMissingColumns=True)
        if e is not None:
            edges = e if edges is None else edges.unionByName(e)
    if nodes is None:
        raise ValueError("no node file with an id column")
    for name, kind in CPG_NODE_COLUMNS.items():
        if name not in nodes.columns:
            nodes = nodes.withColumn(name, F.lit(None).cast(kind))
    # a node that is listed again is one node: what a later row fills wins
    given = [c for c in nodes.columns if c not in ("graph_id", "id", "place")]
    nodes = nodes.groupBy("graph_id", "id").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("place"))).alias(c) for c in given])
    empty = "graph_id string, src string, dst string, etype string, child_pos bigint"
    edges = spark.createDataFrame([], empty) if edges is None else edges.groupBy("graph_id", "src", "dst", "etype").agg(F.min("child_pos").alias("child_pos"))
    return nodes, edges


def load_cpg(spark: SparkSession, pairs: list[tuple[str, str]], graph_id: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of one exported graph from (header, data) files; files without id columns are skipped.

    Node properties are renamed to camelCase and united over labels; a blank id drops the row, a row without a
    label cell is UNKNOWN. Of repeated ids the later rows win, property by property. Edges are distinct, with
    child_pos as the row order within a file.
    """
    parts = []
    for order, (header, data) in enumerate(pairs):
        first = spark.read.text(header).first()
        if first:
            parts.append(_part(spark, parse_header(first.value), [data], order, F.lit(graph_id)))
    return _united(parts, spark)


def load_cpgs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of all graphs under root/<graph_id>/, as load_cpg gives them for one.

    Headers are read by one job; data files are read by a scan for each different header of a file name, however
    many graphs there are. The driver holds the header lines. Data files without a header are left out.
    """
    heads = spark.read.text(f"{root}/*/*_header.csv").select(_graph_of().alias("g"), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("f"), "value")
    kinds = heads.groupBy("f", "value").agg(F.collect_set("g").alias("graphs")).collect()  # a row for each different header
    variants: dict[str, int] = {}
    for r in kinds:
        variants[r.f] = variants.get(r.f, 0) + 1
    parts = []
    for order, r in enumerate(sorted(kinds, key=lambda r: (r.f, r.value))):
        name = r.f.replace("_header.csv", "_data.csv")
        found = [f"{root}/{g}/{name}" for g in r.graphs] if variants[r.f] > 1 else [f"{root}/*/{name}"]
        found = [f for f in found if path_exists(spark, f)]
        if found:
            parts.append(_part(spark, parse_header(r.value), found, order, _graph_of()))
    return _united(parts, spark)


def complete_graphs(spark: SparkSession, root: str, marker: str = ".complete") -> DataFrame:
    """(graph_id): graph folders that their export marked as finished; others are as good as absent."""
    return spark.createDataFrame([(m.split("/")[-2],) for m in matching(spark, f"{root}/*/{marker}")], "graph_id string")


def drop_graph(spark: SparkSession, root: str, graph_id: str) -> None:
    """Removes one exported graph, so that it is built again."""
    drop_path(spark, f"{root}/{graph_id}")


def cpg_files(names: list[str]) -> list[tuple[str, str]]:
    """Pairs of header and data files by name; data without a header is left out."""
    have = set(names)
    return [(h, n) for n in sorted(names) if re.search(r"(nodes|edges)_.*_data\.csv$", n) and (h := n.replace("_data.csv", "_header.csv")) in have]


def write_dataset(out: str, nodes: DataFrame, edges: DataFrame, functions: DataFrame, skipped: DataFrame | None = None, debug: bool = False) -> None:
    """Appends one batch: JSON lines in a folder for each relation; with debug also the nodes of each sample in a folder of its own.

    edges are those of emitted_edges(). Nodes go last but for functions, which mark a patch as done: a run that
    stops before them is taken up again from the patch.
    """
    edges.write.mode("append").option("ignoreNullFields", False).json(f"{out}/edges")
    emitted_sinks(nodes).write.mode("append").option("ignoreNullFields", False).json(f"{out}/sinks")
    nodes.write.mode("append").option("ignoreNullFields", False).json(f"{out}/nodes")
    if skipped is not None:
        skipped.write.mode("append").option("ignoreNullFields", False).json(f"{out}/skipped")
    if debug:
        sample_nodes(nodes).write.mode("append").option("ignoreNullFields", False).partitionBy("sample").json(f"{out}/samples")
        sample_counts(nodes).write.mode("append").option("ignoreNullFields", False).json(f"{out}/sample_counts")
    functions.write.mode("append").option("ignoreNullFields", False).json(f"{out}/functions")


def skip_rows(rows: DataFrame) -> DataFrame:
    """(patch_id, version, stage, reason) -> audit rows with traceback_tail and ts (seconds)."""
    return rows.select("patch_id", "version", "stage", F.right("reason", F.lit(300)).alias("reason"), F.lit("").alias("traceback_tail"), (F.unix_micros(F.current_timestamp()) / 1e6).alias("ts"))


def emitted_sinks(nodes: DataFrame) -> DataFrame:
    return nodes.filter("is_sink").select("patch_id", "version", F.col("id").alias("node_id"), "function", "line", "called_function", "sink_reason", "label")


def emitted_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges between canonical ids; an edge with an unmapped end is dropped; the type is the edge's key."""
    keys = ["patch_id", "version"]
    a = ids.select(*keys, F.col("nid").alias("src"), F.col("canonical").alias("a"))
    b = ids.select(*keys, F.col("nid").alias("dst"), F.col("canonical").alias("b"))
    return edges.join(a, [*keys, "src"]).join(b, [*keys, "dst"]).select(*keys, F.col("a").alias("src"), F.col("b").alias("dst"), F.col("edge_key").alias("edge_type"))


def _sample() -> Column:
    return F.concat(path_safe(F.col("patch_id")), F.lit("__"), F.col("version"))


def sample_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes with the name of their sample's folder; a sample is never gathered in one row."""
    return nodes.withColumn("sample", _sample())


def sample_counts(nodes: DataFrame) -> DataFrame:
    """A row for each sample: its name, nodes and positive nodes."""
    return nodes.groupBy("patch_id", "version").agg(F.count(F.lit(1)).alias("n_nodes"), F.sum("label").alias("n_positive")).withColumn("sample", _sample())


def write_queue(queue: DataFrame, path: str) -> None:
    queue.coalesce(1).write.mode("overwrite").json(path)


def write_manifest(totals: DataFrame, config: dict, path: str, elapsed: float, queue_path: str = "") -> None:
    """One JSON document that replaces the last run's."""
    facts = [F.struct(*[F.lit(v).alias(k) for k, v in config.items()]).alias("run_config"), F.lit(queue_path).alias("queue_path"), F.struct(*totals.columns).alias("totals")]
    totals.select(*facts, F.lit(round(elapsed, 1)).alias("elapsed_seconds"), (F.unix_micros(F.current_timestamp()) / 1e6).alias("generated_at")).coalesce(1).write.mode("overwrite").json(path)


def completed(spark: SparkSession, path: str) -> DataFrame:
    """Patches that have a functions row."""
    return read_jsonl(spark, path, "patch_id string").select("patch_id").distinct()
