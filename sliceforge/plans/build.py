"""From a work queue, diffs and exported graphs to the emitted relations: all samples in one plan."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceforge.functions.text import short_name
from sliceforge.operators import annotate, diff, program, sinks, slicing, validate
from sliceforge.runtime import materialize
from sliceforge.schemas import EMPTY_GRAPH, SAMPLE, STAGE_CANDIDATES, STAGE_FETCH, STAGE_GRAPHS, STAGE_REST, VERSIONS, RunConfig
from sliceforge.sources import files


@dataclass
class Dataset:
    """The relations of one run; skipped tells, by stage, why a patch (version null) or a sample has no nodes.

    Nodes, sinks and slice reports need the slices, which are computed when one of the three is first asked for; edges,
    and the slices with them, are lifted when first asked for. sink_statements (keys, nid, function, line,
    called_function, sink_reason) are the statements that sinks stand for, which need neither.
    """

    functions: DataFrame
    skipped: DataFrame
    sink_statements: DataFrame
    sink_reports: DataFrame
    call_statistics: DataFrame
    linked: Callable[[], DataFrame]
    sliced: Callable[[], tuple[DataFrame, DataFrame]]

    @cached_property
    def edges(self) -> DataFrame:
        return self.linked()

    @cached_property
    def _sliced(self) -> tuple[DataFrame, DataFrame]:
        return self.sliced()

    @property
    def nodes(self) -> DataFrame:
        return self._sliced[0]

    @property
    def sinks(self) -> DataFrame:
        return files.emitted_sinks(self.nodes)

    @property
    def slice_reports(self) -> DataFrame:
        return self._sliced[1]


def samples_of(queue: DataFrame) -> DataFrame:
    """(patch_id, version, commit, cwes, extra_sinks): both versions of each entry."""
    versions = F.array(*[F.struct(F.lit(v).alias("version"), F.col(c).alias("commit")) for v, c in zip(VERSIONS, ("commit_vuln", "commit_fix"), strict=True)])
    return queue.dropDuplicates(["patch_id"]).select("patch_id", F.explode(versions).alias("v"), "cwes", "extra_sinks").select("patch_id", "v.*", "cwes", "extra_sinks")


def build(queue: DataFrame, diffs: DataFrame, graph_nodes: DataFrame, graph_edges: DataFrame, config: RunConfig = RunConfig(), source: DataFrame | None = None, root: str | None = None) -> Dataset:
    """queue (patch_id, commit_vuln, commit_fix, cwes, extra_sinks), diffs (patch_id, diff), graphs keyed by graph_id,
    which is a commit -> the emitted relations.

    A patch without a diff, or with a version whose graph is missing, is skipped as a whole; a version without changed
    functions, or whose statement graph is empty, is skipped by itself; the others go on. source (commit, file, line,
    text) fills statements that were exported without code; file names below `root` are taken from there.
    """
    every = materialize(samples_of(queue), "samples")
    has_diff = diffs.select("patch_id").distinct()
    graphs = graph_nodes.select(F.col("graph_id").alias("commit")).distinct()
    reason = lambda df, stage, text: df.select("patch_id", F.lit(None).cast("string").alias("version"), F.lit(stage).alias("stage"), F.lit(text).alias("reason"))
    no_diff = every.select("patch_id").distinct().join(has_diff, "patch_id", "left_anti")
    no_graph = every.join(graphs, "commit", "left_anti").select("patch_id").distinct().join(has_diff, "patch_id", "left_semi")
    left_out = materialize(reason(no_diff, STAGE_FETCH, "no diff of this patch").unionByName(reason(no_graph, STAGE_GRAPHS, "no exported graph of a version")), "left_out")
    samples = materialize(every.join(left_out.select("patch_id"), "patch_id", "left_anti"), "samples")

    commits = samples.select(*SAMPLE, F.col("commit").alias("graph_id"))
    nodes = materialize(graph_nodes.join(commits, "graph_id").drop("graph_id"), "nodes")
    edges = materialize(graph_edges.join(commits, "graph_id").drop("graph_id"), "edges")
    changed = diff.modified_lines(diff.lines(diffs.join(samples.select("patch_id").distinct(), "patch_id", "left_semi")))
    known = materialize(program.methods(nodes, SAMPLE, root), "methods")
    # calls are those of a commit, whichever samples show it
    shown = commits.select("graph_id").distinct()
    calls, statistics = (df.join(commits, "graph_id").drop("graph_id") for df in program.call_graph(graph_nodes.join(shown, "graph_id"), graph_edges.join(shown, "graph_id")))
    candidates, _ = program.candidate_functions(changed, known, calls, SAMPLE, config.hops)
    candidates = materialize(candidates, "candidates")
    unchanged = samples.join(candidates.select(*SAMPLE).distinct(), SAMPLE, "left_anti").select(*SAMPLE, F.lit(STAGE_CANDIDATES).alias("stage"), F.lit(program.NO_CHANGES).alias("reason"))

    statements, flows = statement_edges(nodes, edges, candidates, samples, source)
    some = statements.select(*SAMPLE).distinct()
    empty = candidates.select(*SAMPLE).distinct().join(some, SAMPLE, "left_anti").select(*SAMPLE, F.lit(STAGE_REST).alias("stage"), F.lit(EMPTY_GRAPH).alias("reason"))

    lines = candidates.filter("role = 'patch'").select(*SAMPLE, "file", F.explode("modified_lines").alias("line"))
    extra = samples.select(*SAMPLE, F.explode("extra_sinks").alias("s")).select(*SAMPLE, "s.file", "s.line")
    marked = materialize(sinks.mark_sinks(statements, samples, lines, extra, config.proximity_lines), "marked")
    ids = cache(lambda: materialize(annotate.canonical_ids(marked), "ids"))

    def sliced() -> tuple[DataFrame, DataFrame]:
        patch = materialize(slicing.patch_nodes(marked, candidates), "patch")
        chosen, slice_reports = slicing.compute_slice(marked, flows(), patch, marked.filter("is_sink").select(*SAMPLE, F.col("nid").alias("id")), max_backward=config.max_hops_slice, max_forward=config.max_hops_slice)
        return materialize(annotate.annotate(marked, flows(), patch, chosen, candidates, samples.select(*SAMPLE, "commit"), ids=ids()), "records"), slice_reports

    functions = candidates.join(some, SAMPLE, "left_semi").select(*SAMPLE, "function_full", "name", "role", "hop_distance", "modified_lines", "file")
    notes = sinks.fallback_notes(samples.join(some, SAMPLE, "left_semi"), sinks.call_dimension(queue.sparkSession))
    return Dataset(
        functions,
        files.skip_rows(left_out.unionByName(unchanged).unionByName(empty)),
        marked.filter("is_sink").select(*SAMPLE, "nid", short_name(F.col("function")).alias("function"), "line", "called_function", "sink_reason"),
        sinks.sink_report(marked, SAMPLE, notes),
        statistics,
        lambda: files.emitted_edges(flows(), ids()),
        sliced,
    )


def statement_edges(nodes: DataFrame, edges: DataFrame, candidates: DataFrame, samples: DataFrame, source: DataFrame | None = None) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """Statements of the candidate functions, and what lifts their flows, argument bindings included; a statement without a file has its function's."""
    inside, between, _ = program.scoped(nodes, edges, candidates, SAMPLE)
    inside, between = materialize(inside, "inside"), materialize(between, "between")
    lines = None if source is None else source.join(samples.select(*SAMPLE, "commit"), "commit").drop("commit")
    statements, flows, lifted = program.statement_graph(inside, between, SAMPLE, lines)
    home = candidates.select(*SAMPLE, F.col("function_full").alias("function"), F.col("file").alias("home")).dropDuplicates([*SAMPLE, "function"])
    placed = statements.join(home, [*SAMPLE, "function"], "left").withColumn("file", F.coalesce(F.nullif(F.col("file"), F.lit("")), "home", F.lit(""))).drop("home")

    @cache
    def linked() -> DataFrame:
        bound = program.param_bindings(inside, between, lifted, SAMPLE)
        return materialize(flows.withColumn("arg_index", F.lit(None).cast("int")).unionByName(bound), "flows")

    return materialize(placed, "statements"), linked


def totals(data: Dataset, queue: DataFrame) -> DataFrame:
    """This run's row: patches with and without a sample, samples, nodes, positive nodes."""
    return validate.run_totals(data.nodes, queue.select("patch_id"), queue)


def run(spark: SparkSession, queue_path: str, diffs_path: str, graphs_path: str, out: str, config: RunConfig = RunConfig()) -> DataFrame:
    """Builds what a queue still lacks in `out`, appends it, replaces the manifest and returns the run's totals."""
    began = time.time()
    queue = files.read_queue(spark, queue_path)
    todo = materialize(validate.remaining(queue, files.completed(spark, f"{out}/functions")), "todo")
    nodes, edges = files.load_cpgs(spark, graphs_path)
    data = build(todo, files.diff_texts(spark, diffs_path), nodes, edges, config)
    files.write_dataset(out, data.nodes, data.edges, data.functions, data.skipped, config.debug_samples)
    row = materialize(totals(data, todo), "totals")
    files.write_manifest(row, asdict(config), f"{out}/manifest", time.time() - began, queue_path)
    return row


def check(spark: SparkSession, out: str) -> DataFrame:
    """The validator's checks of an emitted dataset."""
    keys = "patch_id string, version string, "
    have = tuple(n for n in validate.REQUIRED_FILES if files.path_exists(spark, f"{out}/{n}"))
    read = lambda name, ddl: files.read_jsonl(spark, f"{out}/{name}", ddl)
    raw = spark.read.text(f"{out}/nodes") if "nodes" in have else spark.createDataFrame([], "value string")
    row = files.read_manifest(spark, f"{out}/manifest").select("totals.*") if "manifest" in have else spark.createDataFrame([(0, 0)], "processed long, skipped long")
    return validate.report(read("nodes", keys + "id string, label int, type string"), read("edges", keys + "src string, dst string"), read("functions", keys + "role string"), read("sinks", keys + "sink_reason string"), read("skipped", keys + "stage string, reason string"), row, raw, have)
