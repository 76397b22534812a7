"""Code property graph to statement graph, and candidate functions of a patch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sliceforge.functions.text import below, first_filled, strip
from sliceforge.operators import within
from sliceforge.operators.graph import bfs, bfs_labelled, climb, khop_roles, nearest_marked, search
from sliceforge.operators.joins import containing_or_nearest
from sliceforge.runtime import materialize
from sliceforge.schemas import BRANCHES, CONTROL_TYPES, LOOPS, NO_CHANGES, OPERATOR, OPERATOR_TYPES, SUB_EXPRESSIONS

GRAPH = ["graph_id"]


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def statement_type(label: Column, name: Column, control: Column) -> Column:
    return (
        F.when(label == "CALL", F.coalesce(_lookup(OPERATOR_TYPES, F.coalesce(name, F.lit(""))), F.lit("CALL")))
        .when(label == "CONTROL_STRUCTURE", F.coalesce(_lookup(CONTROL_TYPES, F.coalesce(control, F.lit(""))), F.lit("CONTROL")))
        .when(label == "RETURN", "RETURN")
        .when(label == "LOCAL", "DECL")
        .when(label == "BLOCK", "BLOCK")
        .when(label == "METHOD", "METHOD_ENTRY")
        .otherwise("OTHER")
    )


def methods(nodes: DataFrame, keys: list[str] = GRAPH, root: str | None = None) -> DataFrame:
    """Methods that stand for code: (keys, id, full_name, name, file, start, end); files under `root` are named from there."""
    m = nodes.filter("_label = 'METHOD'").select(
        *keys,
        "id",
        first_filled(F.col("fullName"), F.col("name"), default="").alias("full_name"),
        F.coalesce("name", F.lit("")).alias("name"),
        below(F.coalesce("filename", F.lit("")), root).alias("file"),
        F.coalesce("lineNumber", F.lit(0)).alias("start"),
        F.coalesce("lineNumberEnd", F.lit(0)).alias("end"),
    )
    return m.filter((F.col("full_name") != "") & ~F.col("full_name").startswith(OPERATOR) & ~F.col("name").isin("<global>", "<includes>") & ~F.col("full_name").rlike(":<(global|includes)>$"))


#: Tree edges of a graph that one task walks; larger graphs are walked by hops over all executors.
WHOLE = 3_000_000


def ownership(nodes: DataFrame, edges: DataFrame, claimers: DataFrame, keys: list[str] = GRAPH, whole: int = WHOLE) -> DataFrame:
    """(keys, id, owner): nodes under each claimer over AST and CONTAINS edges; other claimers stop the walk, the nearest owner wins."""
    tree = edges.filter("etype IN ('AST', 'CONTAINS')").select(*keys, "src", "dst")
    wide = materialize(tree.groupBy(*keys).count().filter(F.col("count") > whole).select(*keys), "wide")
    if wide.isEmpty():
        return within.owners(tree, claimers, keys)
    small = [df.join(wide, keys, "left_anti") for df in (tree, claimers)]
    large = [df.join(wide, keys, "left_semi") for df in (tree, claimers)]
    return within.owners(*small, keys).unionByName(_ownership_by_hops(*large, keys))


def _ownership_by_hops(tree: DataFrame, claimers: DataFrame, keys: list[str]) -> DataFrame:
    stop = claimers.select(*keys, F.col("id").alias("dst"))
    arcs = tree.join(stop, [*keys, "dst"], "left_anti").select(*keys, "src", "dst").distinct()
    walk = bfs_labelled(arcs, claimers.select(*keys, F.col("id").alias("owner"), "id"), keys, "owner")
    return walk.groupBy(*keys, "id").agg(F.min(F.struct("depth", "owner")).alias("b")).select(*keys, "id", F.col("b.owner").alias("owner"))


def owners_of(wanted: DataFrame, edges: DataFrame, claimers: DataFrame, keys: list[str] = GRAPH) -> DataFrame:
    """ownership() of some nodes only (keys, id): each climbs AST and CONTAINS edges until it meets claimers, the smallest of the nearest."""
    heads = claimers.select(*keys, F.col("id").alias("at"), F.col("id").alias("owner")).distinct()
    arcs = edges.filter("etype IN ('AST', 'CONTAINS')").select(*keys, F.col("dst").alias("at"), F.col("src").alias("next"))
    level = wanted.select(*keys, "id", F.col("id").alias("at")).distinct()
    out: DataFrame | None = None
    passed: DataFrame | None = None
    while True:
        level = materialize(level.join(heads, [*keys, "at"], "left"), "owners")
        if level.isEmpty():
            return level.select(*keys, "id", "owner") if out is None else out
        met = level.filter("owner IS NOT NULL").groupBy(*keys, "id").agg(F.min("owner").alias("owner"))
        out = met if out is None else out.unionByName(met)
        passed = level.select(*keys, "id", "at") if passed is None else passed.unionByName(level.select(*keys, "id", "at"))
        rest = level.drop("owner").join(met, [*keys, "id"], "left_anti")
        if rest.isEmpty():  # else the whole tree would be dealt out once more to find nothing
            return out
        level = rest.join(arcs, ["at", *keys]).select(*keys, "id", F.col("next").alias("at")).distinct().join(passed, [*keys, "id", "at"], "left_anti")


def call_graph(nodes: DataFrame, edges: DataFrame, keys: list[str] = GRAPH) -> tuple[DataFrame, DataFrame]:
    """(calls (keys, caller, callee), statistics): each call is orphan (no owner), external (unknown target) or resolved."""
    known = materialize(methods(nodes, keys), "methods")
    calls = nodes.filter("_label = 'CALL'").withColumn("target", F.coalesce("methodFullName", F.lit(""))).filter((F.col("target") != "") & ~F.col("target").startswith(OPERATOR))
    calls = materialize(calls.select(*keys, "id", "target"), "named")
    own = owners_of(calls, edges, known, keys)
    named = known.select(*keys, F.col("id").alias("owner"), F.col("full_name").alias("caller"))
    targets = known.select(*keys, F.col("full_name").alias("target")).distinct().withColumn("callee", F.col("target"))
    tagged = calls.select(*keys, "id", "target").join(own, [*keys, "id"], "left").join(named, [*keys, "owner"], "left").join(targets, [*keys, "target"], "left")
    status = F.when(F.col("caller").isNull(), "orphan").when(F.col("callee").isNull(), "external").otherwise("resolved")
    tagged = tagged.withColumn("status", status)
    first = tagged.filter("status = 'external'").select(*keys, "target").distinct().withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("target"))).filter("nth <= 5")
    tagged = materialize(tagged.join(first, [*keys, "target"], "left"), "calls")
    stats = tagged.groupBy(*keys).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("resolved", "external", "orphan")],
        # five unknown targets, for diagnosis
        F.slice(F.array_sort(F.collect_set(F.when((F.col("status") == "external") & (F.col("nth") <= 5), F.col("target")))), 1, 5).alias("unknown_targets"),
    )
    return tagged.filter("status = 'resolved'").select(*keys, "caller", "callee").distinct(), stats


def candidate_functions(modified: DataFrame, known: DataFrame, calls: DataFrame, keys: list[str], hops: int = 1, fuzz: int = 3) -> tuple[DataFrame, DataFrame]:
    """modified (keys, file, line), known methods (keys, full_name, name, file, start, end), calls (keys, caller, callee)
    -> candidates (keys, function_full, name, role, hop_distance, modified_lines, file) and the samples that were skipped.
    """
    spans = known.select(*keys, "file", F.col("full_name").alias("name"), "start", "end")
    hit = containing_or_nearest(modified, spans, [*keys, "file"], fuzz)
    patched = materialize(hit.groupBy(*keys, F.col("name").alias("function_full")).agg(F.array_sort(F.collect_set("line")).alias("modified_lines")), "patched")
    around = khop_roles(calls, patched.select(*keys, F.col("function_full").alias("id")), keys, hops)
    every = patched.withColumn("role", F.lit("patch")).withColumn("hop_distance", F.lit(0)).unionByName(
        around.select(*keys, F.col("id").alias("function_full"), F.array().cast("array<int>").alias("modified_lines"), "role", F.col("hop").alias("hop_distance")).withColumn(
            "modified_lines", F.col("modified_lines").cast(patched.schema["modified_lines"].dataType)
        )
    )
    meta = known.select(*keys, F.col("full_name").alias("function_full"), "name", "file").dropDuplicates([*keys, "function_full"])
    out = every.join(meta, [*keys, "function_full"], "left")
    skipped = modified.select(*keys).distinct().join(patched.select(*keys).distinct(), keys, "left_anti").withColumn("reason", F.lit(NO_CHANGES))
    return out, skipped


def scoped(nodes: DataFrame, edges: DataFrame, candidates: DataFrame, keys: list[str] = GRAPH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes owned by candidate methods (keys, id, owner, ...), edges with both ends owned, candidates that the graph lacks."""
    full = first_filled(F.col("fullName"), F.col("name"), default="")
    present = nodes.filter("_label = 'METHOD'").withColumn("function_full", full).join(candidates.select(*keys, "function_full").distinct(), [*keys, "function_full"], "left_semi")
    heads = present.groupBy(*keys, "function_full").agg(F.min("id").alias("id"))
    own = materialize(ownership(nodes, edges, heads.select(*keys, "id"), keys), "own")
    # ids first: joins sort by the first key, and a graph's rows all share its name
    inside = nodes.join(own, ["id", *keys]).select(*keys, "id", *[c for c in nodes.columns if c not in (*keys, "id")], "owner")
    within_ = lambda df, end: df.join(own.select(*keys, F.col("id").alias(end)), [end, *keys], "left_semi").select(*edges.columns)
    # a walk goes on from every owned node, so what its tree edges lead to is owned as well
    tree = F.coalesce(F.col("etype").isin("AST", "CONTAINS"), F.lit(False))
    kept = within_(edges.filter(tree & F.col("dst").isNotNull()), "src").unionByName(within_(within_(edges.filter(~tree), "src"), "dst"))
    missing = candidates.select(*keys, "function_full").distinct().join(heads, [*keys, "function_full"], "left_anti")
    return inside, kept, missing


def statement_graph(nodes: DataFrame, edges: DataFrame, keys: list[str] = GRAPH, lines: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scoped nodes (with owner) and edges -> statement nodes, statement edges, and where each node was lifted to.

    Edges (keys, src, dst, edge_key, edge_type): control flow, data flow and calls between different
    statements, once each. Variables of a statement are those in its whole subtree (no cap on its size). `lines`
    (keys, file, line, text) fills code that the export left empty.
    """
    ends = nodes.select(*keys, "id", "owner")
    held = (
        edges.filter("etype IN ('AST', 'CFG')")
        .join(ends.withColumnRenamed("id", "src"), [*keys, "src"])
        .join(ends.select(*keys, F.col("id").alias("dst"), F.col("owner").alias("dst_owner")), [*keys, "dst"])
        .select(*keys, "etype", "src", "dst", "child_pos", "owner", "dst_owner")
    )
    held = materialize(held, "held")
    inner = held.filter("owner = dst_owner").drop("dst_owner")
    if held.filter("etype = 'AST' AND owner <> dst_owner").isEmpty():
        found = within.traits(nodes, inner, keys)
    else:  # trees that reach across methods are walked by hops
        found = _traits_across(nodes, edges, keys)
    lifted = found.select(*keys, "id", "found")
    stmts = nodes.join(found.filter("marked").drop("marked", "found"), [*keys, "id"])
    heads = nodes.filter("_label = 'METHOD'").select(
        *keys, F.col("id").alias("owner"), first_filled(F.col("fullName"), F.col("name"), default="").alias("function"), F.col("filename").alias("owner_file")
    )
    kind = statement_type(F.col("_label"), F.col("name"), F.col("controlStructureType"))
    called = F.when((F.col("_label") == "CALL") & ~F.coalesce("name", F.lit("")).startswith(OPERATOR), F.col("name"))
    none = F.array().cast("array<string>")
    out = (
        stmts.join(heads, [*keys, "owner"], "left")
        .select(
            *keys,
            F.col("id").alias("nid"),
            "function",
            F.coalesce("lineNumber", F.lit(0)).cast("int").alias("line"),
            F.coalesce("columnNumber", F.lit(0)).cast("int").alias("column"),
            kind.alias("stmt_type"),
            F.regexp_replace(F.coalesce("code", F.lit("")), "^\\s+|\\s+$", "").alias("code"),
            F.coalesce("depth_cfg", F.lit(-1)).alias("depth_cfg"),
            F.coalesce("depth_ast", F.lit(-1)).alias("depth_ast"),
            F.array_sort(F.array_except(F.coalesce("used", none), F.coalesce("assigned", none))).alias("variables_used"),
            F.array_sort(F.array_union(F.coalesce("declared", none), F.coalesce("assigned", none))).alias("variables_defined"),
            "in_loop",
            "in_branch",
            called.alias("called_function"),
            first_filled(F.col("filename"), F.col("owner_file")).alias("file"),
        )
    )
    if lines is not None:
        own = lines.select(*keys, "file", "line", F.col("text").alias("source")).dropDuplicates([*keys, "file", "line"])
        out = out.join(own, [*keys, "file", "line"], "left").withColumn("code", F.when(F.col("code") != "", F.col("code")).otherwise(strip(F.coalesce("source", F.lit(""))))).drop("source")
    return out, lift_edges(edges, lifted, keys), lifted


def _is_statement(in_block: Column) -> Column:
    """Whether a node is a statement, by its label and whether its parent is a block."""
    return F.coalesce((F.col("_label").isin("METHOD", "CONTROL_STRUCTURE", "RETURN") | in_block) & ~F.col("_label").isin(*SUB_EXPRESSIONS), F.lit(False))


def statements(nodes: DataFrame, edges: DataFrame, keys: list[str] = GRAPH) -> DataFrame:
    """(keys, nid, function): the statement nodes of statement_graph() without their traits; edges that leave the scoped nodes may be among the edges."""
    above = nodes.select(*keys, F.col("id").alias("src"), (F.col("_label") == "BLOCK").alias("block"))
    # the last parent wins; the export has one
    parent = (
        edges.filter("etype = 'AST'").select(*keys, "src", "dst").join(above, ["src", *keys])
        .groupBy(F.col("dst").alias("id"), *keys).agg(F.max(F.struct("src", F.coalesce("block", F.lit(False)).alias("block"))).alias("p")).select(*keys, "id", F.col("p.block").alias("block"))
    )
    # most nodes can be no statement, whatever their parent
    able = nodes.filter(_is_statement(F.lit(True))).select(*keys, "id", "owner", "_label")
    found = able.join(parent, ["id", *keys], "left").filter(_is_statement(F.coalesce("block", F.lit(False))))
    heads = nodes.filter("_label = 'METHOD'").select(*keys, F.col("id").alias("owner"), first_filled(F.col("fullName"), F.col("name"), default="").alias("function"))
    return found.join(heads, ["owner", *keys], "left").select(*keys, F.col("id").alias("nid"), "function")


def _traits_across(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """within.traits() by hops over all nodes, whatever methods a tree reaches."""
    ast = edges.filter("etype = 'AST'")
    # the last parent wins; the export has one
    parent = ast.groupBy(*keys, F.col("dst").alias("id")).agg(F.max("src").alias("parent"))
    labels = nodes.select(*keys, F.col("id").alias("parent"), F.col("_label").alias("parent_label"), F.col("controlStructureType").alias("parent_control"))
    placed = nodes.join(parent, [*keys, "id"], "left").join(labels, [*keys, "parent"], "left")
    placed = materialize(
        placed.withColumn("marked", _is_statement(F.coalesce(F.col("parent_label") == "BLOCK", F.lit(False))))
        .withColumn("loop", (F.col("parent_label") == "CONTROL_STRUCTURE") & F.col("parent_control").isin(*LOOPS))
        .withColumn("branch", (F.col("parent_label") == "CONTROL_STRUCTURE") & F.col("parent_control").isin(*BRANCHES)),
        "placed",
    )
    lifted = nearest_marked(placed.select(*keys, "id", "parent", "marked"), keys)
    nested = climb(placed.select(*keys, "id", "parent", "loop", "branch"), keys, ["loop", "branch"], 6)
    stmts = placed.filter("marked")
    used, defined = _variables(stmts, nodes, ast, keys)
    cfg, tree = _depths(nodes, edges, keys, "CFG"), _depths(nodes, edges, keys, "AST")
    one = lambda df, *names: df.select(*keys, "id", *names)
    return (
        one(placed, "marked")
        .join(one(lifted, "found"), [*keys, "id"], "left")
        .join(one(nested, F.col("loop").alias("in_loop"), F.col("branch").alias("in_branch")), [*keys, "id"], "left")
        .join(used, [*keys, "id"], "left")
        .join(defined, [*keys, "id"], "left")
        .join(one(cfg, F.col("depth").alias("depth_cfg")), [*keys, "id"], "left")
        .join(one(tree, F.col("depth").alias("depth_ast")), [*keys, "id"], "left")
    )


def lift_edges(edges: DataFrame, lifted: DataFrame, keys: list[str] = GRAPH) -> DataFrame:
    """Raw edges between statements: ends replaced by their statements; self loops and open ends go, copies count once."""
    kind = F.when(F.col("etype") == "REACHING_DEF", "DFG").otherwise(F.col("etype"))
    ends = lifted.filter("found IS NOT NULL")
    return (
        edges.filter("etype IN ('CFG', 'REACHING_DEF', 'CALL')")
        .join(ends.select(*keys, F.col("id").alias("src"), F.col("found").alias("a")), [*keys, "src"])
        .join(ends.select(*keys, F.col("id").alias("dst"), F.col("found").alias("b")), [*keys, "dst"])
        .filter("a <> b")
        .select(*keys, F.col("a").alias("src"), F.col("b").alias("dst"), kind.alias("edge_key"), kind.alias("edge_type"))
        .distinct()
    )


def param_bindings(nodes: DataFrame, edges: DataFrame, lifted: DataFrame, keys: list[str] = GRAPH) -> DataFrame:
    """From the statement of each argument (index 1 on) to the entry of each called method, once for each index."""
    ends = lifted.filter("found IS NOT NULL")
    calls = edges.filter("etype = 'CALL'").select(*keys, F.col("src").alias("call"), F.col("dst").alias("callee"))
    args = edges.filter("etype = 'ARGUMENT'").select(*keys, F.col("src").alias("call"), F.col("dst").alias("arg"))
    index = nodes.select(*keys, F.col("id").alias("arg"), F.col("argumentIndex").cast("int").alias("arg_index")).filter("arg_index >= 1")
    return (
        calls.join(args, [*keys, "call"])
        .join(index, [*keys, "arg"])
        .join(ends.select(*keys, F.col("id").alias("arg"), F.col("found").alias("src")), [*keys, "arg"])
        .join(ends.select(*keys, F.col("id").alias("callee"), F.col("found").alias("dst")), [*keys, "callee"])
        .filter("src <> dst")
        .select(*keys, "src", "dst", F.concat(F.lit("PARAM_BIND_"), F.col("arg_index")).alias("edge_key"), F.lit("PARAM_BIND").alias("edge_type"), "arg_index")
        .distinct()
    )


def _depths(nodes: DataFrame, edges: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Hops from each node's own method over raw edges of one kind: (keys, id, depth)."""
    heads = nodes.filter("_label = 'METHOD' AND id = owner").select(*keys, "id", "owner")
    own = nodes.select(*keys, F.col("id"), "owner")
    arcs = edges.filter(F.col("etype") == kind).join(own.select(*keys, F.col("id").alias("src"), "owner"), [*keys, "src"]).join(own.select(*keys, F.col("id").alias("dst"), "owner"), [*keys, "dst", "owner"])
    return bfs(arcs, heads, [*keys, "owner"]).select(*keys, "id", "depth")


def _variables(stmts: DataFrame, nodes: DataFrame, ast: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(used, declared) of each statement's subtree, and the variable that an assignment writes.

    Names climb from their nodes to all ancestors, each name once a node: what moves is as large as the answer.
    """
    names = nodes.filter("_label IN ('IDENTIFIER', 'LOCAL') AND name <> ''").select(*keys, "id", "_label", "name")
    up = ast.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))
    met = search(up, names, keys, ["_label", "name"]).join(stmts.select(*keys, "id"), [*keys, "id"], "left_semi")
    used = met.groupBy(*keys, "id").agg(
        F.collect_set(F.when(F.col("_label") == "IDENTIFIER", F.col("name"))).alias("used"), F.collect_set(F.when(F.col("_label") == "LOCAL", F.col("name"))).alias("declared")
    )
    writes = stmts.filter((F.col("_label") == "CALL") & F.col("name").startswith(f"{OPERATOR}.assignment")).select(*keys, F.col("id").alias("src"))
    return used, _first_identifiers(ast.join(writes, [*keys, "src"]), nodes, ast, keys)


def _first_identifiers(children: DataFrame, nodes: DataFrame, ast: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, id, assigned) for each src of children: the first identifier, in breadth-first order, under its first child.

    Of nodes at one depth the order is that of their paths of child positions. A level is searched at a time,
    and a root that has met an identifier goes no further.
    """
    place = F.col("child_pos")
    level = children.groupBy(*keys, F.col("src").alias("root")).agg(F.min_by("dst", F.struct("child_pos", "dst")).alias("id")).withColumn("path", F.array().cast("array<bigint>"))
    kind = nodes.select(*keys, "id", (F.col("_label") == "IDENTIFIER").alias("hit"), "name")
    arcs = materialize(ast.select(*keys, F.col("src").alias("id"), F.col("dst").alias("next"), place.cast("bigint").alias("at")), "ast")
    out: DataFrame | None = None
    while True:
        level = materialize(level.join(kind, [*keys, "id"]), "lhs")
        if level.isEmpty():
            break
        first = level.filter("hit").groupBy(*keys, "root").agg(F.min_by("name", F.struct("path", "id")).alias("lhs"))
        out = first if out is None else out.unionByName(first)
        level = level.drop("hit", "name").join(first, [*keys, "root"], "left_anti").join(arcs, [*keys, "id"]).select(*keys, "root", F.col("next").alias("id"), F.concat("path", F.array("at")).alias("path"))
    if out is None:
        out = level.select(*keys, "root", F.col("name").alias("lhs"))
    return out.filter("lhs <> ''").select(*keys, F.col("root").alias("id"), F.array("lhs").alias("assigned"))


def size_report(stmts: DataFrame, keys: list[str] = GRAPH, warn: int = 1000) -> DataFrame:
    """Statements of each function, and whether there are more than `warn`."""
    return stmts.groupBy(*keys, "function").agg(F.count(F.lit(1)).alias("n")).withColumn("large", F.col("n") > warn)
