"""Walks inside one task against the same walks by hops, and how many jobs the graph queries start."""

import random

from pyspark.sql import functions as F

from sliceforge.operators import program, within
from sliceforge.plans import registry

SF = "/root/testdata/sf0.001"
_NODES = "graph_id string, id string, _label string, name string, fullName string, controlStructureType string"


def _random_graph(spark, seed, across=False):
    """Methods with nested trees, a second parent here and there; across: trees that hold other methods."""
    rnd = random.Random(seed)
    nodes, edges = [], []
    for m in range(6):
        nodes.append(("g", f"m{m}", "METHOD", f"f{m}", f"f{m}", None))
        own = [f"m{m}"]
        for i in range(30):
            label = rnd.choice(["BLOCK", "CALL", "CONTROL_STRUCTURE", "RETURN", "IDENTIFIER", "LOCAL", "IDENTIFIER"])
            name = "<operator>.assignment" if label == "CALL" and rnd.random() < 0.5 else rnd.choice(["a", "b", "c", None])
            x = f"n{m}_{i}"
            nodes.append(("g", x, label, name, None, rnd.choice(["IF", "WHILE"]) if label == "CONTROL_STRUCTURE" else None))
            edges.append(("g", rnd.choice(own[-6:]), x, "AST", rnd.choice([None, 1, 2, 3])))
            if rnd.random() < 0.1:
                edges.append(("g", rnd.choice(own), x, "AST", 9))
            if rnd.random() < 0.3:
                edges.append(("g", f"m{m}", x, "CONTAINS", 0))
            if rnd.random() < 0.6:
                edges.append(("g", rnd.choice(own), x, "CFG", 0))
            own.append(x)
        if across and m:
            edges.append(("g", f"n{m - 1}_5", f"m{m}", "AST", 1))
    return spark.createDataFrame(nodes, _NODES), spark.createDataFrame(edges, "graph_id string, src string, dst string, etype string, child_pos long")


def _rows(df, *columns):
    return sorted((tuple(sorted(v) if isinstance(v, list) else v for v in r) for r in df.select(*columns).collect()), key=repr)


def test_owners_by_graph_and_by_hops(spark):
    for across in (False, True):
        nodes, edges = _random_graph(spark, 3, across)
        heads = program.methods(nodes.selectExpr("*", "'' AS filename", "1L AS lineNumber", "9L AS lineNumberEnd"))
        some = nodes.filter("_label IN ('CALL', 'METHOD')")
        whole = _rows(program.ownership(nodes, edges, heads), "id", "owner")
        assert whole and whole == _rows(program.ownership(nodes, edges, heads, whole=0), "id", "owner")
        want = {r.id for r in some.collect()}
        assert _rows(program.owners_of(some, edges, heads), "id", "owner") == [r for r in whole if r[0] in want]


def test_traits_by_method_and_by_hops(spark):
    nodes, edges = _random_graph(spark, 5)
    own = program.ownership(nodes, edges, nodes.filter("_label = 'METHOD'"))
    inside = nodes.join(own, ["graph_id", "id"])
    owned = edges.join(own.selectExpr("graph_id", "id AS src", "owner"), ["graph_id", "src"])
    columns = ["id", "marked", "found", "in_loop", "in_branch", "depth_cfg", "depth_ast", "coalesce(assigned, array()) AS assigned"]
    names = ["id", "coalesce(used, array()) AS used", "coalesce(declared, array()) AS declared"]
    near, far = within.traits(inside, owned, ["graph_id"]), program._traits_across(inside, edges, ["graph_id"])
    assert _rows(near.selectExpr(*columns), "*") == _rows(far.selectExpr(*columns), "*")
    assert _rows(near.filter("marked").selectExpr(*names), "*") == _rows(far.filter("marked").selectExpr(*names), "*")


def _jobs(spark, f):
    spark.sparkContext.setJobGroup("counted", "")
    f().count()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


def test_statement_edges_in_few_jobs(spark):
    assert _jobs(spark, lambda: registry.QUERIES["edge_lift_dedupe"](spark, SF)) < 80


def test_statements_alone(spark, monkeypatch):
    nodes, edges = _random_graph(spark, 11)
    nodes = nodes.selectExpr("*", "'a.c' AS filename", "1L AS lineNumber", "2L AS columnNumber", "'' AS code")
    every = nodes.filter("_label = 'METHOD'").selectExpr("graph_id", "fullName AS function_full")
    inside, kept, _ = program.scoped(nodes, edges, every)
    want = _rows(program.statement_graph(inside, kept)[0], "nid", "function")
    assert want and want == _rows(program.statements(inside, edges), "nid", "function")
    monkeypatch.setattr(within, "traits", None)  # sizes ask for no traits
    assert registry.QUERIES["function_sizes"](spark, SF).count() > 0


def test_scoped_edges(spark):
    nodes, edges = _random_graph(spark, 7, True)
    odd = [("g", "n1_0", None, "AST", 1), ("g", "n1_0", "n1_1", None, 0), ("g", "gone", "n1_1", "AST", 1), ("g", "n1_0", "n5_0", "CFG", 0)]
    edges = edges.unionByName(spark.createDataFrame(odd, edges.schema)).localCheckpoint()
    some = nodes.filter("id IN ('m1', 'm2')").selectExpr("graph_id", "fullName AS function_full")
    inside, kept, _ = program.scoped(nodes, edges, some)
    own = {r.id for r in inside.collect()}
    want = sorted((tuple(r) for r in edges.collect() if r.src in own and r.dst in own), key=repr)
    assert inside.columns == [*nodes.columns, "owner"] and kept.columns == edges.columns
    assert want and len(own) < nodes.count() and sorted(map(tuple, kept.collect()), key=repr) == want
    # tree edges are dealt out once, by the end they start from
    tree = program.scoped(nodes, edges.withColumn("etype", F.lit("AST")), some)[1]
    assert tree._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 1
