"""Operators on small graphs, diffs and catalogues."""

import sqlite3

from pyspark.sql import functions as F

from sliceforge import __main__ as command
from sliceforge.functions import text as tx
from sliceforge.operators import annotate, diff, graph, ingest, joins, program, sinks, slicing, validate
from sliceforge.operators.components import connected_components
from sliceforge.plans import build, cpg
from sliceforge.schemas import RunConfig
from sliceforge.sources import files
from sliceforge.streaming import queue

KEYS = ["patch_id", "version"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_diff_headers(spark):
    """Two files a patch; the second one's old header is a removed line of the first unless headers are read strictly."""
    first = ["--- a/src/queue.h", "+++ b/src/queue.h", "@@ -31,4 +31,3 @@ struct queue", " int head;", "-int tail;", "-int size;", "+long size;", " };"]
    second = ["--- /dev/null", "+++ b/src/ring.h", "@@ -0,0 +1,2 @@", "+#define RING 8", "+typedef int slot;"]
    lines = diff.lines(spark.createDataFrame([("p", "\n".join([*first, *second]) + "\n")], "patch_id string, diff string"))
    plain = {(r.file, r.version, r.line) for r in diff.modified_lines(lines).collect()}
    strict = {(r.file, r.version, r.line) for r in diff.modified_lines(lines, strict_headers=True).collect()}
    assert strict == {("src/queue.h", "vulnerable", 32), ("src/queue.h", "vulnerable", 33), ("src/queue.h", "fixed", 32), ("src/ring.h", "fixed", 1), ("src/ring.h", "fixed", 2)}
    assert plain - strict == {("src/queue.h", "vulnerable", 35)}
    assert diff.modified_lines(lines.limit(0)).count() == 0


def test_urls_parents_classes(spark):
    urls = [("http://GitHub.com/Own/Proj.git",), ("https://gitlab.com/a/b/c/",), ("https://example.org/a/b",), ("https://github.com/only",), (None,), ("null",)]
    got = [r[0] for r in spark.createDataFrame(urls, "u string").select(tx.normalize_repo_url(F.col("u"))).collect()]
    assert got == ["https://github.com/Own/Proj", "https://gitlab.com/a/b", None, None, None, None]
    raw = [("['h1', 'h2']",), ("['h1']",), ("[]",), ("",), (None,), ("a b",), ("one",)]
    got = [r[0] for r in spark.createDataFrame(raw, "p string").select(tx.parse_parents(F.col("p"))).collect()]
    assert got == [["h1", "h2"], ["h1"], [], [], [], ["a", "b"], ["one"]]
    got = [r[0] for r in spark.createDataFrame([("120",), ("cwe120",), (" CWE-120",), ("x",)], "c string").select(tx.normalize_cwe(F.col("c"))).collect()]
    assert got == ["CWE-120", "CWE-120", "CWE-120", "X"]


def test_ingest(spark):
    h = "abcdef0%d"
    fixes = spark.createDataFrame([("C1", h % 1, "https://github.com/a/b"), ("C1", h % 2, "https://github.com/a/b"), ("C2", h % 3, "https://github.com/torvalds/linux"), ("C3", h % 4, "https://github.com/x/y")], "cve_id string, hash string, repo_url string")
    commits = spark.createDataFrame([(h % 1, "['1234567']", "2020-02-01"), (h % 2, "['1234567']", "2020-01-01"), (h % 3, "['1234567']", ""), (h % 4, "[]", "")], "hash string, parents string, author_date string")
    cwe = spark.createDataFrame([("C1", "CWE-2"), ("C1", "CWE-1"), ("C2", "CWE-1"), ("C3", "CWE-1")], "cve_id string, cwe_id string")
    source = ingest.source_rows(fixes, commits, cwe)
    found = ingest.work_queue(source).collect()
    assert [(r.patch_id, r.commit_fix, r.cwes) for r in found] == [("b/C1", h % 2, ["CWE-1", "CWE-2"])]
    assert rows(ingest.reject_counts(source)) == [("banned_project", 1), ("no_parent", 1)]


def test_nearest_and_containing(spark):
    spans = spark.createDataFrame([("f", "wide", 1, 100), ("f", "narrow", 10, 20), ("f", "far", 200, 0)], "file string, name string, start int, end int")
    lines = spark.createDataFrame([("f", 15), ("f", 50), ("f", 103), ("f", 104), ("f", 198), ("g", 15)], "file string, line int")
    got = {(r.line, r.name, r.kind) for r in joins.containing_or_nearest(lines, spans, ["file"]).collect()}
    assert got == {(15, "narrow", 0), (50, "wide", 0), (103, "wide", 1), (198, "far", 1)}


def _edges(spark, pairs, kind="CFG"):
    return spark.createDataFrame([("p", "v", a, b, kind, kind) for a, b in pairs], "patch_id string, version string, src string, dst string, edge_type string, edge_key string")


def _ids(spark, ids):
    return spark.createDataFrame([("p", "v", i) for i in ids], "patch_id string, version string, id string")


def test_slices(spark):
    nodes = _ids(spark, list("abcdx")).withColumnRenamed("id", "nid")
    e = _edges(spark, [("a", "b"), ("b", "c"), ("c", "d")])
    got, report = slicing.compute_slice(nodes, e, _ids(spark, "a"), _ids(spark, "c"), KEYS)
    assert [r.id for r in got.orderBy("id").collect()] == ["a", "b", "c"]
    apart, report = slicing.compute_slice(nodes, e, _ids(spark, "a"), _ids(spark, "x"), KEYS)
    assert [r.id for r in apart.orderBy("id").collect()] == ["a", "x"]
    assert report.first().skipped == "empty intersection; used anchor-union fallback"
    none, report = slicing.compute_slice(nodes, e, _ids(spark, "a").limit(0), _ids(spark, "c"), KEYS)
    assert none.count() == 0 and report.first().skipped == "no patch nodes on this version"
    short, _ = slicing.compute_slice(nodes, e, _ids(spark, "a"), _ids(spark, "d"), KEYS, 1, 1)
    assert [r.id for r in short.orderBy("id").collect()] == ["a", "d"]
    depth = {r.id: r.depth for r in slicing.patch_distance(e, _ids(spark, "c"), KEYS).collect()}
    assert depth == {"c": 0, "b": 1, "d": 1, "a": 2}


def test_sink_rules(spark):
    n = [("1", "f", 10, "CALL", "memcpy"), ("2", "f", 52, "CALL", "malloc"), ("3", "f", 60, "CALL", "malloc"), ("4", "f", 70, "ASSIGN", "memcpy"), ("5", "g", 5, "OTHER", None)]
    nodes = spark.createDataFrame([("p", "v", *x) for x in n], "patch_id string, version string, nid string, file string, line int, stmt_type string, called_function string")
    samples = spark.createDataFrame([("p", "v", ["cwe-120"])], "patch_id string, version string, cwes array<string>")
    patched = spark.createDataFrame([("p", "v", "f", 50)], "patch_id string, version string, file string, line int")
    extra = spark.createDataFrame([("p", "v", "g", 5)], "patch_id string, version string, file string, line int")
    got = {r.nid: r.sink_reason for r in sinks.mark_sinks(nodes, samples, patched, extra).filter("is_sink").collect()}
    assert got == {"1": "cwe_api:memcpy", "2": "patch_proximity:malloc", "5": "user"}
    every = sinks.mark_sinks(nodes, samples.withColumn("cwes", F.array(F.lit("CWE-0"))), patched).filter("is_sink")
    assert {r.nid for r in every.collect()} == {"1", "2", "3"}


def test_statement_graph(spark):
    n = [
        ("m", "METHOD", "f", "f", None, None), ("b", "BLOCK", None, None, None, None), ("i", "CONTROL_STRUCTURE", None, None, "IF", None), ("b2", "BLOCK", None, None, None, None),
        ("s", "CALL", "<operator>.assignment", None, None, None), ("x", "IDENTIFIER", "x", None, None, 1), ("y", "IDENTIFIER", "y", None, None, 2), ("r", "RETURN", None, None, None, None),
    ]
    nodes = spark.createDataFrame([("g", *r, "m") for r in n], "graph_id string, id string, _label string, name string, fullName string, controlStructureType string, argumentIndex long, owner string")
    for c, kind in (("filename", "string"), ("lineNumber", "bigint"), ("columnNumber", "bigint"), ("code", "string")):
        nodes = nodes.withColumn(c, F.lit(None).cast(kind))
    e = [("m", "b", "AST", 0), ("b", "i", "AST", 0), ("i", "b2", "AST", 0), ("b2", "s", "AST", 0), ("s", "x", "AST", 0), ("s", "y", "AST", 1), ("b", "r", "AST", 1), ("m", "x", "CFG", 0), ("x", "s", "CFG", 0), ("s", "r", "CFG", 0)]
    edges = spark.createDataFrame([("g", *r) for r in e], "graph_id string, src string, dst string, etype string, child_pos int")
    stmts, lifted, _ = program.statement_graph(nodes, edges)
    got = {r.nid: r for r in stmts.collect()}
    assert set(got) == {"m", "i", "s", "r"}
    assert got["s"].stmt_type == "ASSIGN" and got["s"].variables_used == ["y"] and got["s"].variables_defined == ["x"] and got["s"].in_branch and not got["r"].in_branch
    assert got["m"].variables_used == ["x", "y"] and got["s"].depth_cfg == 2 and got["i"].depth_cfg == -1
    assert {(r.src, r.dst) for r in lifted.collect()} == {("m", "s"), ("s", "r")}


def test_annotate(spark):
    n = [("p", "v", str(i), "a:f", i, 0, "OTHER", f"l{i}", 0, 0, None, None) for i in range(3)]
    nodes = spark.createDataFrame(n, "patch_id string, version string, nid string, function string, line int, column int, stmt_type string, code string, depth_cfg int, depth_ast int, called_function string, sink_reason string")
    nodes = nodes.withColumn("variables_used", F.array().cast("array<string>")).withColumn("variables_defined", F.col("variables_used")).withColumn("in_loop", F.lit(False)).withColumn("in_branch", F.lit(False)).withColumn("is_sink", F.lit(False))
    fns = spark.createDataFrame([("p", "v", "a:f", "patch", "f.c", [0])], "patch_id string, version string, function_full string, role string, file string, modified_lines array<int>")
    out = {r.id: r for r in annotate.annotate(nodes, _edges(spark, [("0", "1")]), _ids(spark, "0"), _ids(spark, "01"), fns).collect()}
    assert out["p:v:00000"].CFG_successors == ["p:v:00001"] and out["p:v:00001"].distance_to_patch == 1 and out["p:v:00002"].distance_to_patch is None
    assert [out[k].label for k in sorted(out)] == [1, 1, 0] and out["p:v:00000"].function == "f" and out["p:v:00000"].role == "patch"


def test_components_and_roles(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "u long, v long")
    got = {r.node: r.component for r in connected_components(e).collect()}
    assert got[40] == 0 and got[101] == 100 and len(got) == 43
    calls = spark.createDataFrame([("p", "v", "a", "b"), ("p", "v", "b", "c"), ("p", "v", "b", "a")], "patch_id string, version string, caller string, callee string")
    assert rows(graph.khop_roles(calls, _ids(spark, "b"), KEYS, 1).select("id", "role")) == [("a", "caller"), ("c", "callee")]


def test_files_and_checks(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('# note\n\n{"patch_id":"p","repo_url":"u","commit_vuln":"a","commit_fix":"b","extra_sinks":[{"file":"f","line":3},["g",4,"x"],7]}\nbroken\n{"patch_id":"z"}\n{"patch_id":"n","commit_vuln":"a","commit_fix":"b"}\n')
    got = files.read_queue(spark, str(tmp_path / "q.jsonl")).collect()
    assert [(r.patch_id, r.repo_url, [tuple(s) for s in r.extra_sinks]) for r in got] == [("p", "u", [("f", 3), ("g", 4)]), ("n", "", [])]
    (tmp_path / "nodes_M_header.csv").write_text(":ID,:LABEL,FULL_NAME:string,LINE_NUMBER:int\n")
    (tmp_path / "nodes_M_data.csv").write_text('1,METHOD,"a\nb",x\n,METHOD,c,3\n2,,d,7\n3\n1,METHOD,again,\n')
    pairs = [(str(tmp_path / h), str(tmp_path / n)) for h, n in files.cpg_files(["nodes_M_header.csv", "nodes_M_data.csv", "edges_A_data.csv"])]
    nodes, _ = files.load_cpg(spark, pairs, "g")
    assert sorted((tuple(r) for r in nodes.select("id", "_label", "fullName", F.coalesce("lineNumber", F.lit(-1))).collect()), key=str) == [("1", "METHOD", "again", -1), ("2", "", "d", 7), ("3", "UNKNOWN", None, -1)]
    n = spark.createDataFrame([("p:v:00000",), ("p:w:00000",)], "id string")
    e = spark.createDataFrame([("p:v:00000", "p:w:00000"), ("p:v:00000", "none")], "src string, dst string")
    assert tuple(validate.edge_integrity(e, n).first()) == (2, 1, 1)


def test_lift_reaches_as_far_as_it_should(spark):
    chain = spark.createDataFrame([("g", i, i - 1 if i else None, i == 0) for i in range(400)], "graph_id string, id long, parent long, marked boolean")
    lifted = graph.nearest_marked(chain, ["graph_id"]).filter("found IS NOT NULL")
    assert lifted.count() == 128  # the node itself and 127 ancestors
    flags = spark.createDataFrame([("g", i, i - 1 if i else None, i == 1) for i in range(400)], "graph_id string, id long, parent long, loop boolean")
    assert rows(graph.climb(flags, ["graph_id"], ["loop"], 6).filter("loop").agg(F.max("id")))[0][0] == 64


def test_search_on_chains(spark):
    e = _edges(spark, [(str(i), str(i + 1)) for i in range(23)] + [("5", "2"), ("9", "9")])
    for hops, want in ((None, 24), (7, 8), (8, 9), (0, 1)):
        got = {r.id: r.depth for r in graph.bfs(e, _ids(spark, ["0"]), KEYS, hops).collect()}
        assert got == {str(i): i for i in range(want)}
    assert graph.bfs(e, _ids(spark, ["0"]).limit(0), KEYS).count() == 0


def test_wide_spans_stay_small(spark):
    spans = spark.createDataFrame([("f", "all", 1, 2**31 - 1), ("f", "some", 1000, 90000)], "file string, name string, start long, end long")
    lines = spark.createDataFrame([("f", 5), ("f", 1500), ("f", 2**30)], "file string, line long")
    got = joins.containing_or_nearest(lines, spans, ["file"])
    assert {(r.line, r.name) for r in got.collect()} == {(5, "all"), (1500, "some"), (2**30, "all")}


def test_first_identifier_in_breadth_first_order(spark):
    """Under the first child the nearest identifier counts; of equally deep ones that whose ancestors come first."""
    e = [("s", "l", 0), ("s", "z", 1), ("l", "c", 0), ("l", "d", 1), ("d", "first_row", 0), ("c", "wanted", 1), ("c", "k", 2), ("k", "deep", 0)]
    ast = spark.createDataFrame([("g", *r) for r in e], "graph_id string, src string, dst string, child_pos long")
    kinds = {"first_row": "IDENTIFIER", "wanted": "IDENTIFIER", "deep": "IDENTIFIER", "z": "IDENTIFIER"}
    nodes = spark.createDataFrame([("g", i, kinds.get(i, "CALL"), i) for i in "s l z c d first_row wanted k deep".split()], "graph_id string, id string, _label string, name string")
    got = program._first_identifiers(ast.filter("src = 's'"), nodes, ast, ["graph_id"]).collect()
    assert [(r.id, r.assigned) for r in got] == [("s", ["wanted"])]


NODE_HEAD = ":ID,:LABEL,NAME:string,FULL_NAME:string,FILENAME:string,LINE_NUMBER:int,LINE_NUMBER_END:int,CODE:string,METHOD_FULL_NAME:string,ARGUMENT_INDEX:int\n"


def write_graph(folder, checked):
    """parse() calls copy(); copy() calls memcpy on line 12, after a check where there is one."""
    folder.mkdir(parents=True)
    nodes = [
        "m1,METHOD,parse,parse,a.c,1,6,,,", "b1,BLOCK,,,,2,,,,", "c1,CALL,copy,,,4,,copy(p),copy,", "a1,IDENTIFIER,p,,,4,,p,,1",
        "m2,METHOD,copy,copy,a.c,10,20,,,", "b2,BLOCK,,,,10,,,,", "c2,CALL,memcpy,,,12,,,memcpy,", "a2,IDENTIFIER,q,,,12,,q,,1",
        "m3,METHOD,unused,unused,b.c,1,3,,,",
    ]
    edges = [("m1", "b1"), ("b1", "c1"), ("c1", "a1"), ("m2", "b2"), ("b2", "c2"), ("c2", "a2")]
    flows = [("m1", "c1", "CFG"), ("m2", "c2", "CFG"), ("c1", "m2", "CALL"), ("c1", "a1", "ARGUMENT")]
    if checked:
        nodes.append("r2,RETURN,,,,11,,return;,,")
        edges.insert(5, ("b2", "r2"))
        flows += [("m2", "r2", "CFG"), ("r2", "c2", "CFG")]
    (folder / "nodes_ALL_header.csv").write_text(NODE_HEAD)
    (folder / "nodes_ALL_data.csv").write_text("\n".join(nodes) + "\n")
    (folder / "edges_ALL_header.csv").write_text(":START_ID,:END_ID,:TYPE\n")
    (folder / "edges_ALL_data.csv").write_text("".join(f"{a},{b},AST\n" for a, b in edges) + "".join(f"{a},{b},{k}\n" for a, b, k in flows))
    (folder / ".complete").write_text("")


def test_whole_run(spark, tmp_path):
    """Queue, diffs and graphs on disk to an emitted dataset, its checks, and a second run that has nothing left to do."""
    write_graph(tmp_path / "graphs" / "old1", False)
    write_graph(tmp_path / "graphs" / "new1", True)
    (tmp_path / "diffs").mkdir()
    (tmp_path / "diffs" / "p1.diff").write_text("--- a/a.c\n+++ b/a.c\n@@ -10,2 +10,3 @@\n void copy()\n+  if (!q) return;\n   memcpy(q);\n")
    (tmp_path / "diffs" / "p3.diff").write_text("--- a/n.c\n+++ b/n.c\n@@ -1,1 +1,1 @@\n-x\n+y\n")
    entry = '{"patch_id": "%s", "repo_url": "u", "commit_vuln": "%s", "commit_fix": "%s", "cwes": ["CWE-120"], "extra_sinks": [["a.c", 4]]}\n'
    (tmp_path / "queue.jsonl").write_text(entry % ("p1", "old1", "new1") + entry % ("p2", "old1", "new1") + entry % ("p3", "old1", "new1"))
    args = (spark, str(tmp_path / "queue.jsonl"), str(tmp_path / "diffs"), str(tmp_path / "graphs"), str(tmp_path / "out"))
    row = build.run(*args, RunConfig(debug_samples=True)).first()
    assert (row.processed, row.skipped, row.samples) == (1, 2, 2)
    nodes = spark.read.json(str(tmp_path / "out" / "nodes")).collect()
    fixed = {r.function + ":" + str(r.line): r for r in nodes if r.version == "fixed"}
    assert set(fixed) == {"parse:1", "parse:4", "copy:10", "copy:11", "copy:12"}
    assert fixed["copy:12"].sink_reason == "cwe_api:memcpy" and fixed["parse:4"].sink_reason == "user" and fixed["copy:11"].label == fixed["copy:12"].label == 1
    assert fixed["parse:4"].role == "caller" and fixed["copy:11"].role == "patch" and fixed["copy:11"].distance_to_patch == 0 and fixed["copy:12"].distance_to_patch == 1
    assert fixed["parse:4"].CALL_edges == [fixed["copy:10"].id] == fixed["parse:4"].PARAM_BIND_edges and fixed["parse:4"].is_cross_function
    skipped = {(r.patch_id, r.version, r.stage) for r in spark.read.json(str(tmp_path / "out" / "skipped")).collect()}
    assert skipped == {("p2", None, "clone/fetch"), ("p3", "vulnerable", "step1"), ("p3", "fixed", "step1")}
    checks = {r.check: (r.value, r.is_red_flag) for r in build.check(spark, str(tmp_path / "out")).collect()}
    assert checks["missing_files"] == (0, False) and checks["nodes"] == (len(nodes), False) and checks["unresolved"] == (0, False) and checks["missing_fields"] == (0, False)
    assert not any(flag for _, flag in checks.values())
    assert {r.sample for r in spark.read.json(str(tmp_path / "out" / "sample_counts")).collect()} == {"p1__vulnerable", "p1__fixed"}
    again = build.run(*args).first()
    assert (again.processed, again.skipped) == (0, 2) and spark.read.json(str(tmp_path / "out" / "nodes")).count() == len(nodes)
    assert sorted(r.graph_id for r in files.complete_graphs(spark, str(tmp_path / "graphs")).collect()) == ["new1", "old1"]
    files.drop_graph(spark, str(tmp_path / "graphs"), "new1")
    assert [r.graph_id for r in files.complete_graphs(spark, str(tmp_path / "graphs")).collect()] == ["old1"]


def test_sinks_without_slices(spark, tmp_path, monkeypatch):
    """The sinks of a build are known from its statements: no edge is bound and no slice is walked for them."""
    write_graph(tmp_path / "graphs" / "old1", False)
    write_graph(tmp_path / "graphs" / "new1", True)
    entries = spark.createDataFrame([("p1", "old1", "new1", ["CWE-120"], [("a.c", 4)])], "patch_id string, commit_vuln string, commit_fix string, cwes array<string>, extra_sinks array<struct<file:string,line:int>>")
    diffs = spark.createDataFrame([("p1", "--- a/a.c\n+++ b/a.c\n@@ -10,2 +10,3 @@\n void copy()\n+  if (!q) return;\n   memcpy(q);\n")], "patch_id string, diff string")

    def unwanted(*args, **options):
        raise AssertionError("not needed for sinks")

    with monkeypatch.context() as m:
        m.setattr(slicing, "compute_slice", unwanted)
        m.setattr(program, "param_bindings", unwanted)
        data = build.build(entries, diffs, *files.load_cpgs(spark, str(tmp_path / "graphs")))
        m.setattr(cpg, "_built", lambda *_: data)
        got = rows(cpg.build_sinks(spark, ""))
    assert got == [("p1", v, *s) for v in ("fixed", "vulnerable") for s in (("copy", 12, "cwe_api:memcpy"), ("parse", 4, "user"))]
    assert got == rows(data.sinks.select(*KEYS, "function", "line", "sink_reason"))


def test_code_from_source(spark):
    nodes = spark.createDataFrame([("g", "m", "METHOD", "f", "m", 1), ("g", "b", "BLOCK", None, "m", 1), ("g", "r", "RETURN", None, "m", 3)], "graph_id string, id string, _label string, name string, owner string, lineNumber long")
    for c in ("fullName", "filename", "code", "controlStructureType"):
        nodes = nodes.withColumn(c, F.lit("a.c" if c == "filename" else None).cast("string"))
    nodes = nodes.withColumn("columnNumber", F.lit(None).cast("bigint"))
    edges = spark.createDataFrame([("g", "m", "b", "AST", 0), ("g", "b", "r", "AST", 0)], "graph_id string, src string, dst string, etype string, child_pos int")
    source = files.source_lines(spark.createDataFrame([("g", "a.c", "int f() {\r\n  x();\n  return 1;\n}")], "graph_id string, file string, text string"), keys=("graph_id",))
    stmts, _, _ = program.statement_graph(nodes, edges, lines=source)
    assert {r.nid: r.code for r in stmts.collect()} == {"m": "int f() {", "r": "return 1;"}


def test_catalogue_command(spark, tmp_path):
    with sqlite3.connect(tmp_path / "c.db") as con:
        con.execute("CREATE TABLE cve (cve_id TEXT)")
        con.execute("CREATE TABLE fixes (cve_id TEXT, hash TEXT, repo_url TEXT)")
        con.execute("CREATE TABLE commits (hash TEXT, parents TEXT, author_date TEXT)")
        con.execute("CREATE TABLE repository (repo_url TEXT, repo_language TEXT)")
        con.executemany("INSERT INTO fixes VALUES (?, ?, ?)", [("C1", "abcdef01", "https://github.com/a/b.git"), ("C2", "abcdef02", "https://github.com/evil/x"), ("C3", "abcdef03", "https://github.com/a/j"), ("C4", None, "u")])
        con.executemany("INSERT INTO commits VALUES (?, ?, ?)", [(f"abcdef0{i}", "['1234567']", "2020-01-01") for i in (1, 2, 3)])
        con.executemany("INSERT INTO repository VALUES (?, ?)", [("https://github.com/a/j", "Java"), ("https://github.com/a/b.git", None)])
    argv = ["ingest", "--db", str(tmp_path / "c.db"), "--out", str(tmp_path / "q"), "--ban", "evil/x"]
    assert command.main(argv) == 1  # a required table is missing
    with sqlite3.connect(tmp_path / "c.db") as con:
        con.execute("CREATE TABLE cwe_classification (cve_id TEXT, cwe_id TEXT)")
        con.executemany("INSERT INTO cwe_classification VALUES (?, ?)", [(f"C{i}", "CWE-120") for i in (1, 2, 3)])
    assert command.main(argv) == 0
    assert [(r.patch_id, r.commit_vuln, r.cwes) for r in files.read_queue(spark, str(tmp_path / "q")).collect()] == [("b/C1", "1234567", ["CWE-120"])]
    assert files.read_sqlite(spark, str(tmp_path / "c.db"), "commits", 2).count() == 3 and files.read_sqlite(spark, str(tmp_path / "c.db"), "cve").columns == ["cve_id"]


def test_follow_queue(spark, tmp_path):
    seen = []
    (tmp_path / "in").mkdir()
    line = '{"patch_id": "%s", "repo_url": "u", "commit_vuln": "a", "commit_fix": "b"}\n'
    for name in ("p1", "p2"):
        (tmp_path / "in" / f"{name}.json").write_text(line % name)
        queue.follow_queue(spark, str(tmp_path / "in"), str(tmp_path / "state"), lambda df, n: seen.append(sorted(r.patch_id for r in df.collect()))).awaitTermination()
    assert seen == [["p1"], ["p2"]]
