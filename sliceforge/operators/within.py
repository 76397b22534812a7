"""Traversals inside one task: those that stay inside a method, and the owners of a graph of bounded size."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from sliceforge.runtime import materialize, ship
from sliceforge.schemas import BRANCHES, LOOPS, OPERATOR, SUB_EXPRESSIONS

#: Nearest ancestors that may hold a node's statement, and those that may be its loop or branch.
LIFT, NEST = 127, 64
_NAMES = ArrayType(StringType())
_FOUND = [
    ("marked", BooleanType(), pa.bool_()), ("found", StringType(), pa.string()), ("in_loop", BooleanType(), pa.bool_()), ("in_branch", BooleanType(), pa.bool_()),
    ("used", _NAMES, pa.list_(pa.string())), ("declared", _NAMES, pa.list_(pa.string())), ("assigned", _NAMES, pa.list_(pa.string())),
    ("depth_cfg", IntegerType(), pa.int32()), ("depth_ast", IntegerType(), pa.int32()),
]


def _depths(start: str, out: dict[str, list[str]]) -> dict[str, int]:
    depth, level = {start: 0}, [start]
    while level:
        nxt = []
        for x in level:
            for y in out.get(x, ()):
                if y not in depth:
                    depth[y] = depth[x] + 1
                    nxt.append(y)
        level = nxt
    return depth


def _written(root: str, down: dict[str, list], nodes: dict[str, tuple]) -> str | None:
    """The first identifier, in breadth-first order, under the first child."""
    level = [((), min(down[root])[2])] if down.get(root) else []
    seen: set[str] = set()
    while level:
        level = [(path, x) for path, x in level if x in nodes]
        hits = [(path, x) for path, x in level if nodes[x][0] == "IDENTIFIER"]
        if hits:
            return nodes[min(hits)[1]][1]
        seen.update(x for _, x in level)
        level = [((*path, c[:2]), c[2]) for path, x in level for c in down.get(x, ()) if c[2] not in seen]
    return None


def walk(owner: str, nodes: dict[str, tuple], tree: list[tuple], flow: list[tuple]) -> Iterator[tuple]:
    """nodes id -> (label, name, control), tree (src, dst, child_pos), flow (src, dst): a row of _FOUND's columns for each node."""
    parent: dict[str, str] = {}
    up, down, after = defaultdict(list), defaultdict(list), defaultdict(list)
    for a, b, pos in tree:
        if a > parent.get(b, ""):  # the last parent wins; the export has one
            parent[b] = a
        up[b].append(a)
        down[a].append((pos is not None, pos or 0, b))
    for a, b in flow:
        after[a].append(b)
    marked = {}
    for x, (label, _, _) in nodes.items():
        above = nodes.get(parent.get(x))
        marked[x] = label is not None and label not in SUB_EXPRESSIONS and (label in ("METHOD", "CONTROL_STRUCTURE", "RETURN") or (above is not None and above[0] == "BLOCK"))
    names = defaultdict(set)
    for x, (label, name, _) in nodes.items():
        if name and label in ("IDENTIFIER", "LOCAL"):
            names[label, name].add(x)
    held: dict[str, dict[str, set]] = {"IDENTIFIER": defaultdict(set), "LOCAL": defaultdict(set)}
    for (label, name), seen in names.items():  # a name climbs to all ancestors, past each node once
        todo = list(seen)
        while todo:
            x = todo.pop()
            if marked.get(x):
                held[label][x].add(name)
            for y in up.get(x, ()):
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
    cfg = _depths(owner, after)
    ast = _depths(owner, {a: [c[2] for c in cs] for a, cs in down.items()})
    for x, (label, name, _) in nodes.items():
        found, at = None, x
        for _ in range(LIFT + 1):
            if at is None or marked.get(at):
                found = at
                break
            at = parent.get(at)
        loop = branch = False
        at = parent.get(x)
        for _ in range(NEST):
            if at not in nodes:
                break
            kind, _, control = nodes[at]
            if kind == "CONTROL_STRUCTURE":
                loop, branch = loop or control in LOOPS, branch or control in BRANCHES
            at = parent.get(at)
        lhs = None
        if marked[x] and label == "CALL" and name and name.startswith(f"{OPERATOR}.assignment"):
            lhs = _written(x, down, nodes)
        yield x, marked[x], found, loop, branch, sorted(held["IDENTIFIER"].get(x, ())), sorted(held["LOCAL"].get(x, ())), [lhs] if lhs else None, cfg.get(x), ast.get(x)


def traits(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Scoped nodes (with owner) and edges (with owner, the one of both ends) -> (keys, id and _FOUND's columns), a row a node."""
    ship(nodes.sparkSession)
    none = F.lit(None).cast("string")
    # what: 0 a node, 1 a tree edge, 2 an edge of the control flow
    rows = nodes.select(*keys, "owner", F.lit(0).alias("what"), F.col("id").alias("a"), none.alias("b"), F.col("_label").alias("label"), "name", F.col("controlStructureType").alias("control"), F.lit(None).cast("long").alias("pos")).unionByName(
        edges.filter("etype IN ('AST', 'CFG')").select(*keys, "owner", F.when(F.col("etype") == "AST", 1).otherwise(2).alias("what"), F.col("src").alias("a"), F.col("dst").alias("b"), none.alias("label"), none.alias("name"), none.alias("control"), F.col("child_pos").cast("long").alias("pos"))
    )
    at = [*keys, "owner"]
    schema = StructType([*[nodes.schema[k] for k in keys], StructField("id", StringType()), *[StructField(n, t) for n, t, _ in _FOUND]])
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        own, held, tree, flow = None, {}, [], []
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        for batch in batches:
            types = types or [*[batch.schema.field(k).type for k in range(n)], pa.string(), *[t for _, _, t in _FOUND]]
            columns = [c.to_pylist() for c in batch.columns]
            for *key, what, a, b, label, name, control, pos in zip(*columns, strict=True):
                if key != own:
                    if own is not None:
                        out.extend((*own[:n], *row) for row in walk(own[n], held, tree, flow))
                        if len(out) >= 10_000:
                            yield packed()
                    own, held, tree, flow = key, {}, [], []
                if what == 0:
                    held[a] = (label, name, control)
                elif what == 1:
                    tree.append((a, b, pos))
                else:
                    flow.append((a, b))
        if own is not None:
            out.extend((*own[:n], *row) for row in walk(own[n], held, tree, flow))
        if out:
            yield packed()

    return materialize(rows.repartition(*at).sortWithinPartitions(*at).mapInArrow(run, schema), "traits")


#: Tasks over which whole graphs are dealt.
SPREAD = 64


def nearest(src: pa.Array, dst: pa.Array, claimers: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Arcs src -> dst of a graph -> the reached nodes and the owner of each: the smallest of its nearest claimers; no arc leads into one."""
    names = pa.concat_arrays([src, dst, claimers]).dictionary_encode()
    code, names = names.indices.to_numpy(), names.dictionary
    m = len(src)
    s, d, heads = code[:m], code[m : 2 * m], np.unique(code[2 * m :])
    heads = heads[pc.sort_indices(names.take(pa.array(heads))).to_numpy()]  # in the order of their names
    owner = np.full(len(names), -1)
    owner[heads] = np.arange(len(heads))
    go = owner[d] < 0
    s, d = s[go], d[go]
    order = np.argsort(s, kind="stable")
    d = d[order]
    first = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=len(names)))))
    level = heads
    while len(level):
        n = first[level + 1] - first[level]
        at = np.repeat(first[level] - np.cumsum(n) + n, n) + np.arange(n.sum())
        to, by = d[at], np.repeat(owner[level], n)
        fresh = owner[to] < 0
        to, by = to[fresh], by[fresh]
        order = np.lexsort((by, to))
        to, by = to[order], by[order]
        level, one = np.unique(to, return_index=True)
        owner[level] = by[one]
    met = np.flatnonzero(owner >= 0)
    return names.take(pa.array(met)), names.take(pa.array(heads[owner[met]]))


def owners(edges: DataFrame, claimers: DataFrame, keys: list[str]) -> DataFrame:
    """Arcs (keys, src, dst), claimers (keys, id) -> (keys, id, owner) as of nearest(); each graph meets in one task."""
    ship(edges.sparkSession)
    rows = edges.select(*keys, "src", "dst").unionByName(claimers.select(*keys, F.lit(None).cast("string").alias("src"), F.col("id").alias("dst"))).filter(" AND ".join(f"{k} IS NOT NULL" for k in [*keys, "dst"]))
    schema = StructType([*[edges.schema[k] for k in keys], StructField("id", StringType()), StructField("owner", StringType())])
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = None, []

        def done() -> Iterator[pa.RecordBatch]:
            whole = [pa.concat_arrays([p.column(c).cast(pa.large_string()) for p in parts]) for c in (n, n + 1)]
            arc = pc.is_valid(whole[0])
            ids, by = nearest(whole[0].filter(arc), whole[1].filter(arc), whole[1].filter(pc.invert(arc)))
            for lo in range(0, len(ids), 50_000):
                a, b = ids[lo : lo + 50_000].cast(pa.string()), by[lo : lo + 50_000].cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[pa.repeat(pa.scalar(k.as_py(), k.type), len(a)) for k in own], a, b], names=schema.names)

        for batch in batches:
            size = batch.num_rows
            turn = np.zeros(max(size - 1, 0), bool)
            for c in range(n):
                turn |= pc.not_equal(batch.column(c)[1:], batch.column(c)[:-1]).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(turn) + 1).tolist(), size]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                key = [batch.column(c)[lo] for c in range(n)]
                if own is not None and key != own:
                    yield from done()
                    parts = []
                own = key
                parts.append(batch.slice(lo, hi - lo))
        if own is not None:
            yield from done()

    return rows.repartition(SPREAD, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
