"""Forests and boosted trees for many fits over one set of written rows.

Rows are binned to bytes and written once, in blocks of one group (a fold, say).  All fits of all groups are
grown together from these blocks, in one of three ways with the same split rule on the same integers:

* a group that fits in a task (``local_bytes`` of binned rows) is sent to one task for each boosted fit and to
  several for a forest, which grow their trees there;
* many forests of few levels on a group of up to twice that, as the widths of a sweep are, go to a few tasks, which hold the
  group's columns once, draw a tree's rows once for all fits and grow them node by node;
* a larger one is never in one place.  Each pass over the blocks is one aggregate that returns the histograms of
  all open nodes of all fits, (fit, tree, node, column, bin); the best cut of each node, one row, comes to the driver,
  and the next pass routes rows by the trees so far.  Of a forest deeper than ``SHALLOW`` a node that has become small
  enough goes to one task and is finished there, a part of its tree; boosting writes its margins anew every
  ``WRITE_EVERY`` trees.

Draws of rows and columns are hashes of (seed, tree, row key or node path): a retried task, another partitioning and
the ways above give the same trees."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import trees as T
from strata.operators.trees import BINS, Fit, Tree, TreeModel
from strata.session import cut_lineage, drop_shuffles, drop_written, ship_package

LOCAL_BYTES = 1 << 26
FOREST_BYTES = 1 << 24      # of that, binned rows that one task holds of a shallow forest, or of a node of a larger group's forest
SHALLOW = 6                 # levels of a forest that are all grown by passes, without a shuffle of rows
MANY_TREES = 16             # shallow trees of a group for which its rows are sent to tasks
ROUTED_BYTES = 1 << 32      # of rows that are sent to the nodes of a larger group's forest at a time
MODEL_BYTES = 1 << 25       # nodes of a model that one process holds; a larger model stays in parts
PART_BYTES = 1 << 26        # nodes of the trees, and at half as many binned rows, that meet in a task
WRITE_EVERY = 8
NODES_A_PASS = 4096         # open nodes whose histograms a task holds at once
BLOCK = "grp int, n long, ones long, x binary, y binary, key binary"
TREES = "fit int, tree int, part int, " + ", ".join(f"`{c}` binary" for c in Tree.TYPES)


def _mapped(df: DataFrame, run, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def keyed_rows(df: DataFrame, x: F.Column, label: str, key: F.Column, group: F.Column) -> DataFrame:
    """``(grp, x, y, h)``: rows as the functions below take them; ``h`` tells rows apart for the draws."""
    return df.select(group.cast("int").alias("grp"), x.alias("x"), F.col(label).cast("int").alias("y"),
                     F.xxhash64(key, x, F.col(label).cast("int")).alias("h"))


def bin_edges(rows: DataFrame) -> dict[int, list[np.ndarray]]:
    """For each group and column at most ``BINS - 1`` edges, its quantiles; a bounded collect."""
    probs = F.array(*[F.lit((i + 1) / BINS) for i in range(BINS - 1)])
    long = rows.select("grp", F.posexplode("x").alias("c", "v")).where(~F.isnan("v"))
    got = long.groupBy("grp", "c").agg(F.percentile_approx("v", probs, F.lit(2000)).alias("e"), F.max("v").alias("top"))
    edges: dict[int, dict] = defaultdict(dict)
    for r in got.collect():
        e = np.unique(np.array(r["e"], float))
        edges[r["grp"]][r["c"]] = e[e < r["top"]]     # nothing lies above the largest value
    return {g: [by.get(c, np.empty(0)) for c in range(max(by) + 1)] for g, by in edges.items()}


def write_blocks(rows: DataFrame, edges: dict[int, list[np.ndarray]]) -> DataFrame:
    """The binned rows in blocks of one group, written once."""
    known = rows.sparkSession.sparkContext.broadcast(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grp, y, key = (batch.column(c).to_numpy() for c in ("grp", "y", "h"))
            width = np.diff(batch.column("x").offsets.to_numpy())
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(width)])
            for g in np.unique(grp):
                mine = np.flatnonzero(grp == g)
                d = int(width[mine[0]])
                seen = T.binned(flat[at[mine][:, None] + np.arange(d)[None, :]], known.value[int(g)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], pa.int32()), pa.array([len(mine)], pa.int64()),
                     pa.array([int(y[mine].sum())], pa.int64()),
                     *[pa.array([v.tobytes()], pa.binary()) for v in (seen, y[mine].astype(np.uint8), key[mine])]],
                    ["grp", "n", "ones", "x", "y", "key"])

    return cut_lineage(_mapped(rows.select("grp", "x", "y", "h"), run, BLOCK))


def _arrays(x: bytes, y: bytes, key: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y = np.frombuffer(y, np.uint8)
    return np.frombuffer(x, np.uint8).reshape(len(y), -1), y, np.frombuffer(key, np.int64)


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of several blocks."""
    parts = [_arrays(*(v.as_buffer() for v in row)) for row in
             zip(table["x"], table["y"], table["key"], strict=True)]
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _seen(block: np.ndarray, fit: Fit, views: dict) -> np.ndarray:
    """The fit's columns of a block, copied once for all its trees."""
    if fit.columns not in views:
        views.clear()
        views[fit.columns] = np.ascontiguousarray(fit.seen(block))
    return views[fit.columns]


def _bag(key: np.ndarray, fit: Fit, tree: int, bags: dict) -> np.ndarray:
    """The bag of a tree, drawn once for all fits of its seed."""
    if (fit.seed, tree) not in bags:
        bags[fit.seed, tree] = T.bag(key, fit.seed, tree).astype(np.uint8)
    return bags[fit.seed, tree]


def _tree_batch(rows: list[tuple[int, int, int, Tree]]) -> pa.Table:
    packed = [r[-1].pack() for r in rows]
    return pa.table([*[pa.array([r[c] for r in rows], pa.int32()) for c in range(3)],
                     *[pa.array([p[c] for p in packed], pa.binary()) for c in Tree.TYPES]], ["fit", "tree", "part", *Tree.TYPES])


def _boosted(x, y, key, fit: Fit) -> list[Tree]:
    margin, out, by_column = np.zeros(len(y)), [], np.asfortranarray(x)
    for t in range(fit.trees):
        tree = T.grow_boosted(by_column, y, key, margin, t, fit)
        margin += T.leaf_values(tree, fit)[T.descend(tree.feature, tree.cut, tree.left, x)]
        out.append(tree)
    return out


def _near(blocks: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """Each boosted fit, and each stretch of a forest, in one task."""
    spark = blocks.sparkSession
    cores = spark.sparkContext.defaultParallelism
    forest_trees = sum(f.trees for f in fits.values() if f.kind == "forest")
    stretch = max(1, -(-forest_trees // (4 * cores)))
    work = []
    for i, f in fits.items():
        step = stretch if f.kind == "forest" else f.trees
        work += [(i, lo, min(lo + step, f.trees)) for lo in range(0, f.trees, step)]
    work.sort(key=lambda w: -fits[w[0]].trees * min(fits[w[0]].max_depth, 30))      # the longest first
    known = spark.sparkContext.broadcast((fits, work))

    def run(table: pa.Table) -> pa.Table:
        plans, pieces = known.value
        i, lo, hi = pieces[table["work"][0].as_py()]
        x, y, key = _joined(table)
        x = np.ascontiguousarray(plans[i].seen(x))
        if plans[i].kind == "forest":
            xt = np.ascontiguousarray(x.T)
            return _tree_batch([(i, t, 0, T.grow_forest(x, y, key, t, plans[i], xt=xt)) for t in range(lo, hi)])
        return _tree_batch([(i, t, 0, tree) for t, tree in enumerate(_boosted(x, y, key, plans[i]))])

    ship_package(spark)
    todo = spark.createDataFrame([(w, fits[i].group) for w, (i, _, _) in enumerate(work)], "work int, grp int")
    return (blocks.join(F.broadcast(todo), "grp").repartitionByRange(len(work), "work").groupBy("work")
            .applyInArrow(run, TREES))


def _strips(sizes: list[int], most: int = 1 << 20) -> list[slice]:
    """Stretches of blocks with about ``most`` rows."""
    which = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(which[1:] != which[:-1]) + 1).tolist(), len(sizes)]
    return [slice(lo, hi) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]


def _shared(blocks: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """Shallow forests of middling groups: a task holds a group's columns and grows a stretch of the trees of all its fits."""
    spark = blocks.sparkSession
    groups: dict[int, list[int]] = defaultdict(list)
    for i, f in fits.items():
        groups[f.group].append(i)
    tasks = 3 * spark.sparkContext.defaultParallelism
    work = []
    for at, (g, mine) in enumerate(groups.items()):
        trees = max(fits[i].trees for i in mine)
        step = -(-trees // max(1, tasks // len(groups) + (at < tasks % len(groups))))
        work += [(g, lo, min(lo + step, trees)) for lo in range(0, trees, step)]
    known = spark.sparkContext.broadcast((fits, dict(groups), work))

    def run(table: pa.Table) -> pa.Table:
        plans, by_group, pieces = known.value
        g, lo, hi = pieces[table["work"][0].as_py()]
        ends = np.cumsum(table["n"].to_numpy())
        xt, parts = None, []
        for end, *raw in zip(ends, table["x"], table["y"], table["key"], strict=True):
            x, y, key = _arrays(*(v.as_buffer() for v in raw))
            xt = np.empty((x.shape[1], ends[-1]), np.uint8) if xt is None else xt
            xt[:, end - len(y):end] = x.T
            parts.append((end - len(y), y, key))
        strips = _strips([len(y) for _, y, _ in parts])
        out = []
        for t in range(lo, hi):
            bags: dict = {}
            for i in by_group[g]:
                fit = plans[i]
                if t < fit.trees:
                    if fit.seed not in bags:
                        drawn = [(at, *T.bagged(key, y, fit.seed, t)) for at, y, key in parts]
                        bags[fit.seed] = [(np.concatenate([rows + at for at, rows, _ in drawn[s]]).astype(np.int32),
                                           np.concatenate([code for *_, code in drawn[s]])) for s in strips]
                    out.append((i, t, 0, T.grow_shallow(xt, bags[fit.seed], t, fit)))
        return _tree_batch(out)

    ship_package(spark)
    todo = spark.createDataFrame([(w, g) for w, (g, *_) in enumerate(work)], "work int, grp int")
    return (blocks.join(F.broadcast(todo), "grp").repartitionByRange(len(work), "work").groupBy("work")
            .applyInArrow(run, TREES))


# --- groups that no task holds ---------------------------------------------------------
class _Top:
    """The part of a tree that is grown by passes over the blocks."""

    def __init__(self, path: np.uint64):
        self.cols = {c: [v] for c, v in zip(Tree.TYPES, (-1, 0, -1, 0, 0, 0, 0, 0.0), strict=True)}
        self.path, self.open, self.local = [path], {0: 0}, []       # open: node -> the columns it has tried in vain

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(self.cols[c], np.int64) for c in ("feature", "cut", "left"))

    def tree(self) -> Tree:
        return Tree(**{c: np.array(v) for c, v in self.cols.items()})

    def split(self, node: int, feature: int, cut: int, gain: float, left, right) -> list[int]:
        at = len(self.path)
        for c, v in (("feature", feature), ("cut", cut), ("left", at), ("gain", gain)):
            self.cols[c][node] = v
        paths = T.child_paths(np.array([self.path[node]], np.uint64))[0]
        for sums, path in zip((left, right), paths, strict=True):
            for c, v in zip(Tree.TYPES, (-1, 0, -1, *sums, self.cols["depth"][node] + 1, 0.0), strict=True):
                self.cols[c].append(v)
            self.path.append(path)
        return [at, at + 1]


SUMS = "fit int, tree int, node int, cell int, a long, b long, n long"


def _summed(found: DataFrame) -> DataFrame:
    return found.groupBy("fit", "tree", "node", "cell").agg(*[F.sum(c).alias(c) for c in ("a", "b", "n")])


def _emit(held: dict) -> pa.RecordBatch:
    """Rows of SUMS from {(fit, tree): (nodes, sums by node, cell and kind)}, empty cells left out."""
    cols: list[list] = [[] for _ in range(7)]
    for (fit, tree), (nodes, sums) in held.items():
        at, cell = np.nonzero(sums[:, :, 2])
        for c, v in zip(cols, (np.full(len(at), fit), np.full(len(at), tree), np.array(nodes)[at], cell,
                               *sums[at, cell].T), strict=True):
            c.append(v)
    kinds = [pa.int32()] * 4 + [pa.int64()] * 3
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], k) for c, k in zip(cols, kinds, strict=True)],
                                      ["fit", "tree", "node", "cell", "a", "b", "n"])


def forest_histograms(blocks: DataFrame, fits: dict[int, Fit], tops: dict, todo: dict) -> DataFrame:
    """One aggregate with the cells of all nodes in ``todo`` ((fit, tree) -> node -> columns tried in vain):
    cell is slot * BINS + bin, a and b the bag counts of label 0 and 1, n the rows."""
    plan = {ft: (*tops[ft].arrays(), list(nodes), np.array([tops[ft].path[n] for n in nodes], np.uint64),
                 list(nodes.values())) for ft, nodes in todo.items()}
    known = blocks.sparkSession.sparkContext.broadcast((fits, plan))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, work = known.value
        held: dict = {}
        for batch in batches:
            for grp, *raw in zip(*(batch.column(c) for c in ("grp", "x", "y", "key")), strict=True):
                block, y, key = _arrays(*(v.as_buffer() for v in raw))
                views, bags = {}, {}
                for (i, t), (feature, cut, left, nodes, path, vain) in work.items():
                    fit = models[i]
                    if fit.group != grp.as_py():
                        continue
                    x, drawn = _seen(block, fit, views), _bag(key, fit, t, bags)
                    slots = fit.tried(x.shape[1])
                    place = np.full(len(feature), -1)
                    place[nodes] = np.arange(len(nodes))
                    at = place[T.descend(feature, cut, left, x)]
                    rows = np.flatnonzero((drawn > 0) & (at >= 0))
                    order = T.feature_order(path, x.shape[1])
                    tried = np.stack([np.resize(o[v:v + slots], slots) for o, v in zip(order, vain, strict=True)])
                    k, s = T.node_cells(x, rows, at[rows], tried, drawn[rows] * (y[rows] == 0), drawn[rows] * (y[rows] == 1))
                    _, sums = held.setdefault((i, t), (nodes, np.zeros((len(nodes), slots * BINS, 3), np.int64)))
                    sums.reshape(-1, 3)[k] += s
        yield _emit(held)

    return _summed(_mapped(blocks, run, SUMS))


def _cuts(summed: DataFrame, fits: dict[int, Fit], slots: dict[int, int]) -> list:
    """The best cut of each node, and its sums; one row for each open node."""
    known = summed.sparkSession.sparkContext.broadcast((fits, slots))

    def run(table: pa.Table) -> pa.Table:
        i = table["fit"][0].as_py()
        fit, width = known.value[0][i], known.value[1][i]
        order = np.argsort(table["cell"].to_numpy())
        cell = table["cell"].to_numpy()[order].astype(np.int64)
        sums = np.stack([table[c].to_numpy()[order] for c in ("a", "b", "n")], axis=1)
        whole = sums[cell < BINS].sum(axis=0)
        _, slot, cut, gain, left, right = T.forest_splits(cell, sums, width, fit)
        found = [int(slot[0]), int(cut[0]), float(gain[0]), *left[0].tolist(), *right[0].tolist()] if len(slot) else \
            [-1, 0, 0.0, *whole.tolist(), 0, 0, 0]
        row = [i, table["tree"][0].as_py(), table["node"][0].as_py(), *found]
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    kinds = [pa.int32()] * 5 + [pa.float64()] + [pa.int64()] * 6
    names = ["fit", "tree", "node", "slot", "cut", "gain", "la", "lb", "ln", "ra", "rb", "rn"]
    return summed.groupBy("fit", "tree", "node").applyInArrow(
        run, "fit int, tree int, node int, slot int, cut int, gain double, la long, lb long, ln long, ra long, rb long, "
             "rn long").collect()


def _some(tops: dict, most: int) -> dict:
    """Open nodes of the next pass, at most ``most``."""
    todo: dict = {}
    for ft, top in tops.items():
        for node, vain in sorted(top.open.items()):
            if most <= 0:
                return todo
            todo.setdefault(ft, {})[node] = vain
            most -= 1
    return todo


def _far_forests(blocks: DataFrame, fits: dict[int, Fit], columns: dict[int, int], local_bytes: int) -> DataFrame:
    tops = {(i, t): _Top(T.root_path(f.seed, t)[0]) for i, f in fits.items() for t in range(f.trees)}
    widths = {i: f.width(columns[f.group]) for i, f in fits.items()}
    slots = {i: f.tried(widths[i]) for i, f in fits.items()}
    while todo := _some(tops, NODES_A_PASS):
        got = {(r["fit"], r["tree"], r["node"]): r for r in _cuts(forest_histograms(blocks, fits, tops, todo), fits, slots)}
        for (i, t), nodes in todo.items():
            fit, top, width = fits[i], tops[i, t], widths[i]
            for node, vain in nodes.items():
                r = got.get((i, t, node))
                del top.open[node]
                if r is None:
                    continue                    # no row was drawn
                left, right = (r["la"], r["lb"], r["ln"]), (r["ra"], r["rb"], r["rn"])
                whole = [p + q for p, q in zip(left, right, strict=True)]
                for c, v in zip(("a", "b", "n"), whole, strict=True):
                    top.cols[c][node] = v
                if not T.splittable(*whole, top.cols["depth"][node], fit):
                    continue
                if r["slot"] < 0:
                    if vain + slots[i] < width:
                        top.open[node] = vain + slots[i]
                    continue
                order = T.feature_order(np.array([top.path[node]], np.uint64), width)[0]
                tried = np.resize(order[vain:vain + slots[i]], slots[i])
                for child, sums in zip(top.split(node, int(tried[r["slot"]]), r["cut"], r["gain"], left, right),
                                       (left, right), strict=True):
                    if T.splittable(*sums, top.cols["depth"][child], fit):
                        if fit.max_depth > SHALLOW and sums[2] * (width + 9) <= local_bytes:
                            top.local.append(child)
                        else:
                            top.open[child] = 0
    return _finished(blocks, fits, tops, widths)


def _finished(blocks: DataFrame, fits: dict[int, Fit], tops: dict, widths: dict[int, int]) -> DataFrame:
    """The trees in parts: part 0 is a tree's top, part n + 1 what lies below its small node n, grown in one task (see
    ``T.hung``).  A row is as large as what one task grew, however large the tree.  The rows of a stretch of trees are on
    the move at a time, about ``ROUTED_BYTES`` or one tree's."""
    spark = blocks.sparkSession
    heads = {}
    for ft, top in tops.items():
        heads[ft] = top.tree()
        for c in ("a", "b"):
            heads[ft].__dict__[c][top.local] = 0      # these sums are those of the part below
    rows = [(i, t, 0, *[bytearray(v) for v in head.pack().values()]) for (i, t), head in heads.items()]
    whole = spark.createDataFrame(rows, TREES)
    if not any(top.local for top in tops.values()):
        return whole
    routed_bytes = {ft: sum(top.cols["n"][node] for node in top.local) * (widths[ft[0]] + 1) for ft, top in tops.items()}
    parts, some, held = [whole], [], 0
    for ft, top in tops.items():
        if some and held + routed_bytes[ft] > ROUTED_BYTES:
            parts.append(_below(blocks, fits, tops, heads, some))
            some, held = [], 0
        if top.local:
            some.append(ft)
            held += routed_bytes[ft]
    if len(parts) == 1:
        return whole.unionByName(_grown_below(blocks, fits, tops, heads, some))
    return reduce(DataFrame.unionByName, [*parts, _below(blocks, fits, tops, heads, some)])


def _below(blocks: DataFrame, fits: dict[int, Fit], tops: dict, heads: dict, some: list) -> DataFrame:
    """``_grown_below`` written, and the shuffled rows given back to the disk."""
    out = cut_lineage(_grown_below(blocks, fits, tops, heads, some))
    drop_shuffles(out.sparkSession)
    return out


def _grown_below(blocks: DataFrame, fits: dict[int, Fit], tops: dict, heads: dict, some: list) -> DataFrame:
    """What lies below the small nodes of some trees.  Of a row its bins travel, and how often it is drawn with its label."""
    known = blocks.sparkSession.sparkContext.broadcast((fits, {
        ft: (*tops[ft].arrays(), tops[ft].local, tops[ft].path, heads[ft]) for ft in some}))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, work = known.value
        for batch in batches:
            for grp, *raw in zip(*(batch.column(c) for c in ("grp", "x", "y", "key")), strict=True):
                block, y, key = _arrays(*(v.as_buffer() for v in raw))
                views, bags = {}, {}
                for (i, t), (feature, cut, left, local, *_) in work.items():
                    if models[i].group != grp.as_py():
                        continue
                    x = _seen(block, models[i], views)
                    drawn = _bag(key, models[i], t, bags)
                    at = T.descend(feature, cut, left, x)
                    at[drawn == 0] = -1
                    nodes = np.intersect1d(at, local)
                    parts = [np.flatnonzero(at == node) for node in nodes]
                    code = T.coded(drawn, y)
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(np.broadcast_to(v, len(nodes)), pa.int32()) for v in (i, t, nodes)],
                         *[pa.array([v[mine].tobytes() for mine in parts], pa.binary()) for v in (x, code)]],
                        ["fit", "tree", "node", "x", "code"])

    def finish(table: pa.Table) -> pa.Table:
        models, work = known.value
        i, t, node = (table[c][0].as_py() for c in ("fit", "tree", "node"))
        *_, path, head = work[i, t]
        code = np.concatenate([np.frombuffer(v.as_buffer(), np.uint8) for v in table["code"]])
        x = np.concatenate([np.frombuffer(v.as_buffer(), np.uint8) for v in table["x"]]).reshape(len(code), -1)
        below = T.grow_drawn(x, np.arange(len(code)), code, models[i], np.array([path[node]], np.uint64), int(head.depth[node]))
        return _tree_batch([(i, t, node + 1, T.hung(head, node, below))])

    routed = _mapped(blocks, route, "fit int, tree int, node int, x binary, code binary")
    return routed.groupBy("fit", "tree", "node").applyInArrow(finish, TREES)


PARTS = "fit int, node int, width int, sums binary"


def _boosted_parts(blocks: DataFrame, fits: dict[int, Fit], tops: dict, todo: dict, recent: dict, number: int,
                   order: dict[int, list[int]]) -> DataFrame:
    """What each task adds to the histograms of the open nodes, one row of ``PARTS`` a node: sums by drawn column, bin
    and kind, as whole numbers.  Few tasks take many blocks each, so that a node's parts are few."""
    spark = blocks.sparkSession
    plan = {i: (*tops[i, 0].arrays(), list(todo[i, 0])) for i, _ in todo}
    known = spark.sparkContext.broadcast((fits, plan, recent, order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, work, late, at_place = known.value
        held: dict = {}
        for batch in batches:
            for grp, m, *raw in zip(*(batch.column(c) for c in ("grp", "margin", "x", "y", "key")), strict=True):
                block, y, key = _arrays(*(v.as_buffer() for v in raw))
                margins = np.frombuffer(m.as_buffer(), np.float64).reshape(-1, len(y))
                for i, (feature, cut, left, nodes) in work.items():
                    fit = models[i]
                    if fit.group != grp.as_py():
                        continue
                    x = fit.seen(block)
                    width = x.shape[1]
                    margin = _with_recent(margins[at_place[fit.group].index(i)], late[i], fit, x)
                    place = np.full(len(feature), -1)
                    place[nodes] = np.arange(len(nodes))
                    at = place[T.descend(feature, cut, left, x)]
                    drawn = np.zeros(len(at), bool)
                    drawn[T.drawn_rows(key, fit, number)] = True
                    rows = np.flatnonzero(drawn & (at >= 0))
                    label = y
                    if len(rows) < len(at):
                        x, at, margin, label = x[rows], at[rows], margin[rows], y[rows]
                    xt = np.ascontiguousarray(x.T[T.drawn_columns(width, fit, number)])
                    _, sums = held.setdefault(i, (width, np.zeros((3, len(xt), len(nodes), BINS), np.int64)))
                    sums += T.histograms(xt, at, len(nodes), *T.gradients(margin, label, fit), rows=True).astype(np.int64)
        rows = [(i, node, width, sums[:, :, k].transpose(1, 2, 0).tobytes()) for i, (width, sums) in held.items()
                for k, node in enumerate(work[i][-1])]
        kinds = [pa.int32()] * 3 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)],
                                         ["fit", "node", "width", "sums"])

    return _mapped(blocks.coalesce(2 * spark.sparkContext.defaultParallelism), run, PARTS)


def _whole_sums(table: pa.Table, fit: Fit, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The drawn columns of a node and its (column, bin, kind) sums from its parts."""
    drawn = T.drawn_columns(table["width"][0].as_py(), fit, number)
    total = np.zeros(len(drawn) * BINS * 3, np.int64)
    for part in table["sums"]:
        total += np.frombuffer(part.as_buffer(), np.int64)
    return drawn, total.reshape(len(drawn), BINS, 3)


def boosted_histograms(blocks: DataFrame, fits: dict[int, Fit], tops: dict, todo: dict, recent: dict, number: int,
                       order: dict[int, list[int]]) -> DataFrame:
    """The cells of all open nodes of all fits: cell is column * BINS + bin, a and b the sums of
    gradient and hessian in units of 1 / FIX, n the rows.  Margins are those written and the ``recent`` trees'."""
    known = blocks.sparkSession.sparkContext.broadcast(fits)

    def run(table: pa.Table) -> pa.Table:
        i, node = table["fit"][0].as_py(), table["node"][0].as_py()
        drawn, sums = _whole_sums(table, known.value[i], number)
        whole = np.zeros((1, table["width"][0].as_py(), BINS, 3), np.int64)
        whole[0, drawn] = sums
        return pa.Table.from_batches([_emit({(i, number): ([node], whole.reshape(1, -1, 3))})])

    parts = _boosted_parts(blocks, fits, tops, todo, recent, number, order)
    return parts.groupBy("fit", "node").applyInArrow(run, SUMS)


def _with_recent(margin: np.ndarray, recent: list, fit: Fit, x: np.ndarray) -> np.ndarray:
    margin = margin.copy()
    for tree in recent:
        margin += T.leaf_values(tree, fit)[T.descend(tree.feature, tree.cut, tree.left, x)]
    return margin


def _boosted_cuts(parts: DataFrame, fits: dict[int, Fit], number: int) -> list:
    """The best cut of each node, and its sums; one row for each open node."""
    known = parts.sparkSession.sparkContext.broadcast(fits)

    def run(table: pa.Table) -> pa.Table:
        i = table["fit"][0].as_py()
        fit = known.value[i]
        drawn, sums = _whole_sums(table, fit, number)
        hist = sums.astype(np.float64).transpose(2, 0, 1)[:, :, None]
        column, cut, gain, lg, lh = (v[0] for v in T.boosted_splits(hist[:2], fit))
        a, b, n = sums[0].sum(axis=0)
        ln = sums[column, :cut + 1, 2].sum() if column >= 0 else 0
        found = [int(drawn[column]) if column >= 0 else -1, int(cut), float(gain), int(lg), int(lh), int(ln), int(a - lg),
                 int(b - lh), int(n - ln)] if column >= 0 else [-1, 0, 0.0, int(a), int(b), int(n), 0, 0, 0]
        row = [i, table["node"][0].as_py(), *found]
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.int64()] * 6
    names = ["fit", "node", "column", "cut", "gain", "la", "lb", "ln", "ra", "rb", "rn"]
    return parts.groupBy("fit", "node").applyInArrow(
        run, "fit int, node int, column int, cut int, gain double, la long, lb long, ln long, ra long, rb long, "
             "rn long").collect()


def with_margins(blocks: DataFrame, order: dict[int, list[int]]) -> DataFrame:
    """The blocks with a margin of 0 for each fit of their group."""
    sizes = F.coalesce(*[F.when(F.col("grp") == g, F.lit(8 * len(i))) for g, i in order.items()])
    return blocks.withColumn("margin", F.unhex(F.repeat(F.lit("00"), (sizes * F.col("n")).cast("int"))))


def _far_boosted(blocks: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    spark = blocks.sparkSession
    order = defaultdict(list)
    for i, f in fits.items():
        order[f.group].append(i)
    order = dict(order)
    state = with_margins(blocks.where(F.col("grp").isin(list(order))), order)
    done: dict[int, list[Tree]] = {i: [] for i in fits}
    written = 0
    for number in range(max(f.trees for f in fits.values())):
        live = {i: f for i, f in fits.items() if f.trees > number}
        tops = {(i, 0): _Top(np.uint64(0)) for i in live}
        recent = {i: done[i][written:] for i in fits}
        while todo := _some(tops, NODES_A_PASS):
            sums = _boosted_parts(state, fits, tops, todo, recent, number, order)
            got = {(r["fit"], r["node"]): r for r in _boosted_cuts(sums, fits, number)}
            for (i, _), nodes in todo.items():
                top = tops[i, 0]
                for node in nodes:
                    r = got.get((i, node))
                    del top.open[node]
                    if r is None:
                        continue
                    left, right = (r["la"], r["lb"], r["ln"]), (r["ra"], r["rb"], r["rn"])
                    for c, p, q in zip(("a", "b", "n"), left, right, strict=True):
                        top.cols[c][node] = p + q
                    if r["column"] >= 0:
                        for child in top.split(node, r["column"], r["cut"], r["gain"], left, right):
                            if top.cols["depth"][child] < live[i].max_depth:
                                top.open[child] = 0
        for i in live:
            done[i].append(tops[i, 0].tree())
        if number + 1 - written >= WRITE_EVERY:
            state = _margins_written(state, fits, {i: done[i][written:] for i in fits}, order)
            written = number + 1
    rows = [(i, t, 0, *[bytearray(v) for v in tree.pack().values()]) for i, some in done.items() for t, tree in enumerate(some)]
    return spark.createDataFrame(rows, TREES)


def _margins_written(state: DataFrame, fits: dict[int, Fit], recent: dict, order: dict) -> DataFrame:
    known = state.sparkSession.sparkContext.broadcast((fits, recent, order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, late, at_place = known.value
        for batch in batches:
            out = []
            for grp, m, *raw in zip(*(batch.column(c) for c in ("grp", "margin", "x", "y", "key")), strict=True):
                x, y, _ = _arrays(*(v.as_buffer() for v in raw))
                margins = np.frombuffer(m.as_buffer(), np.float64).reshape(-1, len(y))
                out.append(b"".join(_with_recent(one, late[i], models[i], models[i].seen(x)).tobytes()
                                    for one, i in zip(margins, at_place[grp.as_py()], strict=True)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("grp", "n", "ones", "x", "y", "key")),
                                              pa.array(out, pa.binary())], ["grp", "n", "ones", "x", "y", "key", "margin"])

    return cut_lineage(_mapped(state, run, BLOCK + ", margin binary"))


# --- models that no process holds ------------------------------------------------------
NODES = "tree int, part int, feature binary, cut binary, `left` binary, value binary"
NODE_KINDS = ("<i2", "u1", "<i4", "<f8")
NODE_BYTES = 15


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows one by one."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def node_bytes(trees: DataFrame) -> int:
    """What the nodes of the trees take in a model."""
    return NODE_BYTES * (trees.agg(F.sum(F.length("cut"))).first()[0] or 0)


def _tree_gains(rows: list, *names: str) -> dict:
    """``T.split_gains`` of whole trees, in the order of their ``names``, from those of their parts."""
    out: dict = {}
    for r in sorted(rows, key=lambda r: (*(r[c] for c in names), r["part"])):
        at = tuple(r[c] for c in names)
        some = np.array(r["gain"]), np.array(r["times"])
        out[at] = tuple(p + q for p, q in zip(out[at], some, strict=True)) if at in out else some
    return out


@dataclass
class SpreadModel:
    """Grown trees that stay where they lie, one row of ``NODES`` a part of a tree, with the edges of their bins."""
    kind: str
    edges: list[np.ndarray]
    trees: DataFrame
    importance: np.ndarray

    def scores(self, rows: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
        """(row, p) of ``rows(row long, x array<double>)``.

        Trees stand in stretches of at most ``part_bytes`` of nodes (or one part of a tree) and blocks of binned rows in bundles.
        Each stretch meets each bundle in one group, whose sums for a block of rows meet in the next."""
        spark, edges, kind = rows.sparkSession, self.edges, self.kind
        sizes = self.trees.select("tree", "part", F.length("cut").alias("n")).orderBy("tree", "part").collect()
        places, held = [], part_bytes + 1
        for r in sizes:
            held += NODE_BYTES * r["n"]
            if held > part_bytes:
                held = NODE_BYTES * r["n"]
                places.append((r["tree"], r["part"], places[-1][2] + 1 if places else 0))
            else:
                places.append((r["tree"], r["part"], places[-1][2]))
        stretches, grown_trees = places[-1][2] + 1, len({r["tree"] for r in sizes})

        def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.num_rows], pa.int64()),
                         pa.array([batch.column("row").to_numpy().tobytes()], pa.binary()),
                         pa.array([T.binned(x, edges).tobytes()], pa.binary())], ["n", "ids", "x"])

        blocks = _mapped(rows.select("row", "x"), bins, "n long, ids binary, x binary")
        blocks = cut_lineage(blocks.withColumn("block", F.monotonically_increasing_id()))
        count, several = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        cores = spark.sparkContext.defaultParallelism
        bundles = max(1, min(several, max(2 * count * len(edges) // part_bytes + 1, -(-2 * cores // stretches))))
        at = spark.createDataFrame(places, "tree int, part int, stretch int")
        every = F.sequence(F.lit(0), F.lit(bundles - 1))
        trees = self.trees.join(F.broadcast(at), ["tree", "part"]).withColumn("bundle", F.explode(every))
        data = blocks.select("block", "ids", "x", F.pmod(F.xxhash64("block"), F.lit(bundles)).cast("int").alias("bundle"),
                             F.explode(F.sequence(F.lit(0), F.lit(stretches - 1))).alias("stretch"))

        def part(some: pa.Table, grown: pa.Table) -> pa.Table:
            out: list[list] = [[], [], [], []]
            if some.num_rows and grown.num_rows:
                stretch = some["stretch"][0].as_py()
                grown = grown.sort_by([("tree", "ascending"), ("part", "ascending")])
                models = [[np.frombuffer(v.as_buffer(), k) for v, k in zip(row, NODE_KINDS, strict=True)] for row in
                          zip(*(grown[c] for c in ("feature", "cut", "left", "value")), strict=True)]
                for block, ids, x in zip(some["block"], some["ids"], some["x"], strict=True):
                    seen = np.frombuffer(x.as_buffer(), np.uint8).reshape(len(ids.as_buffer()) // 8, -1)
                    total = np.zeros(len(seen))
                    for feature, cut, left, value in models:
                        total += value[T.descend(feature, cut, left, seen)]
                    for c, v in zip(out, (block.as_py(), stretch, total.tobytes(), b"" if stretch else ids.as_py()),
                                    strict=True):
                        c.append(v)
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["block", "stretch", "total", "ids"])

        def whole(table: pa.Table) -> pa.Table:
            table = table.sort_by("stretch")
            total = sum(np.frombuffer(t.as_buffer(), np.float64) for t in table["total"])
            p = total / max(1, grown_trees) if kind == "forest" else 1.0 / (1.0 + np.exp(-total))
            return pa.table([pa.array(np.frombuffer(table["ids"][0].as_buffer(), np.int64)), pa.array(p)], ["row", "p"])

        groups = [F.col("stretch"), F.col("bundle")]
        data, trees = (d.repartition(stretches * bundles, *groups).groupBy(*groups) for d in (data, trees))
        sums = data.cogroup(trees).applyInArrow(part, "block long, stretch int, total binary, ids binary")
        return sums.groupBy("block").applyInArrow(whole, "row long, p double")


# --- entry points --------------------------------------------------------------------
@dataclass
class Grown:
    """Trees ``(fit, tree, part, node arrays)`` of several fits, written once, and the edges of each group."""
    trees: DataFrame
    fits: list[Fit]
    edges: dict[int, list[np.ndarray]] = field(repr=False)

    def of(self, fit: int) -> list[Tree]:
        parts = defaultdict(list)
        for r in self.trees.where(F.col("fit") == fit).orderBy("tree", "part").collect():
            parts[r["tree"]].append((r["part"], Tree.unpack(r).__dict__))
        return [Tree(**T.joined(some)) for some in parts.values()]

    def _edges(self, fit: int) -> list[np.ndarray]:
        plan = self.fits[fit]
        all_columns = self.edges[plan.group]
        return all_columns if plan.columns is None else [all_columns[c] for c in plan.columns]

    def model(self, fit: int, max_depth: int = T.UNLIMITED, min_split: int = 2, trees: int | None = None,
              model_bytes: int = MODEL_BYTES) -> TreeModel | SpreadModel:
        """One fit as a model; with smaller limits, the model that those would have grown.  A large one stays spread."""
        plan, edges = self.fits[fit], self._edges(fit)
        mine = self.trees.where((F.col("fit") == fit) & (F.col("tree") < (plan.trees if trees is None else trees)))
        if node_bytes(mine) > model_bytes:
            return self._spread(mine, plan, edges, max_depth, min_split)
        some = self.of(fit)[:trees]
        used = [t.stopped(max_depth, min_split) for t in some]
        return TreeModel(plan.kind, edges, used, [t.cut for t in some], [t.left for t in some],
                         [T.leaf_values(t, plan) for t in some],
                         T.importances([Tree(**{**t.__dict__, "feature": u}) for t, u in zip(some, used, strict=True)],
                                       plan.kind, len(edges)))

    @staticmethod
    def _spread(mine: DataFrame, plan: Fit, edges: list[np.ndarray], max_depth: int, min_split: int) -> SpreadModel:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                tree = Tree.unpack(row)
                used = tree.stopped(max_depth, min_split)
                gain, times = T.split_gains(Tree(**{**tree.__dict__, "feature": used}), len(edges))
                parts = zip((used, tree.cut, tree.left, T.leaf_values(tree, plan)), NODE_KINDS, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([row[c]], pa.int32()) for c in ("tree", "part")],
                     *[pa.array([np.ascontiguousarray(v, k).tobytes()], pa.binary()) for v, k in parts],
                     *[pa.array([v.tolist()], pa.list_(pa.float64())) for v in (gain, times)]],
                    ["tree", "part", "feature", "cut", "left", "value", "gain", "times"])

        nodes = cut_lineage(_mapped(mine, run, NODES + ", gain array<double>, times array<double>"))
        gains = nodes.select("tree", "part", "gain", "times").collect()     # a row a part, two numbers a column
        share = T.shares(list(_tree_gains(gains, "tree").values()), plan.kind, len(edges))
        return SpreadModel(plan.kind, edges, nodes.drop("gain", "times"), share)

    def importances(self) -> dict[int, np.ndarray]:
        """Shares of the columns for each fit, from the trees where they lie; a collect of one row a part of a tree."""
        fits, widths = self.fits, [len(self._edges(i)) for i in range(len(self.fits))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                gain, times = T.split_gains(Tree.unpack(row), widths[row["fit"]])
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([row[c]], pa.int32()) for c in ("fit", "tree", "part")],
                     *[pa.array([v.tolist()], pa.list_(pa.float64())) for v in (gain, times)]],
                    ["fit", "tree", "part", "gain", "times"])

        by_fit: dict[int, list] = defaultdict(list)
        got = _mapped(self.trees, run, "fit int, tree int, part int, gain array<double>, times array<double>").collect()
        for (i, _), some in _tree_gains(got, "fit", "tree").items():
            by_fit[i].append(some)
        return {i: T.shares(some, fits[i].kind, widths[i]) for i, some in by_fit.items()}


@dataclass
class Binned:
    """Rows binned and written once, for any number of fits."""
    blocks: DataFrame
    edges: dict[int, list[np.ndarray]]
    sizes: dict[int, tuple[int, int]]       # rows of label 0 and 1

    def balanced(self, group: int) -> tuple[float, float]:
        """n / (2 n_c) for either label."""
        return tuple(sum(self.sizes[group]) / (2.0 * n) if n else 1.0 for n in self.sizes[group])


def bin_rows(rows: DataFrame, written: bool = False) -> Binned:
    """``rows(grp, x, y, h)`` (see ``keyed_rows``) in blocks; rows without a label take no part.  They are read twice, so
    they are written first unless they are a projection of ``written`` ones."""
    rows = rows.where(F.col("y").isNotNull())
    if not written:
        rows = cut_lineage(rows)
    edges = bin_edges(rows)
    blocks = write_blocks(rows, edges)
    if not written:
        drop_written(rows)
    sizes = {r["grp"]: (r["n"] - r["ones"], r["ones"]) for r in blocks.groupBy("grp").agg(
        F.sum("n").alias("n"), F.sum("ones").alias("ones")).collect()}
    return Binned(blocks, edges, sizes)


def grow(rows: DataFrame | Binned, fits: list[Fit], local_bytes: int = LOCAL_BYTES) -> Grown:
    """All ``fits`` on rows as ``bin_rows`` takes or returns them."""
    data = rows if isinstance(rows, Binned) else bin_rows(rows)
    blocks, edges, sizes = data.blocks, data.edges, data.sizes
    columns = {g: len(e) for g, e in edges.items()}
    near, shared, forests, boosted = {}, {}, {}, {}
    shallow = {i: f for i, f in enumerate(fits) if f.kind == "forest" and f.max_depth <= SHALLOW}
    many = defaultdict(int)
    for f in shallow.values():
        many[f.group] += f.trees
    for i, f in enumerate(fits):
        if f.group not in sizes:
            raise ValueError(f"fit {i} has no rows")
        held = sum(sizes[f.group]) * (columns[f.group] + 9)
        if held <= (min(local_bytes, FOREST_BYTES) if i in shallow else local_bytes):
            near[i] = f
        elif i in shallow and many[f.group] >= MANY_TREES and held <= 2 * local_bytes:
            shared[i] = f
        else:
            (forests if f.kind == "forest" else boosted)[i] = f
    parts = []
    if near:
        parts.append(_near(blocks, near))
    if shared:
        parts.append(_shared(blocks, shared))
    if forests:
        parts.append(_far_forests(blocks, forests, columns, min(local_bytes, FOREST_BYTES)))
    if boosted:
        parts.append(_far_boosted(blocks, boosted))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return Grown(cut_lineage(found), list(fits), edges)


def held_confusion(grown: Grown, held: DataFrame, variants: list[tuple[int, int, int, int]]) -> dict[int, tuple[int, int, int]]:
    """(true positives, false positives, false negatives) at P >= 0.5 of each variant ``(fit, trees, max_depth,
    min_split)`` on the rows ``held(grp, x, y, h)`` of its fit's group.

    The model stays where it lies: each stretch of a fit's trees meets each block of the group's rows in one task,
    and the stretches' sums for a block meet in the next."""
    spark = held.sparkSession
    blocks = write_blocks(held, grown.edges).withColumn("block", F.monotonically_increasing_id())
    blocks = cut_lineage(blocks.drop("key"))
    fits = grown.fits
    asked = defaultdict(list)
    for v, (i, *_) in enumerate(variants):
        asked[i].append(v)
    pieces = max(1, min(8, 64 // len(asked)))        # each stretch gets the rows, so many fits have few
    stretch = {i: max(1, -(-f.trees // pieces)) if f.kind == "forest" else f.trees for i, f in enumerate(fits)}
    parts = [(i, s, fits[i].group) for i in asked for s in range(-(-fits[i].trees // stretch[i]))]
    work = spark.createDataFrame([(w, i, s, g) for w, (i, s, g) in enumerate(parts)], "work int, fit int, stretch int, grp int")
    place = {(i, s): w for w, (i, s, _) in enumerate(parts)}
    pairs = spark.createDataFrame([(i, t, place[i, t // stretch[i]]) for i in asked for t in range(fits[i].trees)],
                                  "fit int, tree int, work int")

    def part(rows: pa.Table, some: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if rows.num_rows and some.num_rows:
            i = some["fit"][0].as_py()
            grown_here = []     # a row goes down a tree once, and each limit has its own values by node
            for r in some.sort_by([("tree", "ascending"), ("part", "ascending")]).to_pylist():
                tree = Tree.unpack(r)
                value = T.leaf_values(tree, fits[i])
                limits = {variants[v][2:] for v in asked[i] if r["tree"] < variants[v][1]}
                grown_here.append((r["tree"], tree, {limit: value[tree.ends(*limit)] for limit in limits}))
            for block, x, y in zip(rows["block"], rows["x"], rows["y"], strict=True):
                seen = fits[i].seen(np.frombuffer(x.as_buffer(), np.uint8).reshape(len(y.as_buffer()), -1))
                totals = {v: np.zeros(len(seen)) for v in asked[i]}
                for t, tree, values in grown_here:
                    at = T.descend(tree.feature, tree.cut, tree.left, seen) if values else None
                    for v, total in totals.items():
                        if t < variants[v][1]:
                            total += values[variants[v][2:]][at]
                for v, total in totals.items():
                    for c, val in zip(out, (v, block.as_py(), some["work"][0].as_py(), total.tobytes(), y.as_py()), strict=True):
                        c.append(val)
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["variant", "block", "work", "total", "y"])

    def counted(table: pa.Table) -> pa.Table:
        table = table.sort_by("work")
        v = table["variant"][0].as_py()
        i, n_trees, *_ = variants[v]
        total = sum(np.frombuffer(t.as_buffer(), np.float64) for t in table["total"])
        y = np.frombuffer(table["y"][0].as_buffer(), np.uint8)
        said = total / n_trees >= 0.5 if fits[i].kind == "forest" else total >= 0
        row = [v, int((said & (y == 1)).sum()), int((said & (y == 0)).sum()), int((~said & (y == 1)).sum())]
        return pa.table([pa.array([r], k) for r, k in zip(row, [pa.int32()] + [pa.int64()] * 3, strict=True)],
                        ["variant", "tp", "fp", "fn"])

    ship_package(spark)
    rows = blocks.join(F.broadcast(work), "grp").select("work", "block", "x", "y")
    grown_trees = grown.trees.join(F.broadcast(pairs), ["fit", "tree"])
    # several partitions for each stretch, so that few of them meet in one
    rows, grown_trees = (d.repartition(max(1, 4 * len(parts)), "work").groupBy("work") for d in (rows, grown_trees))
    sums = rows.cogroup(grown_trees).applyInArrow(part, "variant int, block long, work int, total binary, y binary")
    counts = sums.groupBy("variant", "block").applyInArrow(counted, "variant int, tp long, fp long, fn long")
    got = counts.groupBy("variant").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).collect()
    return {r["variant"]: (r["tp"], r["fp"], r["fn"]) for r in got}


def scored(model: TreeModel, spark: SparkSession):
    """P(label 1) as a function of an array<double> column.  The model goes to every worker, as any served model."""
    ship_package(spark)
    known = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.float64())
        flat = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        return pa.array(known.value.probability(flat))

    return probability
