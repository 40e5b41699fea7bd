"""Decision trees on byte-binned columns: split rule, growth inside a task, prediction.

This module is the numerics of one task; ``strata/operators/ensembles.py`` spreads rows, trees and fits
over Spark.  Every sum that decides a split is an integer: bag counts by class for a forest, gradients and
hessians in units of ``1 / FIX`` for boosting.  So a histogram does not depend on the order in which
its parts were added, and a node is split alike in one task or from a distributed aggregate.

A column becomes at most ``BINS`` bins: bin i holds the values above edge i - 1 and up to edge i, and a split
"bin <= c" is the test "value <= edge c"."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 64
FIX = float(1 << 24)
UNLIMITED = 1 << 20
NO_NODE = -1
RUN = 1 << 17       # cells' keys that are summed at once
SMALL_TREE = 1 << 10    # nodes of a tree whose rows go down together
PAIRED = 8              # nodes at most whose columns are summed two at a time
LARGE = 1 << 11         # rows of a forest node that is summed on its own
STRIP = 1 << 16         # of these, rows summed at once
AGAIN = 8               # levels after which a tree's rows are copied in the order of their nodes
OF_0, OF_1 = (np.where(np.arange(256) % 4 == label, np.arange(256) >> 2, 0).astype(np.uint8) for label in (0, 1))    # of ``bagged``


@dataclass(frozen=True)
class Fit:
    """One model to grow.  ``group`` names its rows; a forest looks at ``features`` columns a split, a boosted
    model at a share of the columns a tree; ``weights`` are those of label 0 and 1."""
    group: int
    kind: str                       # "forest" or "boosted"
    trees: int
    max_depth: int = UNLIMITED
    min_split: int = 2
    min_leaf: int = 1
    features: int = 0               # forest: columns tried a split, 0 is the root of their number
    step: float = 0.3
    subsample: float = 1.0
    share: float = 1.0              # boosted: columns of a tree
    ridge: float = 1.0
    weights: tuple[float, float] = (1.0, 1.0)
    seed: int = 42
    columns: tuple[int, ...] | None = None      # of the written rows, all if None

    def seen(self, x: np.ndarray) -> np.ndarray:
        return x if self.columns is None else x[:, list(self.columns)]

    def width(self, columns: int) -> int:
        return columns if self.columns is None else len(self.columns)

    def tried(self, columns: int) -> int:
        return self.features or max(1, int(columns ** 0.5))


@dataclass
class Tree:
    """Nodes in arrays; the children of node i are ``left[i]`` and the one after it, a leaf has feature -1.
    ``a`` and ``b`` are a node's sums: bag counts of the labels, or gradient and hessian."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    a: np.ndarray
    b: np.ndarray
    n: np.ndarray
    depth: np.ndarray
    gain: np.ndarray

    TYPES = {"feature": "<i2", "cut": "u1", "left": "<i4", "a": "<i8", "b": "<i8", "n": "<i8", "depth": "<i4",
             "gain": "<f8"}

    def pack(self) -> dict[str, bytes]:
        return {k: np.ascontiguousarray(getattr(self, k), t).tobytes() for k, t in self.TYPES.items()}

    @classmethod
    def unpack(cls, row) -> Tree:
        return cls(**{k: np.frombuffer(row[k], t) for k, t in cls.TYPES.items()})

    def stopped(self, max_depth: int, min_split: int) -> np.ndarray:
        """The features of the tree that would have been grown to these limits: every split depends on its own
        node alone, so a smaller tree is this one cut off."""
        return np.where((self.depth < max_depth) & (self.n >= min_split), self.feature, -1)

    def ends(self, max_depth: int, min_split: int) -> np.ndarray:
        """For each node the one where a row that reaches it ends in the tree ``stopped`` so."""
        leaf, end = self.stopped(max_depth, min_split) < 0, np.arange(len(self.feature))
        inner = np.flatnonzero(self.feature >= 0)
        for depth in np.unique(self.depth[inner]):
            above = inner[self.depth[inner] == depth]
            cut = above[leaf[above] | (end[above] != above)]
            for child in (self.left[cut], self.left[cut] + 1):
                end[child] = end[cut]
        return end


def hung(top: Tree, node: int, below: Tree) -> Tree:
    """A part of a tree: what lies below a node of its top, behind the top's nodes, whose sums and gains are 0 here.  A
    row thus gets its value from one part of a tree and 0 from the others."""
    size, out = len(top.feature), {}
    for c in Tree.TYPES:
        v, w = np.array(getattr(top, c)), getattr(below, c)
        if c in ("a", "b", "gain"):
            v = np.zeros_like(v)
        if c == "left":
            w = np.where(w >= 0, w + size - 1, w)       # its root takes the node's place
        v[node] = w[0]
        out[c] = np.concatenate([v, w[1:]])
    return Tree(**out)


def joined(parts: list[tuple[int, dict]]) -> dict:
    """The node arrays of a whole tree from those of its parts, ascending; part n + 1 hangs at node n of part 0."""
    (_, top), *rest = parts
    size = held = len(top["left"])
    out = {c: [np.array(v)] for c, v in top.items()}
    for part, tree in rest:
        for c, v in tree.items():
            if c == "left":
                v = np.where(v >= held, v + size - held, v)
            out[c][0][part - 1] = v[part - 1]
            out[c].append(v[held:])
        size += len(tree["left"]) - held
    return {c: np.concatenate(v) for c, v in out.items()}


def descend(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The node that each row of ``x`` ends in."""
    if len(feature) <= SMALL_TREE and len(x):
        return _descend_together(feature, cut, left, x)
    at = np.zeros(len(x), np.int64)
    live = np.arange(len(x))
    while True:
        f = feature[at[live]]
        live, f = live[f >= 0], f[f >= 0]
        if not len(live):
            return at
        node = at[live]
        at[live] = left[node] + (x[live, f] > cut[node])


def _descend_together(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All rows go down a level at a time; a row stays in its leaf, as no bin lies above the leaf's cut."""
    leaf = feature < 0
    seen, down = np.where(leaf, 0, feature).astype(np.int64), np.where(leaf, np.arange(len(feature)), left).astype(np.int64)
    most = np.where(leaf, 255, cut).astype(np.uint8)
    flat, row = np.ascontiguousarray(x).reshape(-1), np.arange(len(x)) * x.shape[1]
    at = np.zeros(len(x), np.int64)
    while True:
        to = down.take(at)
        to += flat.take(row + seen.take(at)) > most.take(at)
        if np.array_equal(to, at):
            return at
        at = to


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit hash of 64-bit numbers."""
    h = h.astype(np.uint64)
    with np.errstate(over="ignore"):
        h = h + np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeded(seed: int, *numbers: int) -> np.uint64:
    h = np.array([seed], np.uint64)
    for n in numbers:
        h = mix(h ^ np.uint64(n))
    return mix(h)[0]


def uniform(key: np.ndarray, seed: np.uint64) -> np.ndarray:
    return (mix(key.view(np.uint64) ^ seed) >> np.uint64(11)) / float(1 << 53)


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))


def bag(key: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree (Poisson of mean 1), told by its key."""
    return np.searchsorted(_POISSON, uniform(key, seeded(seed, 1, tree)), "right")


def feature_order(path: np.ndarray, columns: int) -> np.ndarray:
    """For each node, given by the hash of its path, the columns in the order in which it tries them."""
    draws = mix(path[:, None] ^ mix(np.arange(columns, dtype=np.uint64))[None, :])
    return np.argsort(draws, axis=1)        # no two draws are equal, as ``mix`` has an inverse


def child_paths(path: np.ndarray) -> np.ndarray:
    """Left and right child of each path, side by side."""
    return np.stack([mix(path ^ np.uint64(2)), mix(path ^ np.uint64(3))], axis=1)


def root_path(seed: int, tree: int) -> np.ndarray:
    return np.array([seeded(seed, 2, tree)], np.uint64)


# --- forest: cells of (node, slot, bin) ----------------------------------------------
def cells(key: np.ndarray, sums: list[np.ndarray], span: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and the sums of each."""
    if span <= 8 * len(key):
        if len(sums) == 1:
            total = np.bincount(key, sums[0], span)
            some = np.flatnonzero(total)
            return some, unpacked(total[some])
        total = dense_cells(key, sums, span)
        some = np.flatnonzero(total[:, -1])
        return some, total[some]
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    if not len(first):
        return key, np.empty((0, 3), np.int64)
    if len(sums) == 1:
        return key[first], unpacked(np.add.reduceat(sums[0][order], first))
    return key[first], np.stack([np.add.reduceat(s[order].astype(np.int64), first) for s in sums], axis=1)


def packed(a: np.ndarray, b: np.ndarray, times: int) -> np.ndarray | None:
    """Bag counts of both labels and a one share the bits of a double, if every sum of ``times`` of each row is exact."""
    if times * len(a) >= 1 << 17 or times * max(a.sum(), b.sum()) >= 1 << 18:
        return None
    return a * float(1 << 35) + (b * float(1 << 17) + 1)


def unpacked(sums: np.ndarray) -> np.ndarray:
    sums = sums.astype(np.int64)
    out = np.empty((3, len(sums)), np.int64)
    out[0], out[1], out[2] = sums >> 35, sums >> 17 & (1 << 18) - 1, sums & (1 << 17) - 1
    return out.T        # a kind of sum lies together


def dense_cells(key: np.ndarray, sums: list[np.ndarray], span: int) -> np.ndarray:
    """(span, 3) sums of bag counts of both labels and of ones, or of the three as ``packed``."""
    if len(sums) == 1:
        return unpacked(np.bincount(key, sums[0], span))
    return np.stack([np.bincount(key, s, span) for s in sums], axis=1).astype(np.int64)


def forest_splits(key: np.ndarray, sums: np.ndarray, slots: int, fit: Fit):
    """The best cut of each node from its cells: (node, slot, bin, gain, left sums, right sums).  The purest
    pair of children wins, then the smaller slot, then the smaller bin; a cut needs ``min_leaf`` rows on either side."""
    run = key // BINS
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    kinds = [sums[:, c] for c in range(3)]
    shared = len(key) and max(k.sum() for k in kinds) < 1 << 21     # the three share the bits of a number
    left, right = [], []
    for some in [kinds[0] << 42 | kinds[1] << 21 | kinds[2]] if shared else kinds:
        upto = np.cumsum(some)
        base = np.where(starts > 0, upto[starts - 1], 0)
        right.append(np.repeat(upto[starts + sizes - 1], sizes) - upto)
        left.append(upto - np.repeat(base, sizes))
    if shared:
        low = (1 << 21) - 1
        some = np.flatnonzero(((left[0] & low) >= fit.min_leaf) & ((right[0] & low) >= fit.min_leaf))
        key, left, right = key[some], *([v >> 42, v >> 21 & low, v & low] for v in (left[0][some], right[0][some]))
    else:
        some = np.flatnonzero((left[2] >= fit.min_leaf) & (right[2] >= fit.min_leaf))
        key, left, right = key[some], [v[some] for v in left], [v[some] for v in right]
    node = key // (BINS * slots)
    if not len(key):
        return node, node, node, np.empty(0), np.stack(left, axis=1), np.stack(right, axis=1)

    def purity(s):
        p, q = s[0] * fit.weights[0], s[1] * fit.weights[1]
        return (p * p + q * q) / (p + q)

    score = purity(left) + purity(right)
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    top = np.maximum.reduceat(score, first)
    hit = np.flatnonzero(score == np.repeat(top, np.diff(np.r_[first, len(node)])))
    pick = hit[np.r_[True, node[hit][1:] != node[hit][:-1]]]
    left, right = (np.stack([v[pick] for v in side]) for side in (left, right))
    gain = score[pick] - purity(left + right)
    return node[pick], key[pick] // BINS % slots, key[pick] % BINS, gain, left.T, right.T


def splittable(a, b, n, depth, fit: Fit):
    """Whether a forest node is to be split: impure, large and not too deep."""
    return (a > 0) & (b > 0) & (n >= fit.min_split) & (depth < fit.max_depth)


def node_cells(x: np.ndarray, rows: np.ndarray, at: np.ndarray, tried: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Cells of the rows ``rows``, which lie in nodes ``at``; ``tried`` has a node's columns, one for each slot."""
    nodes, slots = tried.shape
    span, step = nodes * slots * BINS, max(1, RUN // slots)
    flat, width, offset = np.ascontiguousarray(x).reshape(-1), x.shape[1], np.arange(slots) * BINS

    def part(i: slice):
        key = tried.take(at[i], axis=0)
        key += (rows[i] * width)[:, None]
        key = flat.take(key).astype(np.int64)
        key += (at[i] * (slots * BINS))[:, None] + offset
        if (few := packed(a[i], b[i], slots)) is not None:
            return key.ravel(), [np.repeat(few, slots)]
        return key.ravel(), [np.repeat(a[i], slots), np.repeat(b[i], slots), np.ones(key.size, np.int64)]

    if len(rows) <= step or span > 8 * step * slots:
        return cells(*part(slice(None)), span)
    total = np.zeros((span, 3), np.int64)
    for lo in range(0, len(rows), step):
        total += dense_cells(*part(slice(lo, lo + step)), span)
    some = np.flatnonzero(total[:, -1])
    return some, total[some]


def large_node_cells(xt: np.ndarray, rows: np.ndarray, tried: np.ndarray, a: np.ndarray, b: np.ndarray):
    """``node_cells`` of a single node, column by column; ``xt`` has a row for each column.  Two columns are summed at once
    where their cells are far fewer than the rows."""
    total = np.zeros((len(tried), BINS, 3), np.int64)
    for lo in range(0, len(rows), STRIP):
        i = slice(lo, lo + STRIP)
        seen, few = some_rows(xt, tried, rows[i]), packed(a[i], b[i], 1)
        sums = [a[i], b[i], None] if few is None else [few]
        pairs = len(tried) // 2 * 2 if 3 * BINS * BINS <= seen.shape[1] else 0
        parts = np.empty((len(tried), BINS, len(sums)))
        for j in range(0, pairs, 2):
            both = seen[j] * np.uint16(BINS)
            both += seen[j + 1]
            both = both.astype(np.int64)
            for k, v in enumerate(sums):
                cell = np.bincount(both, v, BINS * BINS).reshape(BINS, BINS)
                parts[j, :, k], parts[j + 1, :, k] = cell.sum(axis=1), cell.sum(axis=0)
        for j in range(pairs, len(tried)):
            one = seen[j].astype(np.int64)
            for k, v in enumerate(sums):
                parts[j, :, k] = np.bincount(one, v, BINS)
        total += parts.astype(np.int64) if few is None else unpacked(parts.reshape(-1)).reshape(total.shape)
    total = total.reshape(-1, 3)
    some = np.flatnonzero(total[:, -1])
    return some, total[some]


def node_runs(sizes: np.ndarray, most: int, alone: int) -> list[tuple[int, int]]:
    """Stretches of nodes with about ``most`` rows together; a node of at least ``alone`` rows stands alone."""
    upto = np.cumsum(sizes)
    which, large = upto // most, sizes >= alone
    cut = np.flatnonzero((which[1:] != which[:-1]) | large[1:] | large[:-1]) + 1
    edges = [0, *cut.tolist(), len(sizes)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def bagged(key: np.ndarray, y: np.ndarray, seed: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows drawn for a tree, ascending, and for each a byte: how often it is drawn, and its label."""
    drawn = bag(key, seed, tree)
    rows = np.flatnonzero(drawn)
    return rows, coded(drawn[rows], y[rows])


def coded(drawn: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (drawn << 2 | np.minimum(y, 2)).astype(np.uint8)


def root_sums(code: np.ndarray) -> np.ndarray:
    kinds = np.bincount(code, minlength=256)
    return np.array([[kinds @ OF_0.astype(np.int64)], [kinds @ OF_1.astype(np.int64)], [len(code)]])


def grow_forest(x: np.ndarray, y: np.ndarray, key: np.ndarray, tree: int, fit: Fit, path: np.ndarray | None = None,
                depth: int = 0, xt: np.ndarray | None = None) -> Tree:
    """A tree of a forest, or what lies below a node of one, from the rows there."""
    return grow_drawn(x, *bagged(key, y, fit.seed, tree), fit, root_path(fit.seed, tree) if path is None else path, depth, xt)


def grow_drawn(x: np.ndarray, rows: np.ndarray, code: np.ndarray, fit: Fit, path: np.ndarray, depth: int = 0,
               xt: np.ndarray | None = None) -> Tree:
    """``grow_forest`` from what ``bagged`` tells and the path of the first node.  Rows stand in the order of their
    nodes, and the cells of a level are summed for a stretch of small nodes, or a large node, at a time.  ``xt`` is ``x`` with a
    row for each column, which the trees of a forest share."""
    x, slots = np.ascontiguousarray(x), fit.tried(x.shape[1])
    flat, width = x.reshape(-1), x.shape[1]
    xt = np.ascontiguousarray(x.T) if xt is None and len(rows) >= LARGE else xt
    cols = {k: [] for k in Tree.TYPES}
    sa, sb, sn = root_sums(code)
    size, nodes = 0, 1
    while nodes:
        sizes, starts = sn, np.r_[0, np.cumsum(sn)]
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        left, gain = np.full(nodes, NO_NODE), np.zeros(nodes)
        below = np.zeros((nodes, 2, 3), np.int64)
        todo = np.flatnonzero(splittable(sa, sb, sn, depth, fit))
        for some in (todo[lo:hi] for lo, hi in node_runs(sizes[todo], max(1, RUN // slots), LARGE) if hi > lo):
            order = feature_order(path[some], width)
            for lo in range(0, width, slots):      # a node without a cut tries the next columns
                if not len(some):
                    break
                tried = order[:, lo:lo + slots]
                if sizes[some[0]] >= LARGE:
                    mine = slice(starts[some[0]], starts[some[0] + 1])
                    told = large_node_cells(xt, rows[mine], tried[0], OF_0.take(code[mine]), OF_1.take(code[mine]))
                else:
                    at = np.repeat(np.arange(len(some)), sizes[some])
                    mine = np.arange(len(at)) + np.repeat(starts[some] - np.r_[0, np.cumsum(sizes[some])[:-1]], sizes[some])
                    seen = code[mine]
                    told = node_cells(x, rows[mine], at, tried, OF_0.take(seen), OF_1.take(seen))
                found = forest_splits(*told, tried.shape[1], fit)
                node = some[found[0]]
                feature[node], cut[node], gain[node] = tried[found[0], found[1]], found[2], found[3]
                below[node, 0], below[node, 1] = found[4], found[5]
                rest = np.ones(len(some), bool)
                rest[found[0]] = False
                some, order = some[rest], order[rest]
        inner = np.flatnonzero(feature >= 0)
        left[inner] = size + nodes + 2 * np.arange(len(inner))
        for k, v in zip(Tree.TYPES, (feature, cut, left, sa, sb, sn, np.full(nodes, depth), gain), strict=True):
            cols[k].append(v.astype(Tree.TYPES[k]))
        if len(inner) < nodes:
            live = np.repeat(feature >= 0, sizes)
            rows, code = rows[live], code[live]
        place = rows * width
        place += np.repeat(feature[inner], sizes[inner])
        right = flat.take(place) > np.repeat(cut[inner].astype(np.uint8), sizes[inner])
        lefts, rights = below[inner, 0, 2], below[inner, 1, 2]      # both children of a node take its place, their rows in order
        take = np.empty(len(rows), np.int64)
        for side, n, moved in ((~right, lefts, np.cumsum(rights) - rights), (right, rights, np.cumsum(lefts))):
            to = np.repeat(moved, n)
            to += np.arange(len(to))
            take[to] = np.flatnonzero(side)
        rows, code = rows[take], code[take]
        sa, sb, sn = below[inner].reshape(-1, 3).T
        if (depth + 1) % AGAIN == 0 and len(rows):      # rows of a node lie together again
            x, rows = x[rows], np.arange(len(rows))
            flat, xt = x.reshape(-1), np.ascontiguousarray(x.T) if sn.max() >= LARGE else None
        path = child_paths(path[inner]).ravel()
        size, nodes, depth = size + nodes, 2 * len(inner), depth + 1
    return Tree(**{k: np.concatenate(v) for k, v in cols.items()})


def grow_shallow(xt: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], tree: int, fit: Fit) -> Tree:
    """``grow_forest`` for few levels of many rows.  ``xt`` has a row for each column of the group; ``bags`` is what ``bagged``
    told of one strip of it after another, with rows of the whole ``xt``.  A strip is small enough to stay near the processor
    while its nodes are summed one by one, and beside these a task holds a few bytes a row."""
    strips = [(rows.copy(), code.copy()) for rows, code in bags]
    columns = np.arange(len(xt)) if fit.columns is None else np.array(fit.columns)
    slots, path = fit.tried(len(columns)), root_path(fit.seed, tree)
    cols = {k: [] for k in Tree.TYPES}
    sums, size, depth = sum(root_sums(code) for _, code in strips).T, 0, 0
    spans = [np.array([[0, len(rows)]]) for rows, _ in strips]       # where the rows of each node stand
    while len(sums):
        nodes = len(sums)
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        left, gain = np.full(nodes, NO_NODE), np.zeros(nodes)
        below = np.zeros((nodes, 2, 3), np.int64)
        todo = np.flatnonzero(splittable(*sums.T, depth, fit))
        order = feature_order(path[todo], len(columns))
        for lo in range(0, len(columns), slots):        # a node without a cut tries the next columns
            if not len(todo):
                break
            tried = order[:, lo:lo + slots]
            width = tried.shape[1]
            cells = np.zeros((len(todo), width * BINS, 3), np.int64)
            for (rows, code), span in zip(strips, spans, strict=True):
                for at, node in enumerate(todo):
                    mine = slice(*span[node])
                    own = code[mine]
                    some, told = large_node_cells(xt, rows[mine], columns[tried[at]], OF_0.take(own), OF_1.take(own))
                    cells[at, some] += told
            some = np.flatnonzero(cells[:, :, 2])
            found = forest_splits(some, cells.reshape(-1, 3)[some], width, fit)
            node = todo[found[0]]
            feature[node], cut[node], gain[node] = tried[found[0], found[1]], found[2], found[3]
            below[node, 0], below[node, 1] = found[4], found[5]
            rest = np.ones(len(todo), bool)
            rest[found[0]] = False
            todo, order = todo[rest], order[rest]
        inner = np.flatnonzero(feature >= 0)
        left[inner] = size + nodes + 2 * np.arange(len(inner))
        for k, v in zip(Tree.TYPES, (feature, cut, left, *sums.T, np.full(nodes, depth), gain), strict=True):
            cols[k].append(v.astype(Tree.TYPES[k]))
        sums, path = below[inner].reshape(-1, 3), child_paths(path[inner]).ravel()
        size, depth = size + nodes, depth + 1
        if splittable(*sums.T, depth, fit).any():
            spans = [_sides(xt, *strip, span[inner], columns[feature[inner]], cut[inner])
                     for strip, span in zip(strips, spans, strict=True)]
    return Tree(**{k: np.concatenate(v) for k, v in cols.items()})


def _sides(xt: np.ndarray, rows: np.ndarray, code: np.ndarray, span: np.ndarray, column: np.ndarray, cut: np.ndarray):
    """Puts the rows of each node in the order of its children, in place; where the children's stand."""
    out = np.empty((len(span), 2, 2), np.int64)
    for i, (lo, hi) in enumerate(span):
        here, own = rows[lo:hi], code[lo:hi]
        right = xt[column[i]].take(here) > cut[i]
        rows[lo:hi], code[lo:hi] = (np.concatenate([v[~right], v[right]]) for v in (here, own))
        middle = hi - np.count_nonzero(right)
        out[i] = (lo, middle), (middle, hi)
    return out.reshape(-1, 2)


# --- boosting: dense histograms of (column, node, bin) ---------------------------------
def gradients(margin: np.ndarray, y: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the log loss in units of 1 / FIX."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y == 1, fit.weights[1], fit.weights[0])
    return np.rint((p - y) * w * FIX), np.rint(np.maximum(p * (1.0 - p), 1e-16) * w * FIX)


def drawn_rows(key: np.ndarray, fit: Fit, tree: int) -> np.ndarray:
    if fit.subsample >= 1:
        return np.arange(len(key))
    return np.flatnonzero(uniform(key, seeded(fit.seed, 3, tree)) < fit.subsample)


def drawn_columns(columns: int, fit: Fit, tree: int) -> np.ndarray:
    """The columns of a tree, ascending: a share of all, at least one."""
    most = max(1, int(round(fit.share * columns)))
    draws = mix(np.arange(columns, dtype=np.uint64) ^ seeded(fit.seed, 4, tree))
    return np.sort(np.argsort(draws, kind="stable")[:most])


def some_rows(xt: np.ndarray, columns, rows: np.ndarray) -> np.ndarray:
    """The rows ``rows`` of some columns, where ``xt`` has a row for each column."""
    out = np.empty((len(columns), len(rows)), xt.dtype)
    for j, c in enumerate(columns):
        np.take(xt[c], rows, out=out[j], mode="clip")       # the other modes copy the result once more
    return out


def histograms(xt: np.ndarray, at: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, rows: bool = False) -> np.ndarray:
    """(2, column, node, bin) sums of whole numbers, exact below 2^53; ``xt`` has a row for each column.  With ``rows``
    a third kind of sum is the number of rows."""
    kinds = (g, h, None) if rows else (g, h)
    out = np.empty((len(kinds), len(xt), nodes, BINS))
    key, first, span = np.empty(len(at), np.int64), 0, nodes * BINS * BINS
    if nodes <= PAIRED and 3 * span <= len(at):      # two columns at once, where their cells are far fewer than the rows
        first = len(xt) // 2 * 2
        base, both = at * (BINS * BINS), np.empty(len(at), np.uint16)
        for j in range(0, first, 2):
            np.multiply(xt[j], BINS, out=both, dtype=np.uint16)
            both += xt[j + 1]
            np.add(base, both, out=key)
            for k, v in enumerate(kinds):
                cell = np.bincount(key, v, span).reshape(nodes, BINS, BINS)
                out[k, j], out[k, j + 1] = cell.sum(axis=2), cell.sum(axis=1)
    base = at * BINS
    for j in range(first, len(xt)):
        np.add(base, xt[j], out=key)
        for k, v in enumerate(kinds):
            out[k, j] = np.bincount(key, v, nodes * BINS).reshape(nodes, BINS)
    return out


def child_histograms(xt: np.ndarray, at: np.ndarray, above: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Histograms of both children of each node of ``above``: the smaller child is summed, its sibling is the rest."""
    pairs = above.shape[2]
    sizes = np.bincount(at, minlength=2 * pairs).reshape(pairs, 2)
    small = sizes.argmin(axis=1)
    mine = np.flatnonzero(at % 2 == small[at // 2])
    summed = histograms(some_rows(xt, range(len(xt)), mine), at[mine] // 2, pairs, g[mine], h[mine])
    out = np.empty((2, len(xt), 2 * pairs, BINS))
    one = 2 * np.arange(pairs)
    out[:, :, one + small] = summed
    out[:, :, one + 1 - small] = above - summed
    return out


def boosted_splits(hist: np.ndarray, fit: Fit):
    """For each node the best (column, bin, gain, left gradient, left hessian), column -1 without a gain."""
    left = np.cumsum(hist, axis=3)
    total = left[:, :1, :, -1:]
    right = total - left
    ridge = fit.ridge * FIX

    def score(s):
        return s[0] * s[0] / (s[1] + ridge) / FIX

    gain = 0.5 * (score(left) + score(right) - score(total))
    gain[(left[1] < FIX) | (right[1] < FIX)] = -np.inf       # a child has a hessian of 1 at least
    cuts = gain.argmax(axis=2)
    tops = np.take_along_axis(gain, cuts[:, :, None], 2)[:, :, 0]
    column = tops.argmax(axis=0)
    one = np.arange(hist.shape[2])
    top, cut = tops[column, one], cuts[column, one]
    return np.where(top > 1e-6, column, -1), cut, top, left[0, column, one, cut], left[1, column, one, cut]


def grow_boosted(x: np.ndarray, y: np.ndarray, key: np.ndarray, margin: np.ndarray, tree: int, fit: Fit) -> Tree:
    """The next tree of a boosted model, from the rows and their margins."""
    columns = drawn_columns(x.shape[1], fit, tree)
    rows = drawn_rows(key, fit, tree)
    g, h = gradients(margin[rows], y[rows], fit)
    xt = some_rows(x.T, columns, rows)
    at = np.zeros(len(rows), np.int64)
    cols = {k: [] for k in Tree.TYPES}
    size, nodes, depth, hist = 0, 1, 0, None
    while nodes:
        sg, sh = np.bincount(at, g, nodes), np.bincount(at, h, nodes)
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        left, gain = np.full(nodes, NO_NODE), np.zeros(nodes)
        if depth < fit.max_depth:
            hist = histograms(xt, at, nodes, g, h) if hist is None else child_histograms(xt, at, hist, g, h)
            feature, cut, gain, _, _ = boosted_splits(hist, fit)
        inner = np.flatnonzero(feature >= 0)
        left[inner] = size + nodes + 2 * np.arange(len(inner))
        told = np.where(feature >= 0, columns[feature], -1)
        for k, v in zip(Tree.TYPES, (told, cut, left, sg, sh, np.bincount(at, minlength=nodes), np.full(nodes, depth),
                                     np.where(feature >= 0, gain, 0.0)), strict=True):
            cols[k].append(v)
        live = np.flatnonzero(feature[at] >= 0)
        node = at[live]
        if len(live) < len(at):
            xt, g, h = some_rows(xt, range(len(xt)), live), g[live], h[live]
        at = left[node] - (size + nodes) + (xt[feature[node], np.arange(len(live))] > cut[node])
        hist = hist[:, :, inner] if hist is not None else None
        size, nodes, depth = size + nodes, 2 * len(inner), depth + 1
    return Tree(**{k: np.concatenate(v) for k, v in cols.items()})


def leaf_values(tree: Tree, fit: Fit) -> np.ndarray:
    """What a row that ends in each node gets: P(label 1) of a forest tree, the step of a boosted one."""
    if fit.kind == "forest":
        p, q = tree.a * fit.weights[0], tree.b * fit.weights[1]
        return q / np.maximum(p + q, 1e-300)
    return -fit.step * tree.a / (tree.b + fit.ridge * FIX)


def split_gains(tree: Tree, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """The gain and the number of a tree's splits by column."""
    inner = tree.feature >= 0
    return (np.bincount(tree.feature[inner], tree.gain[inner], columns),
            np.bincount(tree.feature[inner], minlength=columns).astype(float))


def shares(gains: list[tuple[np.ndarray, np.ndarray]], kind: str, columns: int) -> np.ndarray:
    """Shares of the columns from the ``split_gains`` of each tree: a forest's purity gains, each tree normed; a boosted
    model's mean gain of a split."""
    total, times = np.zeros(columns), np.zeros(columns)
    for gain, n in gains:
        if kind == "forest":
            gain = gain / gain.sum() if gain.sum() > 0 else gain
        total += gain
        times += n
    if kind == "boosted":
        total = total / np.maximum(times, 1)
    return total / total.sum() if total.sum() > 0 else total


def importances(trees: list[Tree], kind: str, columns: int) -> np.ndarray:
    return shares([split_gains(t, columns) for t in trees], kind, columns)


@dataclass
class TreeModel:
    """Grown trees with the edges of their bins."""
    kind: str
    edges: list[np.ndarray]
    features: list[np.ndarray]
    cuts: list[np.ndarray]
    lefts: list[np.ndarray]
    values: list[np.ndarray]
    importance: np.ndarray
    parts: dict = field(default_factory=dict, repr=False)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.edges)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """P(label 1) of rows of raw values."""
        seen = self.bins(x)
        total = np.zeros(len(x))
        for f, c, left, v in zip(self.features, self.cuts, self.lefts, self.values, strict=True):
            total += v[descend(f, c, left, seen)]
        return total / max(1, len(self.features)) if self.kind == "forest" else 1.0 / (1.0 + np.exp(-total))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], "left")
    return out
