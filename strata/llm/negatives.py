"""Hard negatives from blocked Strassen products (operator 12).

Rows lie in blocks of candidates, anchors in blocks of their own; a pair of blocks is
one task's work, cut into tiles whose int64 product is formed by Strassen's
recursion: seven half-sized products instead of eight, odd sides padded with a zero
row or column, all sums in integers, so every score is exact.

1. Positives: inside a pair of blocks only rows of one label meet.  Each anchor
   keeps a heap of its best ``positives`` rows; the heaps of all pairs of blocks
   meet in a ranking of that many rows per anchor and block.
2. Windows: each anchor carries the scores of its positives.  A tile of all labels
   fills one heap of ``negatives`` rows for each anchor and distinct score, of the rows of
   other labels inside that score's window; these heaps are merged the same way.

A heap is the sorted head of its candidates; merging two is sorting the two heads.
What a task holds is bounded by the block sizes, what is shuffled by the copies of a row for each
block of anchors; a hot label is spread over all blocks, as rows are dealt by their place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut_lineage, ship_package

EVERY, SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 50, 256, 5, 3, 50, 95
ANCHOR_BLOCK, BLOCK, TILE, LEAF = 4096, 16384, (256, 4096), 16


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices; exact where it fits 64 bits, as all sums wrap alike."""
    (m, k), p = a.shape, b.shape[1]
    if min(m, k, p) <= leaf:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or p % 2:
        b = np.pad(b, ((0, k % 2), (0, p % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    out = np.empty((2 * i, 2 * l), np.int64)
    c11, c12, c21, c22 = out[:i, :l], out[:i, l:], out[i:, :l], out[i:, l:]
    c11[:] = c22[:] = strassen(a11 + a22, b11 + b22, leaf)
    c21[:] = part = strassen(a21 + a22, b11, leaf)
    c22 -= part
    c12[:] = part = strassen(a11, b12 - b22, leaf)
    c22 += part
    part = strassen(a22, b21 - b11, leaf)
    c11 += part
    c21 += part
    part = strassen(a11 + a12, b22, leaf)
    c11 -= part
    c12 += part
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :p]


def _heads(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among their owner's k best, by score and then the smaller id, in that order."""
    order = np.lexsort((ids, -score, owner))
    own = owner[order]
    first = np.searchsorted(own, own)
    return order[np.arange(len(own)) - first < k]


def _shortlist(scores: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of all admitted entries that reach their row's k-th best."""
    if scores.shape[1] > k:
        held = np.where(ok, scores, np.iinfo(np.int64).min)
        kth = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
        ok = ok & (scores >= kth[:, None])
    return np.nonzero(ok)


def _matrix(table: pa.Table) -> np.ndarray:
    return table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _tiles(n: int, size: int):
    return ((a, min(a + size, n)) for a in range(0, n, size))


def _labels(*tables: pa.Table) -> list[np.ndarray]:
    """The tables' labels as numbers that agree."""
    told = np.concatenate([np.array(t["label"].to_pylist(), object).astype(str) for t in tables])
    numbers = np.unique(told, return_inverse=True)[1]
    return np.split(numbers, np.cumsum([t.num_rows for t in tables])[:-1])


class _Heaps:
    """One bounded heap for each owner."""

    def __init__(self, k: int):
        self.k, self.cols = k, [np.empty(0, np.int64)] * 3

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        cols = [np.concatenate(c) for c in zip(self.cols, (owner, score, ids), strict=True)]
        keep = _heads(*cols, self.k)
        self.cols = [c[keep] for c in cols]


def _positive_block(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        heaps = _Heaps(k)
        if rows.num_rows and anchors.num_rows:
            x, q = _matrix(rows), _matrix(anchors)
            labels, asked = _labels(rows, anchors)
            ids, place, own = rows["vec_id"].to_numpy(), rows["row"].to_numpy(), anchors["row"].to_numpy()
            for label in np.unique(asked):
                mine, theirs = np.flatnonzero(asked == label), np.flatnonzero(labels == label)
                for a, b in _tiles(len(mine), TILE[0]):
                    for c, d in _tiles(len(theirs), TILE[1]):
                        left, right = mine[a:b], theirs[c:d]
                        scores = strassen(q[left], x[right].T)
                        i, j = _shortlist(scores, place[right][None, :] != own[left][:, None], k)
                        heaps.add(own[left[i]], scores[i, j], ids[right[j]])
        return pa.table([pa.array(c, pa.int64()) for c in heaps.cols], ["anchor", "score", "positive_id"])

    return run


def _window_block(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        heaps, owner_of = _Heaps(k), [[], []]
        if rows.num_rows and anchors.num_rows:
            x, q = _matrix(rows), _matrix(anchors)
            labels, asked = _labels(rows, anchors)
            ids, own = rows["vec_id"].to_numpy(), anchors["row"].to_numpy()
            told = anchors["wanted"].to_pylist()
            wanted = np.array([[s[w] if w < len(s) else 0 for w in range(max(map(len, told)))] for s in told], np.int64)
            sizes = np.array([len(s) for s in told])
            base = np.concatenate([[0], np.cumsum(sizes)])
            owner_of = [np.repeat(own, sizes), np.concatenate([np.array(s, np.int64) for s in told])]
            least, most = -(-low * wanted // 100), high * wanted // 100
            for a, b in _tiles(len(q), TILE[0]):
                for c, d in _tiles(len(x), TILE[1]):
                    scores = strassen(q[a:b], x[c:d].T)
                    other = asked[a:b, None] != labels[None, c:d]
                    for w in range(wanted.shape[1]):
                        ok = other & (scores >= least[a:b, w, None]) & (scores <= most[a:b, w, None])
                        ok[sizes[a:b] <= w] = False
                        some = np.flatnonzero(ok.any(axis=1))
                        i, j = _shortlist(scores[some], ok[some], k)
                        heaps.add(base[a + some[i]] + w, scores[some[i], j], ids[c + j])
        owner, score, negative = heaps.cols
        anchor, positive = (np.asarray(c, np.int64)[owner] for c in owner_of)
        return pa.table([pa.array(c, pa.int64()) for c in (anchor, positive, score, negative)],
                        ["anchor", "positive_score", "negative_score", "negative_id"])

    return run


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``(row, vec_id, label, x, d)`` of the rows that take part; ``row`` tells rows apart, whatever their id."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull())
            .where(ok)
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                    F.col(label_col).cast("string").alias("label"),
                    F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("x"))
            .withColumn("d", F.size("x")))


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id is divisible by ``every``, positives an anchor's best ``positives`` other rows
    of its label, negatives the best ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the
    positive's.  Higher scores come first, ties by the smaller id.  Rows with a null id, label or vector, or null or
    non-finite components take no part; vectors of different lengths do not meet.  Rows of one id are rows of
    their own, as candidates and as anchors.  An anchor without positives, a positive without negatives and
    an empty table give no rows.  Scores times 100 must fit a long.  Other columns are ignored."""
    spark = vectors.sparkSession
    ship_package(spark)
    data = cut_lineage(taking_part(vectors, id_col, vector_col, label_col, scale))
    ask = data.where(F.col("vec_id") % every == 0)
    cores, n = spark.sparkContext.defaultParallelism, data.count()
    blocks = max(-(-n // block), min(2 * cores, -(-n // 1024)), 1)
    anchor_blocks = max(1, -(-ask.count() // anchor_block))
    tasks = min(blocks * anchor_blocks, 8 * cores)

    def spot(count: int, salt: int):
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(count)).cast("int")

    def all_of(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def met(anchors: DataFrame, run, schema: str) -> DataFrame:
        rows = data.select("*", spot(blocks, 1).alias("rb"), all_of(anchor_blocks).alias("qb"))
        anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], spot(anchor_blocks, 2).alias("qb"),
                                 all_of(blocks).alias("rb"))
        rows, anchors = (side.repartition(tasks, "rb", "qb", "d").groupBy("rb", "qb", "d") for side in (rows, anchors))
        return rows.cogroup(anchors).applyInArrow(run, schema)

    def best(found: DataFrame, k: int, score: str, name: str, *owner: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*owner).orderBy(F.desc(score), name))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    found = met(ask, _positive_block(positives), "anchor long, score long, positive_id long")
    chosen = cut_lineage(best(found, positives, "score", "positive_id", "anchor").drop("rank"))
    wanted = chosen.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_set("score")).alias("wanted"))
    inside = met(ask.join(wanted, "row"), _window_block(negatives, low, high),
                 "anchor long, positive_score long, negative_score long, negative_id long")
    ranked = best(inside, negatives, "negative_score", "negative_id", "anchor", "positive_score")
    return (chosen.withColumnRenamed("score", "positive_score").join(ranked, ["anchor", "positive_score"])
            .join(ask.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
