"""Exact top-k inner products by Fagin's threshold algorithm (operator 5).

Rows lie in blocks of at most about ``block`` vectors, queries in blocks of
``query_block``; each pair of blocks is one task's work, so the query set may
grow with the table, and no task holds more than one block of each.  In a block
every dimension has a sorted list.  A query reads its lists from the end that
its sign favours, in steps of growing depth; rows met for the first time get
their full score; the products at the lists' current depth add up to a bound on
every row not yet met, and the query stops when the bound is below the k-th best
score (not at equality, as a tie may have a smaller id).  The best k of each
block meet in a last ranking of k rows per query and block.

Components become floor(256 x); products are sums of integers, exact in float64
below 2^53 (checked per block; beyond, integer arithmetic is used)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut_lineage, ship_package

K, EVERY, SCALE = 5, 50, 256
BLOCK, QUERY_BLOCK = 32768, 4096
FIRST_DEPTH, GROWTH = 16, 8


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(row, vec_id, x, d)`` of the rows that take part; ``row`` tells rows of one id apart."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(ok)
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("x"))
            .withColumn("d", F.size("x")))


class Lists:
    """A block's vectors and its sorted list of each dimension."""

    def __init__(self, ids: np.ndarray, places: np.ndarray, x: np.ndarray):
        order = np.lexsort((places, ids))
        self.ids, self.places, self.x = ids[order], places[order], np.ascontiguousarray(x[order])
        self.order = np.argsort(self.x, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(self.x.T, self.order, 1)

    def best(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows for q other than the row ``own``, ties to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        met = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, self.x.dtype)
        at, depth = 0, min(FIRST_DEPTH, n)
        while True:
            now = np.zeros(n, bool)
            now[self.order[up, n - depth:n - at].ravel()] = True
            now[self.order[down, at:depth].ravel()] = True
            if depth == n:
                now[:] = True       # also where every component of q is zero
            new = np.flatnonzero(now & ~met)
            met |= now
            new = new[self.places[new] != own]
            rows, scores = np.r_[rows, new], np.r_[scores, self.x[new] @ q]
            if len(rows) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                some = scores >= kth
                rows, scores = rows[some], scores[some]
                pick = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[pick], scores[pick]
            if depth == n:
                break
            bound = self.values[up, n - depth] @ q[up] + self.values[down, depth - 1] @ q[down]
            if len(rows) == k and bound < scores.min():
                break
            at, depth = depth, min(depth * GROWTH, n)
        pick = np.lexsort((rows, -scores))
        return self.ids[rows[pick]], scores[pick]


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _block_best(k: int):
    names = ["query", "query_id", "vec_id", "score"]

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if rows.num_rows and queries.num_rows:
            x, q = _matrix(rows["x"], rows.num_rows), _matrix(queries["x"], queries.num_rows)
            top = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1])
            kind = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
            lists, q = Lists(rows["vec_id"].to_numpy(), rows["row"].to_numpy(), x.astype(kind)), q.astype(kind)
            for own, told, one in zip(queries["row"].to_numpy(), queries["vec_id"].to_numpy(), q, strict=True):
                ids, scores = lists.best(one, own, k)
                for col, part in zip(out, (np.full(len(ids), own), np.full(len(ids), told), ids, scores.astype(np.int64)),
                                     strict=True):
                    col.append(part)
        return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], names)

    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY,
          scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by
    ``every`` its k highest inner products with all other rows.

    Rows with a null id, a null vector, or null or non-finite components take no
    part; vectors of different lengths do not meet; rows of one id are rows of their
    own, as candidates and as queries.  A query without any other row has no result.
    Scores must fit a long."""
    ship_package(vectors.sparkSession)
    data = cut_lineage(quantized(vectors, id_col, vector_col, scale))
    blocks = max(1, -(-data.count() // block))
    ask = data.where(F.col("vec_id") % every == 0)
    query_blocks = max(1, -(-ask.count() // query_block))

    def spot(n: int, salt: int):
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = data.select("*", spot(blocks, 1).alias("rb"), all_of(query_blocks).alias("qb"))
    queries = ask.select(*[F.col(c).alias(c) for c in ask.columns], spot(query_blocks, 2).alias("qb"), all_of(blocks).alias("rb"))
    found = (rows.groupBy("rb", "qb", "d").cogroup(queries.groupBy("rb", "qb", "d"))
             .applyInArrow(_block_best(k), "query long, query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
