"""Ranked lexical search for many queries at once (operator 13).

The items' queries share terms, so their common parts are found first and evaluated once:

* terms that the same items hold equally often become one set node;
* then the pair of nodes that most items share is replaced by a new node, again and
  again, until no pair is shared (pairs are counted once and updated as nodes are replaced).

The result is a query-sharing DAG: leaves are terms, a set node adds its terms, a
pair node its two children, and an item adds the few nodes that are left to it.

A first pass counts, in every document, all terms and the items' terms, and writes these counts;
the document frequencies, N and L are aggregates of what it wrote.  A second pass turns
counts into impacts and evaluates the DAG level by level for ``DOCS`` documents at a
time: a node's accumulators, one per document, are formed once and read by all nodes
and items above it.  Each task keeps the best k documents of an item, and the tasks'
heads meet in a last ranking.

Items are taken in blocks of at most ``items`` queries, each with a DAG of its own, so what is broadcast is
bounded by a block, whatever the number of items."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import mapped, small_batches, staged

K, ITEMS, DOCS, WIDEST = 10, 1024, 256, 64
ONE, SLOPE, PER_CENT, SATURATION = 1_000_000_000, 75, 100, 8    # of the weighting
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return TERM.findall((text or "").encode().lower())


@dataclass
class Dag:
    """Nodes 0..terms-1 are the terms; ``sets`` and ``pairs`` (a list for each level) define the others."""
    vocabulary: dict[bytes, int]
    set_nodes: np.ndarray           # the set nodes, each the sum of a stretch of ``set_terms``
    set_terms: np.ndarray
    set_starts: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]     # (node, child, child), children of lower levels
    nodes: int
    item_nodes: np.ndarray          # what each item adds, a stretch for each item
    item_starts: np.ndarray

    def evaluate(self, impacts: np.ndarray) -> np.ndarray:
        """Scores (items x documents) of impacts (terms x documents)."""
        acc = np.zeros((self.nodes, impacts.shape[1]), np.int64)
        acc[:len(impacts)] = impacts
        if len(self.set_nodes):
            acc[self.set_nodes] = np.add.reduceat(acc[self.set_terms], self.set_starts, axis=0)
        for node, left, right in self.levels:
            acc[node] = acc[left] + acc[right]
        return np.add.reduceat(acc[self.item_nodes], self.item_starts, axis=0)


def sharing_dag(queries: list[list[bytes]], widest: int = WIDEST) -> Dag:
    """The DAG of queries that have a term each.  Only the ``widest`` most shared nodes of a query
    enter pairs, which bounds the mining of very long queries; others are added as they are."""
    vocabulary: dict[bytes, int] = {}
    held: list[Counter] = []
    for query in queries:
        held.append(Counter(vocabulary.setdefault(t, len(vocabulary)) for t in query))
    users = defaultdict(list)
    for item, counts in enumerate(held):
        for term, times in sorted(counts.items()):
            users[term].append((item, times))
    classes = defaultdict(list)
    for term, by in users.items():
        classes[tuple(by)].append(term)
    nodes = len(vocabulary)
    sets, of_item = [], [Counter() for _ in queries]
    for by, same in sorted(classes.items(), key=lambda c: c[1]):
        node = same[0]
        if len(same) > 1:
            node, nodes = nodes, nodes + 1
            sets.append((node, same))
        for item, times in by:
            of_item[item][node] += times
    level = dict.fromkeys(range(nodes), 0)
    share = Counter(n for counts in of_item for n in counts)
    live = [set(sorted((n for n in counts if share[n] > 1), key=lambda n: (-share[n], n))[:widest])
            for counts in of_item]
    where = defaultdict(set)
    for item, some in enumerate(live):
        for pair in combinations(sorted(some), 2):
            where[pair].add(item)
    heap = [(-len(by), pair) for pair, by in where.items() if len(by) > 1]
    heapq.heapify(heap)
    pairs = defaultdict(list)
    while heap:
        size, (a, b) = heapq.heappop(heap)
        by = sorted(where[a, b])
        if len(by) != -size:
            if len(by) > 1:
                heapq.heappush(heap, (-len(by), (a, b)))
            continue
        node, nodes = nodes, nodes + 1
        level[node] = 1 + max(level[a], level[b])
        pairs[level[node]].append((node, a, b))
        for item in by:
            counts, some = of_item[item], live[item]
            for old in (a, b):
                counts[old] -= 1
                if not counts[old]:
                    del counts[old]
                    some.discard(old)
                    for n in some:
                        where[min(n, old), max(n, old)].discard(item)
            where[a, b].discard(item)
            if a in some and b in some:
                where[a, b].add(item)       # both occur again in this query
            counts[node] += 1
            for n in some:
                where[n, node].add(item)
            some.add(node)
        for n in {n for item in by for n in live[item]} - {node}:
            if len(where[n, node]) > 1:
                heapq.heappush(heap, (-len(where[n, node]), (n, node)))
        if len(where[a, b]) > 1:
            heapq.heappush(heap, (-len(where[a, b]), (a, b)))

    def stretches(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = [len(x) for x in lists]
        return (np.array([n for x in lists for n in x], np.int64),
                np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64) if sizes else np.empty(0, np.int64))

    set_terms, set_starts = stretches([same for _, same in sets])
    item_nodes, item_starts = stretches([sorted(c.elements()) for c in of_item])
    levels = [tuple(np.array(c, np.int64) for c in zip(*pairs[i], strict=True)) for i in sorted(pairs)]
    return Dag(vocabulary, np.array([n for n, _ in sets], np.int64), set_terms, set_starts, levels, nodes, item_nodes,
               item_starts)


def _counted(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """``(doc_id, n, term, tf)``, written once: all terms of a document, and its counts of the vocabulary."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value
        for batch in small_batches(batches, 1):
            sizes, found, often = [], [], []
            for text in batch.column(1):
                all_terms = terms(text.as_py())
                counts = Counter(filter(place.__contains__, all_terms))
                sizes.append(len(all_terms))
                found.append([place[t] for t in counts])
                often.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 pa.array(often, pa.list_(pa.int64()))], ["doc_id", "n", "term", "tf"])

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return staged(mapped(kept, run, "doc_id long, n long, term array<int>, tf array<long>"), "term-counts")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _heads(score: np.ndarray, doc: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """For each row the columns of its k best entries: score, then the smaller id, a null id last."""
    return np.lexsort((doc, null, -score), axis=1)[:, :k]


def _ranked(counted: DataFrame, dag: Dag, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``(item, doc_id, score)``: the k best documents of each item and task."""
    items = len(dag.item_starts)
    fitted = counted.sparkSession.sparkContext.broadcast((dag, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, w = fitted.value
        best = np.zeros((items, k), np.int64), np.zeros((items, k), np.int64), np.ones((items, k), bool)
        for batch in batches:
            for lo in range(0, batch.num_rows, DOCS):
                some = batch.slice(lo, DOCS)
                term, tf = some.column(2), some.column(3)
                sizes = np.diff(term.offsets.to_numpy())
                row = np.repeat(np.arange(some.num_rows), sizes)
                t, f = term.flatten().to_numpy().astype(np.int64), tf.flatten().to_numpy()
                m = np.array([PER_CENT - SLOPE + SLOPE * n * n_docs // n_terms for n in some.column(1).to_pylist()],
                             np.int64)
                impacts = np.zeros((len(w), some.num_rows), np.int64)
                impacts[t, row] = w[t] * (ONE * f // (1000 * f + SATURATION * m[row]))
                scores = plan.evaluate(impacts)
                hot = np.flatnonzero((scores.max(axis=1) > 0) & (scores.max(axis=1) >= best[0][:, -1]))
                if len(hot):
                    doc = some.column(0).fill_null(0).to_numpy()
                    null = some.column(0).is_null().to_numpy(zero_copy_only=False)
                    cols = [np.concatenate([b[hot], np.broadcast_to(new, (len(hot), some.num_rows))], axis=1)
                            for b, new in zip(best, (scores[hot], doc, null), strict=True)]
                    pick = _heads(*cols, k)
                    for b, c in zip(best, cols, strict=True):
                        b[hot] = np.take_along_axis(c, pick, 1)
        item, at = np.nonzero(best[0] > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(best[1][item, at], pa.int64(), mask=best[2][item, at]),
             pa.array(best[0][item, at], pa.int64())], ["item", "doc_id", "score"])

    return mapped(counted.where(F.size("term") > 0), run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", k: int = K, block: int = ITEMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's k best documents with a score above 0, ties by the smaller
    doc_id, a null doc_id last.

    A null or empty text has no terms; such a document is not counted, such an item has no result.  Repeated rows
    are documents and items of their own, so a repeated item has the same ranks twice.  Without documents or items
    there are no rows.  Other columns are ignored."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"),
                         F.monotonically_increasing_id().alias("_row"))
    asked = staged(asked.orderBy("item_id", "text", "_row").select("item_id", "text"), "items")
    kind = items.schema[item_col].dataType
    found = spark.createDataFrame([], "item_id string, rank int, doc_id long, score long").withColumn(
        "item_id", F.col("item_id").cast(kind))
    pending: list[tuple] = []

    def answer() -> DataFrame:
        dag = sharing_dag([q for _, q in pending])
        counted = _counted(docs, id_col, text_col, dag.vocabulary)
        n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(dag.vocabulary), np.int64)
        for r in counted.select(F.explode("term").alias("t")).groupBy("t").count().collect():   # a row for each term
            df[r["t"]] = r["count"]
        weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
        heads = _ranked(counted, dag, weights, n_docs, n_terms or 1, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        heads = heads.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(pending)],
                                      "item int, item_id string").withColumn("item_id", F.col("item_id").cast(kind))
        return heads.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")

    for r in asked.toLocalIterator():
        query = terms(r["text"])
        if query:
            pending.append((None if r["item_id"] is None else str(r["item_id"]), query))
        if len(pending) == block:
            found = found.unionByName(answer())
            pending.clear()
    return found.unionByName(answer()) if pending else found
