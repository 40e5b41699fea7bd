"""SimHash near-duplicates by pigeonhole blocks (operator 4).

Every text becomes a 64-bit fingerprint: the bitwise majority over the XXH64
values (seed 42) of its word shingles, repeats included.  Two fingerprints are
linked if they differ in at most ``distance`` bits; documents with the same
component of links form a group.

The links are found on *distinct* fingerprints, so thousands of exact copies
are one row before any join.  The 64 bits are cut into ``blocks`` blocks.  Two
fingerprints within ``distance`` bits agree on at least ``blocks - distance``
blocks, so they meet in one of the C(blocks, distance) tables keyed by that
many blocks (7 and 4: 35 tables, keys of 27 or 28 bits).  The rows of a key are
verified with popcounts, and only a spanning forest of the links leaves the
task, never all pairs.  A key with more than ``bucket`` fingerprints is not
worked on in one task: its rows are keyed again by sub-blocks of the bits that
the first key leaves open (the same argument a second time), after which a key
fixes at least 42 bits and cannot hold more than 2^22 distinct values (32 MB).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import components, cut_lineage, mapped, small_batches

SHINGLE, DISTANCE, BLOCKS, BUCKET = 4, 4, 7, 4096
SEED = 42
CHUNK = 1 << 16


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """Unsigned XXH64 of every shingle of a text (UTF-8)."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of texts whose hashes lie one after the other, ``counts``
    of them each: a bit is 1 if it is set in over half; no hash gives zero."""
    ones = np.zeros((len(counts), 64), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    for at in range(0, len(hashes), CHUNK):
        part, who = hashes[at:at + CHUNK], owner[at:at + CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        ones[who[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    set_bits = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` for each row; a null, empty or blank text has fp 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            values, counts = [], []
            fps, held = [], 0
            for text in batch.column(1):
                raw = text.as_buffer()
                got = shingle_hashes(raw.to_pybytes(), shingle) if raw is not None else []
                values.append(np.array(got, np.uint64))
                counts.append(len(got))
                held += len(got)
                if held >= CHUNK:
                    fps.append(majority(np.concatenate(values), np.array(counts)))
                    values, counts, held = [], [], 0
            if counts:
                fps.append(majority(np.concatenate(values), np.array(counts)))
            out = np.concatenate(fps).view(np.int64) if fps else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "fp"])

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(kept, run, "doc_id long, fp long")


def _spans(bits: list[int], n: int) -> list[list[int]]:
    """``bits`` cut into n blocks of almost equal size."""
    cut = [round(i * len(bits) / n) for i in range(n + 1)]
    return [bits[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def block_masks(bits: list[int], blocks: int, distance: int) -> list[int]:
    """One mask for each choice of ``blocks - distance`` blocks of ``bits``."""
    parts = [sum(1 << b for b in part) for part in _spans(bits, blocks)]
    return [sum(c) for c in combinations(parts, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def forest(values: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Spanning forest of the links among sorted distinct fingerprints: each
    search compares one value with those not yet reached, so a tight group of
    n costs about n comparisons for each value until all are reached."""
    left, right = [], []
    rest = values
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        todo = [seed]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= distance
            if near.any():
                got = rest[near]
                left.append(np.full(len(got), seed))
                right.append(got)
                todo.extend(got)
                rest = rest[~near]
    return left, right


def _scan(distance: int, bucket: int | None):
    """Walks rows sorted by (t, key, fp): links of each key, or its rows again
    (``t`` >= 0) if it holds more than ``bucket`` fingerprints."""

    def out(t, a, b):
        return pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(a.view(np.int64)),
                                           pa.array(b.view(np.int64))], ["t", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []      # the run that the last batch ended in
        held_n, at, big = 0, None, False

        def close():
            if big or held_n < 2:
                return None
            left, right = forest(np.concatenate(held), distance)
            if not left:
                return None
            a = np.concatenate(left)
            return out(np.full(len(a), -1, np.int32), a, np.concatenate(right))

        for batch in batches:
            t = batch.column(0).to_numpy(zero_copy_only=False)
            key = batch.column(1).to_numpy(zero_copy_only=False)
            fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(t):
                continue
            first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])])
            last = np.r_[first[1:], len(t)]
            lone = (last - first == 1)
            lone[0] = lone[-1] = False   # these may go on in the batch before or after
            for a, b in zip(first[~lone], last[~lone], strict=True):
                if at != (t[a], key[a]):
                    if (got := close()) is not None:
                        yield got
                    held, held_n, at, big = [], 0, (t[a], key[a]), False
                held.append(fp[a:b].copy())
                held_n += b - a
                if bucket and held_n > bucket:
                    rows = np.concatenate(held)
                    yield out(np.full(len(rows), t[a], np.int32), np.full(len(rows), key[a]), rows)
                    held, big = [], True
        if (got := close()) is not None:
            yield got

    return run


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all links among the
    distinct values of ``fps(fp)``."""
    if blocks <= distance:
        raise ValueError("blocks must be more than distance")
    masks = block_masks(list(range(64)), blocks, distance)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("k.t", "k.key", "fp")
    first = cut_lineage(mapped(keyed.repartition("t", "key").sortWithinPartitions("t", "key", "fp"),
                               _scan(distance, bucket), "t int, a long, b long"))
    choices = []
    for i, m in enumerate(masks):
        open_bits = [b for b in range(64) if not m >> b & 1]
        subs = block_masks(open_bits, blocks, distance)
        choices.append(F.when(F.col("t") == i, F.array(*[F.lit(_signed(m | s)) for s in subs])))
    over = (first.where("t >= 0").select("t", F.col("b").alias("fp"),
                                         F.posexplode(F.coalesce(*choices)).alias("s", "mask"))
            .select((F.col("t") * 1000 + F.col("s")).cast("int").alias("t"),
                    F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    second = mapped(over.repartition("t", "key").sortWithinPartitions("t", "key", "fp"),
                    _scan(distance, None), "t int, a long, b long")
    return first.where("t < 0").select("a", "b").union(second.select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)`` for each input row.

    ``component_id`` is the smallest doc_id reachable over links.  A null or
    empty text has fingerprint zero and is linked like any other; repeated rows
    are copies of each other; a null doc_id takes part and never becomes a
    component id unless its group has no other (then null).  Other columns are
    ignored; an empty table gives no rows."""
    by_doc = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut_lineage(by_doc.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    root = components(links(distinct.select("fp"), distance, blocks, bucket))
    rooted = (distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    group = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(group, "root").select("fp", "component_id")
    return by_doc.join(named, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose component has a smaller doc_id; of
    repeated rows one stays.  ``found`` is what ``near_duplicates`` returned."""
    def key(name: str):     # never null, so that one exchange serves the join and the removal of repeated rows
        return F.coalesce(F.col(name).cast("long"), F.lit(0)).alias("__id"), F.isnull(name).alias("__null")

    names = [F.col(f"`{c}`") for c in docs.columns]
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*key("doc_id")).distinct()
    return (docs.select(*names, *key(id_col)).join(stay, ["__id", "__null"], "left_semi")
            .dropDuplicates(["__id", "__null", text_col]).select(*names))
