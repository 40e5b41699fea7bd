"""Concatenate and cut (operator 10): all documents as one stream of tokens,
cut into windows of ``length``.

Pass one tokenizes each document once and writes its ids with the partition it
was in and its start inside that partition.  The partitions' totals (one row
each) are summed up on the driver into the start of every partition in the
stream.  Pass two adds the two starts and cuts each document at the multiples
of ``length``; each piece is a boundary record.  No shuffle, no sort: a document
of any length is cut like any other, and only the last sequence may fall short.
The written ids make the second pass independent of how often a task of the
first one ran.

The ids are those of the tokenizer file; the engine is tiktoken over the same
ranks, about three times as fast as the file's own library, which takes over
where that engine gives up (a test compares the two)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mapped, staged

LENGTH, END = 2048, 1
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}


@cache
def encoder(vocabulary: str, ranks: str):
    """A function from texts to lists of ids; paths are looked up where it runs."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(ranks), "rb") as f:
        table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens=SPECIAL)
    slow: list[Tokenizer] = []

    def ids(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except Exception:  # the engine's pattern gives up on some very long runs
            if not slow:
                slow.append(Tokenizer.from_file(public_tokenizers.path(vocabulary)))
            return slow[0].encode(text, add_special_tokens=False).ids

    return ids


def tokenized(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, ranks: str) -> DataFrame:
    """``(doc_id, part, start, n, ids)``, written once; ids as little-endian
    unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                blobs, starts, sizes = [], [], []
                for text in some.column(1):
                    got = np.array([*encode(text.as_py() or ""), END], "<u4")
                    starts.append(at)
                    sizes.append(len(got))
                    at += len(got)
                    blobs.append(got.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([part] * len(sizes), pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                    ["doc_id", "part", "start", "n", "ids"])

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return staged(mapped(kept, run, "doc_id long, part int, start long, n long, ids binary"), "token-ids")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         vocabulary: str = VOCABULARY, ranks: str = RANKS) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``
    for each piece.

    A null or empty text is the end id alone.  Repeated rows are documents of
    their own with pieces of their own; a null doc_id stays null.  An empty
    table gives no pieces.  Sequences are numbered from 0; all but the last are
    full.  Other columns are ignored."""
    spark = docs.sparkSession
    written = tokenized(docs, id_col, text_col, vocabulary, ranks)
    totals = written.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # a row for each partition
    starts = np.concatenate([[0], np.cumsum([r["n"] for r in totals])]).tolist()
    base = spark.sparkContext.broadcast({r["part"]: s for r, s in zip(totals, starts, strict=False)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, part, at, n, ids in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4), strict=True):
                raw = memoryview(ids.as_buffer())
                at += base.value[part]
                lo = 0
                while lo < n:
                    sequence, offset = divmod(at + lo, length)
                    hi = min(n, lo + length - offset)
                    row = doc, lo, hi - lo, zlib.crc32(raw[4 * lo:4 * hi]), n, sequence, offset
                    for col, x in zip(cols, row, strict=True):
                        col.append(x)
                    lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                              "offset"])

    return mapped(written, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                   "sequence_id long, offset long")
