"""Benchmark decontamination as a prefix-filtered set join (operator 7).

An item's windows (``width`` consecutive words; one window for a shorter item)
are sets of word shingles with positions.  A document holds a window only if
it holds all its shingles, so a prefix of one shingle is enough: the window's
rarest by the count over all documents.

1. one pass over the documents counts the shingles that occur in the benchmark;
2. each window picks its rarest shingle as prefix;
3. a second pass emits the document positions of prefix shingles, with the few
   words around them; they join the windows on the shingle;
4. length bound (the window must fit between the document's ends at that
   offset), positional bound (the window must start at position - offset) and
   the comparison of all words decide.

Both passes skip shingles that no window has by a bit set of 2^24 bits (2 MB
however large the tables are; false positives only cost a join row).  Words are
hashed in numpy over the Arrow buffers; nothing is decoded but the words around
candidates.  Every row that meets in a join is keyed by a rare shingle, and the
window table's side is left to Spark to broadcast or sort by its size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_prefix, mapped, same_row, small_batches, staged, utf8_column

WIDTH, SHINGLE = 10, 3
LOG_BITS = 24
SEGMENT = 1 << 22

#: A-Z to lower case; 0-9, a-z and everything from U+0080 on are letters of words, the rest separates.
FOLD = np.zeros(256, np.uint8)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = [int(x) | 1 for x in _RNG.integers(1, 1 << 62, 16, dtype=np.uint64)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step % (1 << 64)
    return out[:n]


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, starts and ends of all words, and a 64-bit hash of each.
    Worked on in segments that end between words, so that the helper arrays
    stay small for any length of text."""
    text = FOLD[data]
    inside = text != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[offsets < len(text)]
    begins[cut] |= inside[cut]
    stops = np.append(inside[:-1] & (begins[1:] | ~inside[1:]), inside[-1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SEGMENT, "right")))
        lo, hi = starts[a], ends[b - 1]
        power, inverse = _tables(hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[text[lo:hi]] * power[:hi - lo], out=sums[1:])
        hashes[a:b] = (sums[ends[a:b] - lo] - sums[starts[a:b] - lo]) * inverse[starts[a:b] - lo]
        a = b
    return text, starts, ends, _stir(hashes)


_CACHE: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("p", ())) < n:
        size = max(n, 1 << 16)
        got = _powers(_BASE, size), _powers(_INVERSE, size)
        if size > SEGMENT:   # one word longer than a segment: not kept
            return got
        _CACHE["p"], _CACHE["q"] = got
    return _CACHE["p"], _CACHE["q"]


def shingles_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by the position of its first."""
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out += hashes[j:j + n] * np.uint64(_MIX[j])
    return _stir(out)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - LOG_BITS)).astype(np.int64)


def item_windows(items: DataFrame, id_col: str, text_col: str, width: int, shingle: int) -> DataFrame:
    """``(item_id, win, n, tokens)``: the windows of each item, as words joined
    by a space, with their shingles in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            ids, wins, sizes, tokens = [], [], [], []
            for i in range(batch.num_rows):
                one = data[offsets[i]:offsets[i + 1]]
                text, starts, ends, hashes = words_of(one, np.array([0]))
                words = [text[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
                n = min(width, len(words))
                size = min(shingle, n)
                sh = shingles_of(hashes, size).view(np.int64).tolist() if n else []
                for at in range(len(words) - n + 1 if n else 0):
                    ids.append(batch.column(0)[i].as_py())
                    wins.append(" ".join(words[at:at + n]))
                    sizes.append(n)
                    tokens.append(sh[at:at + n - size + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(wins, pa.string()), pa.array(sizes, pa.int32()),
                 pa.array(tokens, pa.list_(pa.int64()))], ["item_id", "win", "n", "tokens"])

    return mapped(items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")), run,
                  "item_id string, win string, n int, tokens array<long>")


def _bits(tokens: DataFrame) -> np.ndarray:
    """Bit set over the leading bits of ``tokens(token)``: at most 2^18 longs
    reach the driver."""
    slot = F.shiftrightunsigned("token", 64 - LOG_BITS)
    rows = (tokens.select(F.shiftright(slot, 6).cast("int").alias("at"),
                          F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(token, "
                                 f"{64 - LOG_BITS}), 64) as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).collect())
    words = np.zeros(1 << LOG_BITS - 6, np.int64)
    for r in rows:
        words[r["at"]] = r["bits"]
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def _matches(hashes, per_doc, sizes, bits):
    """Positions and hashes of the shingles of the given sizes that ``bits``
    lets through and that lie within one document."""
    last = np.repeat(np.cumsum(per_doc), per_doc)   # for each word, where its document ends
    for size in sizes:
        sh = shingles_of(hashes, size)
        at = np.flatnonzero(bits[_slot(sh)])
        at = at[at + size <= last[at]]
        yield size, at, sh[at]


def _per_doc(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(starts, offsets))


def _count(docs: DataFrame, bits, sizes: list[int]) -> DataFrame:
    """``(token, seen)`` over all documents, summed per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 0, SEGMENT):
            data, offsets = utf8_column(batch.column(0))
            _, starts, _, hashes = words_of(data, offsets)
            got = [sh for _, _, sh in _matches(hashes, _per_doc(starts, offsets), sizes, bits.value)]
            token, seen = np.unique(np.concatenate(got), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(seen)], ["token", "seen"])

    return (mapped(docs.select("text"), run, "token long, seen long")
            .groupBy("token").agg(F.sum("seen").alias("seen")))


def _probe(docs: DataFrame, bits, sizes: list[int], width: int) -> DataFrame:
    """For each document its number of words and its candidates: prefix
    shingles with their position and the words around it."""
    cand = pa.struct([("token", pa.int64()), ("pos", pa.int64()), ("lo", pa.int64()), ("ctx", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2, SEGMENT):
            data, offsets = utf8_column(batch.column(2))
            text, starts, ends, hashes = words_of(data, offsets)
            n_words = _per_doc(starts, offsets)
            first = np.concatenate([[0], np.cumsum(n_words)])
            ats, toks = [], []
            for _, at, sh in _matches(hashes, n_words, sizes, bits.value):
                ats.append(at)
                toks.append(sh)
            at, tok = np.concatenate(ats), np.concatenate(toks)
            order = np.argsort(at, kind="stable")
            at, tok = at[order], tok[order].view(np.int64)
            doc = np.searchsorted(first, at, "right") - 1
            lo, hi = np.maximum(first[doc], at - width + 1), np.minimum(first[doc + 1], at + width)
            ctx = [" ".join(text[a:b].tobytes().decode() for a, b in zip(starts[x:y], ends[x:y], strict=True))
                   for x, y in zip(lo, hi, strict=True)]
            flat = pa.StructArray.from_arrays(
                [pa.array(tok), pa.array(at - first[doc]), pa.array(lo - first[doc]), pa.array(ctx, pa.string())],
                fields=list(cand))
            splits = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(splits), flat)], ["doc_id", "th", "n_words", "cands"])

    return mapped(docs, run, "doc_id long, th long, n_words long, "
                                "cands array<struct<token: long, pos: long, lo: long, ctx: string>>")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
                  shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for
    each input row, and ``th`` (hash of the text).

    A null, empty or wordless text has no words and no hits; such an item has
    no window.  Repeated rows each get their row; rows of the same doc_id with
    other texts are judged apart; a null doc_id is an id like any other.  An
    empty benchmark leaves every document clean.  Item ids are compared as
    strings; items of the same id count once, an item without id counts as the
    empty string.  Other columns are ignored."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = named.select("doc_id", F.xxhash64("text").alias("th"), "text")
    items = items.withColumn(item_col, F.coalesce(F.col(item_col).cast("string"), F.lit("")))
    wins = staged(item_windows(items, item_col, item_text_col, width, shingle).distinct(), "windows")
    sizes = sorted(r[0] for r in wins.select(F.least("n", F.lit(shingle))).distinct().collect()) or [shingle]
    tokens = wins.select("win", "n", F.posexplode("tokens").alias("off", "token")).distinct()
    seen = _count(named, sc.broadcast(_bits(tokens.select("token"))), sizes)
    prefix = staged(tokens.join(seen, "token", "left").groupBy("win", "n")
                    .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token", "off")).alias("p"))
                    .select("win", "n", "p.token", "p.off"), "prefix")
    probed = staged(_probe(keyed, sc.broadcast(_bits(prefix.select("token"))), sizes, width), "probed")
    cand = (probed.where(F.size("cands") > 0).select("doc_id", "th", "n_words", F.explode("cands").alias("c"))
            .select("doc_id", "th", "n_words", "c.*").distinct())
    begin = F.col("pos") - F.col("off")
    hits = (cand.join(prefix, "token")
            .where((begin >= 0) & (begin + F.col("n") <= F.col("n_words")) & (begin >= F.col("lo")))
            .where(F.array_join(F.slice(F.split("ctx", " "), (begin - F.col("lo") + 1).cast("int"), F.col("n")), " ")
                   == F.col("win"))
            .select("doc_id", "th", begin.alias("a"), (begin + F.col("n")).alias("b"), "win"))
    hits = staged(hits, "hits")
    reach = F.max("b").over(Window.partitionBy("doc_id", "th").orderBy("a", "b")
                            .rowsBetween(Window.unboundedPreceding, -1))
    covered = (hits.groupBy("doc_id", "th", "a").agg(F.max("b").alias("b"))
               .withColumn("old", F.coalesce(reach, F.lit(0)))
               .groupBy("doc_id", "th")
               .agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", "old"))).alias("n_hit")))
    held = (hits.select("doc_id", "th", "win").distinct().join(wins.select("win", "item_id"), "win")
            .groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("ids")))
    out = (probed.select("doc_id", "th", "n_words").alias("d")
           .join(covered.alias("c"), same_row("d", "c", "doc_id", "th"), "left")
           .join(held.alias("h"), same_row("d", "h", "doc_id", "th"), "left"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("d.doc_id", "d.n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"), F.col("d.th"))


def drop_contaminated(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``decontaminate`` marks."""
    own = free_prefix(docs, "_bad")
    doc, text = f"{own}_id", f"{own}_th"
    bad = found.where("contaminated").select(F.col("doc_id").alias(doc), F.col("th").alias(text)).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(doc))
                     & F.xxhash64(F.col(text_col).cast("string")).eqNullSafe(F.col(text)), "left_anti")
