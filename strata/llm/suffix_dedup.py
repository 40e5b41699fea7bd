"""Repeated byte strings by bucket-pointer refinement (operator 3).

Every byte covered by a string of ``length`` bytes that also starts earlier
(smaller doc_id, or the same document and a smaller offset) is removed.

Suffixes are put into buckets by their first q = 24 bytes.  A bucket's
identifier is the 64-bit name of its q-gram, and deeper identifiers come from
the identifiers of later offsets, reused at every level:
id_2h(i) = name(id_h(i), id_h(i + h)), so id_24(i) = name(id_16(i), id_8(i + 16))
and id_100(i) = name(id_64(i), id_32(i + 64), id_4(i + 96)).  Suffixes need not
be sorted deeper than 100 bytes, and inside a class of equal strings only the
order of (doc_id, offset) counts.

Not every suffix carries a bucket pointer through the shuffle.  Each window of
100 bytes points at its smallest 24-byte bucket identifier (leftmost on ties).
Equal windows point at equal buckets at equal offsets, so only windows whose
pointers meet in one bucket can be equal.  The consecutive windows that share a
pointer are one row, a *run*:

1. the runs are sorted by (bucket, deeper identifier, place), the deeper one
   being made of those of the run's first and last window, so that equal runs
   have equal bytes.  All but the first of equal runs are removed whole, a
   bucket with one member is done, and where a bucket still holds different
   runs, the first of each go on;
2. these are refined on their bytes (``refine``): suffixes get the rank of their
   8-byte bucket as pointer; each round sorts the members of a bucket by the
   pointers at a later offset and renames them in place, later rounds read the
   new pointers, and a suffix alone in its bucket leaves.  After 100 bytes the
   windows that share a pointer are equal, and all but the first are removed.

Both steps read a sorted stream and hold one batch, or at most ``CHUNK`` runs.
Equal runs of one Arrow batch are combined before the shuffle, so a passage that
a third of all documents share is a few rows of its bucket.  A bucket with more
than ``chunk`` different runs is dealt in parts to many tasks for step 2, and the
first windows of its parts meet in a further, evenly spread shuffle: the windows
whose pointer stands at one of ``STRETCH`` neighbouring offsets share most of
their bytes and are one row, named by these bytes.  A row whose name no other
row has holds no repeated window and ends there; only of the others are single
windows compared.  No bucket is collected, and no pairs are made.

Across tasks a bucket is named by a 64-bit hash of its bytes, since ranks of all
suffixes of a corpus would be a shuffled row for each byte and round; ranks are
the pointers of step 2."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import doc_blocks, mapped, staged, utf8_column

LENGTH, Q = 100, 24
PART, CHUNK = 1024, 4096     # runs of a part of a bucket; runs refined at a time
STRETCH = 16                # windows of a run that meet other parts as one row
BLOCK = 1 << 18
_POSITION = np.uint64((1 << 20) - 1)
_RNG = np.random.default_rng(97531)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LEFT = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RIGHT = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _name(level: int, *parts: np.ndarray) -> np.ndarray:
    """One identifier from those of consecutive stretches."""
    out = parts[0] * _LEFT[level]
    for i, p in enumerate(parts[1:]):
        out ^= out >> np.uint64(29)
        out = (out + p) * _RIGHT[(level + i) % 16]
    return out ^ (out >> np.uint64(32))


def identifiers(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of all q-grams and of all windows of ``length`` bytes."""
    levels, size = {1: _BYTE[data]}, 1
    while size * 2 <= length:
        low = levels[size]
        levels[size * 2] = _name(size.bit_length(), low[:-size], low[size:]) if len(low) > size else low[:0]
        size *= 2

    def deep(size: int, salt: int) -> np.ndarray:
        n, parts, at = max(0, len(data) - size + 1), [], 0
        while at < size:
            step = 1 << (size - at).bit_length() - 1
            parts.append(levels[step][at:at + n])
            at += step
        return _name(salt, *parts)

    return deep(Q, 11), deep(length, 12)


def pointers(q: np.ndarray, n: int, length: int = LENGTH) -> np.ndarray:
    """For each of the n windows the offset of its smallest q-gram identifier,
    leftmost on ties (the low bits hold the offset)."""
    low = (q & ~_POSITION) | np.arange(len(q), dtype=np.uint64)
    width, size = length - Q + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return (np.minimum(low[:n], low[width - size:width - size + n]) & _POSITION).astype(np.int64)


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Stretches [lo, hi) of the bytes with the offset before which the windows of
    each start: whole documents together, or parts of a long one that overlap so
    that no window is cut and none belongs to two."""
    for a, b in doc_blocks(offsets, BLOCK):
        lo, hi = offsets[a], offsets[b]
        if hi - lo <= 2 * BLOCK:
            yield lo, hi, hi, np.arange(a, b), offsets[a:b + 1]
        else:
            yield from ((s, min(s + BLOCK + 2 * length, hi), min(s + BLOCK, hi), np.array([a]), offsets[a:a + 2])
                        for s in range(int(lo), int(hi), BLOCK))


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(document, bucket, deeper identifier, first window, number of windows)
    of every run.

    A long document is worked on in stretches of 2^18 bytes; a run that crosses
    a stretch's end is two runs, which only makes two equal runs less likely to
    be found equal as a whole: their windows still are."""
    for lo, hi, stop_at, docs, ends in _pieces(offsets, length):
        part = data[lo:hi]
        n = len(part) - length + 1
        if n <= 0:
            continue
        q, w = identifiers(part, length)
        point = pointers(q, n, length)
        at = np.arange(n)
        doc = docs[np.searchsorted(ends, at + lo, "right") - 1]
        ok = (at + lo + length <= offsets[doc + 1]) & (at + lo < stop_at)
        new = ok.copy()
        new[1:] &= (point[1:] != point[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1]
        stop = ok.copy()
        stop[:-1] &= new[1:] | ~ok[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(stop)
        size = last - first + 1
        shift = point[first] - first
        deep = _name(13, w[first], w[last], size.astype(np.uint64), shift.astype(np.uint64))
        yield doc[first], q[point[first]], deep, first + lo - offsets[doc[first]], size


RUN = "bucket long, deep long, doc_id long, th long, at long, n int"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _run_rows(docs: DataFrame, length: int) -> DataFrame:
    """The runs of all documents.  Of equal runs of one batch the first keeps
    its bucket; the others are known to go: their n is negative, and they get a
    random bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(2))
            found = list(runs(data, offsets, length))
            if not found:
                continue
            doc, bucket, deep, at, n = (np.concatenate(x) for x in zip(*found, strict=True))
            ids, th = batch.column(0), batch.column(1).to_numpy()
            keys = np.rec.fromarrays([ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), th])
            _, one_of, place = np.unique(keys, return_index=True, return_inverse=True)
            own = one_of[place[doc]] == doc         # not of a row that repeats another
            doc, bucket, deep, at, n = (x[own] for x in (doc, bucket, deep, at, n))
            order = np.lexsort((at, place[doc], deep, bucket))
            again = np.zeros(len(order), bool)
            one, two = order[1:], order[:-1]
            again[one] = (bucket[one] == bucket[two]) & (deep[one] == deep[two])
            bucket[again] = _name(14, place[doc[again]].astype(np.uint64), at[again].astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [_signed(bucket), _signed(deep), ids.take(pa.array(doc)), pa.array(th[doc]), pa.array(at),
                 pa.array(np.where(again, -n, n).astype(np.int32))],
                ["bucket", "deep", "doc_id", "th", "at", "n"])

    return mapped(docs, run, RUN)


def _parts(bucket: np.ndarray, sent: int, chunk: int) -> tuple[np.ndarray, int, int]:
    """Of runs sorted by bucket, ``sent`` of the first one's having gone before: the
    part of each (-1 in a bucket of at most ``chunk``), how many stand before the
    last bucket, and how many the last one has had."""
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    size = np.diff(np.r_[first, len(bucket)])
    nth = np.arange(len(bucket)) - np.repeat(first, size)
    nth[:size[0]] += sent
    size_all = size.copy()
    size_all[0] += sent
    part = np.where(np.repeat(size_all, size) > chunk, nth // chunk, -1)
    return part.astype(np.int32), int(first[-1]), int(size_all[-1])


def _sort_out(chunk: int):
    """Step 1 over runs sorted by (bucket, deep, place): runs that go (n below
    zero), and the first of each kind in buckets that hold several, with the part
    of the bucket that they belong to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, pending = None, None    # the last row; a first run whose bucket may yet hold another
        rest, at, sent = None, None, 0  # first runs of the last bucket; how many of that bucket went out

        def dealt(found: list[pa.RecordBatch], last: bool) -> pa.RecordBatch | None:
            nonlocal rest, at, sent
            rows = pa.concat_batches(([rest] if rest is not None else []) + found)
            bucket = rows.column(0).to_numpy()
            part, ready, seen = _parts(bucket, sent if bucket[0] == at else 0, chunk)
            if last or seen > chunk:
                ready, at, sent = len(bucket), bucket[-1], seen
            rest = rows.slice(ready) if ready < len(bucket) else None
            return rows.slice(0, ready).append_column("part", pa.array(part[:ready])) if ready else None

        def whole(rows: pa.RecordBatch) -> pa.RecordBatch:
            return rows.append_column("part", pa.array(np.full(rows.num_rows, -1, np.int32)))

        for batch in batches:
            n = batch.column(5).to_numpy()
            gone = batch.filter(pa.array(n < 0))
            if gone.num_rows:
                yield whole(gone)
            batch = batch.filter(pa.array(n > 0))
            if not batch.num_rows:
                continue
            ids = batch.column(2)
            rows = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False),
                    ids.fill_null(0).to_numpy(), batch.column(3).to_numpy(), batch.column(4).to_numpy()]

            def changed(x, i, before=before):
                return np.r_[before is None or before[i] != x[0], x[1:] != x[:-1]]

            steps = [changed(x, i) for i, x in enumerate(rows)]
            new_bucket, new_deep = steps[0], steps[0] | steps[1]
            same = ~np.logical_or.reduce(steps)          # a row of a document that another batch holds too
            before, n = [x[-1] for x in rows], batch.column(5).to_numpy()
            first = np.flatnonzero(new_deep)
            if len(first):
                found = []
                follows = ~new_bucket[first]             # another run of the bucket comes before this one
                if pending is not None and follows[0]:
                    found.append(pending)
                mixed = follows.copy()
                mixed[:-1] |= follows[1:]
                pending = None if mixed[-1] else batch.slice(first[-1], 1)
                if mixed.any():
                    found.append(batch.take(pa.array(first[mixed])))
                if found and (got := dealt(found, False)) is not None:
                    yield got
            later = ~new_deep & ~same
            if later.any():
                yield whole(batch.filter(pa.array(later)).set_column(5, "n", pa.array(-n[later])))
        if rest is not None:
            yield dealt([], True)

    return run


BODY = "bucket long, part int, doc_id long, th long, at long, body binary"


def _bytes_of(docs: DataFrame, length: int) -> DataFrame:
    """The bytes that the runs ``todo`` (bucket, part, at, n) of each document cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(2))
            todo = batch.column(3)
            flat = todo.flatten()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(todo.offsets.to_numpy()))
            at, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            starts = offsets[doc] + at
            raw = memoryview(data)
            body = [raw[a:b].tobytes() for a, b in zip(starts, starts + n + length - 1, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [flat.field(0), flat.field(1), batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)),
                 flat.field(2), pa.array(body, pa.binary())], ["bucket", "part", "doc_id", "th", "at", "body"])

    return mapped(docs, run, BODY)


def refine(data: np.ndarray, depth: int) -> np.ndarray:
    """Bucket pointers of all suffixes: two share one if their first ``depth``
    bytes are equal.  A pointer is the rank of the bucket's first member.

    The first buckets are those of 8 bytes.  A round sorts the members of every
    bucket by the pointers found ``step`` bytes later and renames them; new names
    stay inside the old bucket's ranks, so the pointers of other buckets, which
    the next round reads, remain right.  A suffix alone in its bucket is settled:
    its pointer holds at every depth, and it is not sorted again."""
    n, known = len(data), 8
    padded = np.r_[data, np.zeros(known, np.uint8)].astype(np.uint64)
    gram = np.zeros(n, np.uint64)
    for k in range(known):
        gram = gram << np.uint64(8) | padded[k:n + k]
    active = np.argsort(gram, kind="stable")
    pointer = np.full(n + 1, -1)                # the last one is the end of the data
    own, later = np.zeros(n, np.int64), gram[active]
    while True:
        fresh = np.r_[True, own[1:] != own[:-1]]
        new = fresh | np.r_[True, later[1:] != later[:-1]]
        place = np.arange(len(active))
        within = np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(fresh, place, 0))
        pointer[active] = own + within
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(active)])
        active = active[np.repeat(size > 1, size)]
        if known >= depth or not len(active):
            return pointer[:n]
        step = min(known, depth - known)
        own, later = pointer[active], pointer[np.minimum(active + step, n)]
        order = np.lexsort((later, own))
        active, own, later = active[order], own[order], later[order]
        known += step


def _whole_groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows again, cut only where (bucket, part) changes: at most ``most`` of them, or one larger group."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        bucket, part = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
        at = 0
        while len(cuts) and at < cuts[-1]:
            to = int(cuts[max(np.searchsorted(cuts, at + most, "right") - 1, np.searchsorted(cuts, at, "right"))])
            yield rows.slice(at, to - at)
            at = to
        rest = rows.slice(at) if at < rows.num_rows else None
    if rest is not None:
        yield rest


WINDOWS = ("k1 long, k2 long, salt int, doc_id long, th long, at long, n int, sure boolean, stays boolean, "
           "held array<struct<k: int, name: long>>")


def _nth(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many rows of the same name stand before each, and whether a name has several."""
    order = np.lexsort((low, high))
    new = np.r_[True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])][:len(order)]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(order)])
    nth, several = np.empty(len(order), np.int32), np.empty(len(order), bool)
    nth[order] = np.arange(len(order)) - np.repeat(first, size)
    several[order] = np.repeat(size > 1, size)
    return nth, several


def _stretches(data: np.ndarray, offsets: np.ndarray, owner: np.ndarray, begin: np.ndarray, length: int):
    """Windows of runs (``owner``, ascending, and first byte) in stretches of at most ``STRETCH`` offsets of the pointer
    inside the window: the first window of each stretch, the 128-bit name of the bytes that all its windows hold, in two
    halves, and a name of each window."""
    size = np.diff(offsets)
    some = np.unique(owner)
    point, names = np.empty(len(owner), np.int64), np.empty(len(owner), np.uint64)
    for lo in range(0, len(some), CHUNK):               # an offset in ``pointers`` has 20 bits
        runs_here = some[lo:lo + CHUNK]
        mine = slice(*np.searchsorted(owner, (runs_here[0], runs_here[-1] + 1)))
        kept = np.zeros(len(size), bool)
        kept[runs_here] = True
        part = data[offsets[0]:offsets[-1]][np.repeat(kept, size)]
        shift = np.zeros(len(size), np.int64)           # of a run's bytes in ``part``
        shift[runs_here] = offsets[runs_here] - (np.cumsum(size[runs_here]) - size[runs_here])
        q, w = identifiers(part, length)
        local = begin[mine] - shift[owner[mine]]
        point[mine] = pointers(q, len(part) - length + 1, length)[local] + shift[owner[mine]]
        names[mine] = w[local]
    step = (point - begin) // STRETCH
    head = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (step[1:] != step[:-1])][:len(owner)])
    raw, near, far = memoryview(data), step[head] * STRETCH, np.minimum(step[head] * STRETCH + STRETCH - 1, length - Q)
    common = [xxhash.xxh3_128_intdigest(raw[p - a:p - b + length], int(a))
              for p, a, b in zip(point[head], near, far, strict=True)]
    halves = (np.array([c >> shift & (1 << 64) - 1 for c in common], np.uint64).view(np.int64) for shift in (64, 0))
    return head, *halves, names


def _window_scan(length: int):
    """Step 2 over runs sorted by (bucket, part, place): ranges of windows that go
    (``sure``), and the first windows of each part of a bucket that has several, a
    stretch of them in a row; k1 and k2 name the stretch's common bytes, or spread
    the sure rows.  A row ``stays`` if another one here has its name; only the first
    of these (salt 0) is sent to the rows of that name in other parts, so a name
    that very many runs share does not come to one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, CHUNK):
            ids = rows.column(2)
            keys = [rows.column(i).to_numpy() for i in (0, 1, 3, 4)]
            keys += [ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()]
            moved = [np.r_[True, x[1:] != x[:-1]] for x in keys]
            own = np.logical_or.reduce(moved)               # not a row that repeats another
            group = np.cumsum(moved[0] | moved[1])[own]
            rows = rows.filter(pa.array(own))
            bucket, part, at = (rows.column(i).to_numpy() for i in (0, 1, 4))
            data, offsets = utf8_column(rows.column(5))
            count = np.diff(offsets) - length + 1           # windows of each run
            owner = np.repeat(np.arange(rows.num_rows), count)
            k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            begin = offsets[owner] + k
            pointer = refine(data, length)[begin]
            _, first = np.unique(pointer * (group[-1] + 1) + group[owner], return_index=True)
            again = np.ones(len(owner), bool)
            again[first] = False
            turn = owner[1:] != owner[:-1]
            start = np.flatnonzero(again & np.r_[True, turn | ~again[:-1]])
            stop = np.flatnonzero(again & np.r_[turn | ~again[1:], True])
            meet = np.flatnonzero(~again & (part[owner] >= 0))
            head, high, low, names = _stretches(data, offsets, owner[meet], begin[meet], length)
            pick = np.r_[start, meet[head]]
            row = pa.array(owner[pick])
            where = at[owner[pick]] + k[pick]
            size = np.diff(np.r_[head, len(meet)])
            held = pa.StructArray.from_arrays([pa.array((k[meet] - np.repeat(k[meet[head]], size)).astype(np.int32)),
                                               pa.array(names.view(np.int64))], ["k", "name"])
            ends = pa.array(np.r_[np.zeros(len(start), np.int64), head, len(meet)].astype(np.int32))
            salt, several = _nth(high, low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[bucket[owner[start]], high]), pa.array(np.r_[where[:len(start)], low]),
                 pa.array(np.r_[np.zeros(len(start), np.int32), salt]), rows.column(2).take(row), rows.column(3).take(row), pa.array(where),
                 pa.array(np.r_[stop - start + 1, np.ones(len(head), np.int64)].astype(np.int32)),
                 pa.array(np.arange(len(pick)) < len(start)), pa.array(np.r_[np.ones(len(start), bool), several]),
                 pa.ListArray.from_arrays(ends, held)],
                ["k1", "k2", "salt", "doc_id", "th", "at", "n", "sure", "stays", "held"])

    return run


def _cut(docs: DataFrame, length: int) -> DataFrame:
    """Removes the windows' bytes: ``gone`` holds (at, n) of each run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            gone = batch.column(2).fill_null([]) if batch.column(2).null_count else batch.column(2)
            splits = gone.offsets.to_numpy()
            flat = gone.flatten()
            at, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            removed, count, digests, kept = [], [], [], []
            for i in range(batch.num_rows):
                raw = data[offsets[i]:offsets[i + 1]]
                part = slice(splits[i], splits[i + 1])
                edge = np.zeros(len(raw) + 1, np.int32)
                np.add.at(edge, at[part], 1)
                np.add.at(edge, at[part] + n[part] + length - 1, -1)
                dead = np.cumsum(edge[:-1]) > 0
                left = raw[~dead].tobytes()
                removed.append(int(dead.sum()))
                count.append(int((dead & ~np.r_[False, dead[:-1]]).sum()) if len(raw) else 0)
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                 pa.array(count, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return mapped(docs, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                "kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, chunk: int = PART) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` per input row.

    A null text is empty; a text shorter than ``length`` loses nothing.  Rows
    repeated whole (same doc_id, same text) are one document and get equal
    results; rows of one doc_id with different texts are ordered by a hash of
    the text; a null doc_id comes before all others.  Other columns are
    ignored; an empty table gives no rows."""
    if length < Q:
        raise ValueError(f"length must be at least {Q}")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    place = "doc_id", "th", "at"
    sorted_runs = _run_rows(keyed, length).repartition("bucket").sortWithinPartitions("bucket", "deep", *place)
    judged = staged(mapped(sorted_runs, _sort_out(chunk), f"{RUN}, part int"), "suffix-runs")

    key = "id", "null", "th"        # never null, so that one exchange serves a grouping and the join with the texts
    own = F.coalesce("doc_id", F.lit(0)).alias("id"), F.isnull("doc_id").alias("null")
    texts = keyed.select(*own, "doc_id", "th", "text")

    def with_text(lists: DataFrame, how: str) -> DataFrame:
        return texts.join(lists.hint("shuffle_merge"), list(key), how)

    todo = (judged.where("n > 0").select(*own, "th", F.struct("bucket", "part", "at", "n").alias("r")).groupBy(*key)
            .agg(F.collect_list("r").alias("todo")))
    bodies = _bytes_of(with_text(todo, "inner").select("doc_id", "th", "text", "todo"), length)
    dealt = bodies.repartition("bucket", "part").sortWithinPartitions("bucket", "part", *place)
    windows = mapped(dealt, _window_scan(length), WINDOWS)
    met = windows.withColumn("others", F.count(F.lit(1)).over(Window.partitionBy("k1", "k2", "salt"))).where(
        "stays or others > 1")
    met = met.select("k1", "k2", "doc_id", "th", "at", "n", "sure", F.explode_outer("held").alias("w")).select(
        "k1", "k2", F.col("w.name").alias("name"), "doc_id", "th", (F.col("at") + F.coalesce("w.k", F.lit(0))).alias("at"),
        "n", "sure").repartition("k1", "k2", "name")
    nth = F.row_number().over(Window.partitionBy("k1", "k2", "name").orderBy("sure", *place))
    twins = met.withColumn("nth", nth).where("sure or nth > 1").select(*place, "n")
    gone = (judged.where("n < 0").select(*place, (-F.col("n")).alias("n")).union(twins)
            .select(*own, "th", F.struct("at", "n").alias("r")).groupBy(*key).agg(F.collect_list("r").alias("gone")))
    return _cut(with_text(gone, "left").select("doc_id", "text", "gone"), length)
