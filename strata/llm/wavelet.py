"""Token ids as wavelet matrices, one compressed file per shard (operator 11).

The documents are range-partitioned by doc_id (ties by the text's hash and the row's
place, so that a repeated id is split as well) and sorted inside a partition.  One
task tokenizes its documents in that order, appends the end id, and closes a file
whenever ``shard_tokens`` ids are reached.  A file holds one bit-plane per binary digit of an id, the
highest first; each plane lists the digits in the order left by the plane above,
which moves zeros before ones, both in their order.  Planes are cut into blocks of
``BLOCK`` bits, compressed one by one, and a directory gives the ones before each
block: rank is a directory entry and one block, select a search of the directory
and one block.  So a token is read, counted or found by touching one or two blocks
of each plane; the document directory says where each document ends.

Files are written through Spark's own writer (its text format, one record a file,
whose closing line end belongs to the format), so a lost executor leaves no
half-written shard and any storage Spark can write will do.  They are read back as
binary files.  The folder name of a file tells its partition, its start in there and
its length: the global starts come from the listing, a total for each partition, without opening a file."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ensure_checkpoint_dir, mapped, small_batches
from strata.llm.packing import RANKS, VOCABULARY, encoder

END, SHARD_TOKENS, PARTITION_BYTES = 2, 1 << 23, 1 << 26
BLOCK = 1 << 15                     # bits of a block
MAGIC = b"WVMX"
HEAD = struct.Struct("<4sIQQQ")     # magic, planes, ids, documents, bytes of the document directory


def build(ids: np.ndarray, doc_ids: list[int | None], sizes: list[int]) -> bytes:
    """The file of a shard: its ids and, in order, each document's id and number of ids."""
    pack = zstandard.ZstdCompressor(level=1).compress
    planes = max(1, int(ids.max(initial=0)).bit_length())
    n, step = len(ids), BLOCK // 8
    known = np.array([i is not None for i in doc_ids], np.uint8)
    numbers = np.array([i or 0 for i in doc_ids], "<i8")
    docs = pack(known.tobytes() + numbers.tobytes() + np.cumsum(sizes, dtype="<i8").tobytes())
    out = [HEAD.pack(MAGIC, planes, n, len(doc_ids), len(docs)), docs]
    order = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    for shift in range(planes - 1, -1, -1):
        digit = (order >> shift & 1).astype(bool)
        plane = np.packbits(digit, bitorder="little")
        starts = np.arange(0, len(plane), step)
        ones = np.add.reduceat(np.bitwise_count(plane), starts, dtype=np.int64) if n else np.empty(0, np.int64)
        blocks = []
        for at in starts:
            raw = plane[at:at + step].tobytes()
            small = pack(raw)
            blocks.append(small if len(small) < len(raw) else raw)
        before = np.concatenate([[0], np.cumsum(ones)])
        places = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
        out += [before.astype("<i8").tobytes(), places.astype("<i8").tobytes(), *blocks]
        order = np.concatenate([order[~digit], order[digit]])
    return b"".join(out)


class Wavelet:
    """A shard's file: token access, counting and occurrence lookup."""

    def __init__(self, data, cached: int = 64):
        data = memoryview(data)
        magic, self.planes, self.n, self.docs, size = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self._unpack = zstandard.ZstdDecompressor().decompress
        raw = self._unpack(data[HEAD.size:HEAD.size + size]) if size else b""
        self.known = np.frombuffer(raw, np.uint8, self.docs).astype(bool)
        self.doc_ids = np.frombuffer(raw, "<i8", self.docs, self.docs)
        self.ends = np.frombuffer(raw, "<i8", self.docs, 9 * self.docs)
        at, blocks = HEAD.size + size, -(-self.n // BLOCK)
        self.before, self._places, self._data = [], [], []
        for _ in range(self.planes):
            self.before.append(np.frombuffer(data, "<i8", blocks + 1, at))
            self._places.append(np.frombuffer(data, "<i8", blocks + 1, at + 8 * (blocks + 1)))
            at += 16 * (blocks + 1)
            self._data.append(data[at:at + int(self._places[-1][-1])])
            at += int(self._places[-1][-1])
        self.zeros = [self.n - int(b[-1]) for b in self.before]
        self._cache: OrderedDict = OrderedDict()
        self._cached = cached

    def _raw(self, plane: int, block: int) -> bytes:
        lo, hi = self._places[plane][block:block + 2]
        raw = self._data[plane][lo:hi]
        want = min(BLOCK // 8, -(-(self.n - block * BLOCK) // 8))
        return bytes(raw) if len(raw) == want else self._unpack(raw)

    def _ones(self, plane: int, block: int) -> np.ndarray:
        """Ones before each place of a block, and in all of it."""
        key = plane, block
        if key not in self._cache:
            bits = np.unpackbits(np.frombuffer(self._raw(plane, block), np.uint8), bitorder="little")
            self._cache[key] = np.concatenate([[0], np.cumsum(bits, dtype=np.int32)])
            if len(self._cache) > self._cached:
                self._cache.popitem(last=False)
        self._cache.move_to_end(key)
        return self._cache[key]

    def rank(self, plane: int, at: int) -> int:
        """Ones of a plane before place ``at``."""
        block, inside = divmod(at, BLOCK)
        if block == len(self.before[plane]) - 1:
            return int(self.before[plane][-1])
        return int(self.before[plane][block]) + int(self._ones(plane, block)[inside])

    def select(self, plane: int, digit: int, nth: int) -> int:
        """The place of the n-th (from 0) one or zero of a plane."""
        before = self.before[plane]
        if not digit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before[:-1], nth, "right")) - 1
        ones = self._ones(plane, block)
        inside = ones if digit else np.arange(len(ones)) - ones
        return block * BLOCK + int(np.searchsorted(inside, nth - int(before[block]), "right")) - 1

    def access(self, at: int) -> int:
        """The id at a place of the shard."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        token = 0
        for plane in range(self.planes):
            ones = self.rank(plane, at)
            digit = self.rank(plane, at + 1) - ones
            token = 2 * token + digit
            at = self.zeros[plane] + ones if digit else at - ones
        return token

    def _stretch(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """The token's occurrences in [lo, hi), as a stretch below the last plane."""
        if token >> self.planes:
            return 0, 0
        for plane in range(self.planes):
            a, b = self.rank(plane, lo), self.rank(plane, hi)
            if token >> (self.planes - 1 - plane) & 1:
                lo, hi = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in places [lo, hi)."""
        a, b = self._stretch(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, token: int, lo: int = 0, hi: int | None = None) -> Iterator[int]:
        """The places of an id in [lo, hi), ascending."""
        a, b = self._stretch(token, lo, self.n if hi is None else hi)
        for at in range(a, b):
            for plane in range(self.planes - 1, -1, -1):
                if token >> (self.planes - 1 - plane) & 1:
                    at = self.select(plane, 1, at - self.zeros[plane])
                else:
                    at = self.select(plane, 0, at)
            yield at

    def tokens(self) -> np.ndarray:
        """All ids: the planes' moves undone from the last to the first."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        below = np.zeros(self.n, kind)
        for plane in range(self.planes - 1, -1, -1):
            raw = b"".join(self._raw(plane, b) for b in range(len(self.before[plane]) - 1))
            digit = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").astype(bool)
            here = np.empty(self.n, kind)
            here[~digit] = below[:self.zeros[plane]]
            here[digit] = below[self.zeros[plane]:] | kind(1 << (self.planes - 1 - plane))
            below = here
        return below

    def document(self, at: int) -> tuple[int | None, int]:
        """The document that holds a place, and the place inside it."""
        d = int(np.searchsorted(self.ends, at, "right"))
        return (int(self.doc_ids[d]) if self.known[d] else None), at - (int(self.ends[d - 1]) if d else 0)


def write(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end: int = END,
          shard_tokens: int = SHARD_TOKENS, partition_bytes: int = PARTITION_BYTES, vocabulary: str = VOCABULARY,
          ranks: str = RANKS) -> str:
    """Writes the shards of ``docs`` to a new folder below the shared checkpoint folder and returns its path.

    Documents stand in ascending id order, a null id first; rows of one id by the hash of their text.  A null
    or empty text is the end id alone.  A file ends with the document that fills it, so it holds at most
    ``shard_tokens`` ids and one document.  An empty table gives an empty folder.  Other columns are ignored."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        part, at = TaskContext.get().partitionId(), 0
        parts, names, sizes, held = [], [], [], 0

        def shard() -> pa.RecordBatch:
            file = build(np.concatenate(parts), names, sizes)
            return pa.RecordBatch.from_arrays([pa.array([f"p{part:06d}_{at}_{held}"]), pa.array([file], pa.binary())],
                                              ["shard", "file"])

        for batch in small_batches(batches, 1):
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                got = encode(text.as_py() or "")
                got.append(end)
                parts.append(np.array(got, np.uint32))
                names.append(doc.as_py())
                sizes.append(len(got))
                held += len(got)
                if held >= shard_tokens:
                    yield shard()
                    at += held
                    parts, names, sizes, held = [], [], [], 0
        if held:
            yield shard()

    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = max(2 * spark.sparkContext.defaultParallelism, -(-size // partition_bytes))
    keys = ["doc_id", "_hash", "_row"]
    dealt = (docs.select(doc.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_hash"),
                         F.monotonically_increasing_id().alias("_row"))
             .repartitionByRange(partitions, *keys).sortWithinPartitions(*keys).select("doc_id", "text"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-llm/wavelet-{uuid.uuid4().hex}"
    (mapped(dealt, run, "shard string, file binary").select(F.col("file").cast("string").alias("value"), "shard")
     .write.partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(path))
    return path


def shards(spark: SparkSession, path: str) -> DataFrame:
    """``(start, file)`` of every shard that ``write`` left in a folder; ``start`` counts the ids of all shards
    before it.  The starts come from the names in the listing."""
    files = spark.read.format("binaryFile").load(path)
    if "shard" not in files.columns:
        return spark.createDataFrame([], "start long, file binary")
    name = F.split("shard", "_")
    files = files.withColumn("part", F.substring(name[0], 2, 20).cast("int"))
    totals = files.groupBy("part").agg(F.sum(name[2].cast("long")).alias("n")).orderBy("part").collect()
    starts = np.concatenate([[0], np.cumsum([r["n"] for r in totals])]).tolist()     # a row for each partition
    base = spark.createDataFrame([(r["part"], s) for r, s in zip(totals, starts, strict=False)], "part int, base long")
    return (files.join(F.broadcast(base), "part")
            .select((F.col("base") + name[1].cast("long")).alias("start"), F.col("content").alias("file")))


def _of_files(files: DataFrame, rows, schema: str) -> DataFrame:
    """``rows(start, shard)`` gives the columns of ``schema`` for one file."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, file in zip(batch.column(0), batch.column(1), strict=True):
                cols = rows(start.as_py(), Wavelet(file.as_buffer()))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    return mapped(files.select("start", "file"), run, schema)


def documents(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, from the files alone."""

    def rows(start: int, shard: Wavelet) -> list[list]:
        raw = memoryview(shard.tokens().astype("<u4").tobytes())
        ends = shard.ends.tolist()
        begins = [0, *ends[:-1]]
        return [[i if ok else None for i, ok in zip(shard.doc_ids.tolist(), shard.known, strict=True)],
                [start + b for b in begins], [e - b for b, e in zip(begins, ends, strict=True)],
                [zlib.crc32(raw[4 * b:4 * e]) for b, e in zip(begins, ends, strict=True)]]

    return _of_files(files, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_tokens(files: DataFrame, tokens: list[int]) -> DataFrame:
    """``(token, n)``: how often each id occurs; one rank pair per plane and file."""

    def rows(start: int, shard: Wavelet) -> list[list]:
        return [tokens, [shard.count(t) for t in tokens]]

    return _of_files(files, rows, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def find_token(files: DataFrame, token: int) -> DataFrame:
    """``(doc_id, at, place)`` of every occurrence of an id: in its document and in the whole stream."""

    def rows(start: int, shard: Wavelet) -> list[list]:
        places = list(shard.occurrences(token))
        inside = [shard.document(p) for p in places]
        return [[d for d, _ in inside], [a for _, a in inside], [start + p for p in places]]

    return _of_files(files, rows, "doc_id long, at long, place long")


def read_tokens(files: DataFrame, lo: int, hi: int) -> DataFrame:
    """``(place, token)`` of the places [lo, hi) of the whole stream; other parts of the files stay packed."""

    def rows(start: int, shard: Wavelet) -> list[list]:
        places = range(max(lo - start, 0), max(min(hi - start, shard.n), 0))
        return [[start + p for p in places], [shard.access(p) for p in places]]

    return _of_files(files, rows, "place long, token long")
