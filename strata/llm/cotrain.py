"""Quality classification by co-training (operator 1).

Two views of a document: its text (frequencies of byte-class pairs, line and
word statistics) and its page metadata (language, source, size).  A logistic
classifier is trained on each view.  In every round each classifier labels the
documents of an unlabelled pool that it is most sure of, and hands them to the
*other* classifier as training rows.  At the end each view's scores are
calibrated on labelled documents kept aside (Platt), and a last logistic
function of the two calibrated views scores every document.

Fitting uses at most ``train_rows`` labelled and ``pool_rows`` unlabelled
documents (smallest hashes of doc_id; texts by at most PIECES pieces of PIECE
bytes spread over each): stated bounds on the fit.  Scoring reads every whole
text of all documents in one pass without a shuffle."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_sample, byte_pieces, doc_blocks, mapped, small_batches, utf8_column

TRAIN_ROWS, POOL_ROWS, PIECE, PIECES = 3000, 3000, 2048, 8
ROUNDS, SHARE, SURE = 5, 0.05, 0.9
BLOCK = 1 << 21

#: Classes of bytes; each listed character is one, then groups.
SINGLE = " \n\t.,;:!?'\"-_()[]{}<>#$%&*|/\\=+@~^"
GROUPS = ["aeiou", "bcdfghjklm", "npqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789"]
CLASS = np.zeros(256, np.int64)
CLASS[128:] = 1
for _i, _c in enumerate(SINGLE):
    CLASS[ord(_c)] = 2 + _i
for _i, _g in enumerate(GROUPS):
    for _c in _g:
        CLASS[ord(_c)] = 2 + len(SINGLE) + _i
CLASSES = 2 + len(SINGLE) + len(GROUPS)
PAIRS = CLASSES * CLASSES
EXTRA = 4
LANGS, SOURCES, SIZES = 32, 128, 24
META = LANGS + SOURCES + SIZES


def _extras(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Log length, share of different lines, mean line and word length."""
    out = np.zeros((len(offsets) - 1, EXTRA))
    for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
        raw = data[a:b].tobytes()
        lines = raw.split(b"\n")
        out[i] = (np.log1p(len(raw)) / 10, len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)) / 10,
                  np.log1p(len(raw) / (raw.count(b" ") + 1)) / 5)
    return out


def _pairs(data: np.ndarray) -> np.ndarray:
    c = CLASS[data]
    return c[:-1] * CLASSES + c[1:]


def text_features(texts: list[bytes]) -> np.ndarray:
    """Dense rows for fitting: pair frequencies (times ten) and the extras."""
    x = np.zeros((len(texts), PAIRS + EXTRA + 1), np.float32)
    for i, raw in enumerate(texts):
        data = np.frombuffer(raw, np.uint8)
        if len(data) > 1:
            x[i, :PAIRS] = np.bincount(_pairs(data), minlength=PAIRS) * (10 / (len(data) - 1))
        x[i, PAIRS:PAIRS + EXTRA] = _extras(data, np.array([0, len(data)]))
    x[:, -1] = 1
    return x


def text_logits(w: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The same linear function of whole texts, without building the rows."""
    z = np.empty(len(offsets) - 1)
    for a, b in doc_blocks(offsets, BLOCK):
        lo, hi = offsets[a], offsets[b]
        sums = np.zeros(hi - lo + 1)
        for s in range(int(lo), int(hi), BLOCK):        # a long text in stretches
            e = min(s + BLOCK, int(hi))
            part = w[_pairs(data[s:min(e + 1, int(hi))])]
            sums[s - lo + 1:s - lo + 1 + len(part)] = part
        np.cumsum(sums, out=sums)
        first, last = offsets[a:b] - lo, offsets[a + 1:b + 1] - lo
        n = np.maximum(last - first - 1, 0)             # pairs inside each text
        z[a:b] = np.where(n > 0, (sums[np.maximum(last - 1, first)] - sums[first]) * 10 / np.maximum(n, 1), 0)
    return z + _extras(data, offsets) @ w[PAIRS:PAIRS + EXTRA] + w[-1]


def meta_features(lang: list, source: list, size: np.ndarray) -> np.ndarray:
    """One-hot rows; unknown values and nulls have buckets like any other."""
    def bucket(value, n: int) -> int:
        return 0 if value is None else 1 + zlib.crc32(str(value).encode()) % (n - 1)

    x = np.zeros((len(size), META + 1), np.float32)
    rows = np.arange(len(size))
    x[rows, [bucket(v, LANGS) for v in lang]] = 1
    x[rows, [LANGS + bucket(v, SOURCES) for v in source]] = 1
    x[rows, LANGS + SOURCES + np.clip(np.log2(size + 1).astype(int), 0, SIZES - 1)] = 1
    x[:, -1] = 1
    return x


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.1, penalty: float = 1e-4) -> np.ndarray:
    """Full-batch Adam, classes weighted to balance."""
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)) / len(y)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        g = x.T @ ((p - y) * weight).astype(np.float32) + penalty * w
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def newton(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Logistic fit of a few columns, for calibration."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)),
                             x.T @ (p - y) + penalty * w)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    both: np.ndarray
    handed: list[tuple[int, int]]       # rows that text and metadata handed over in each round


def _calibrate(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    return newton(np.c_[z, np.ones(len(z))], y)


def _sure(p: np.ndarray, free: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The free rows with the most confident labels of either class."""
    order = np.flatnonzero(free)[np.argsort(p[free], kind="stable")]
    low, high = order[:rows], order[::-1][:rows]
    low, high = low[p[low] <= 1 - SURE], high[p[high] >= SURE]
    return np.r_[low, high], np.r_[np.zeros(len(low)), np.ones(len(high))]


def cotrain(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray) -> Model:
    """Rounds over both views; every third labelled row is kept aside to calibrate."""
    aside = np.arange(len(y)) % 3 == 2
    views = [text, meta]
    pools = [pool_text, pool_meta]
    own = [[v[~aside]] for v in views]
    marks = [[y[~aside]] for _ in views]
    free = [np.ones(len(pool_text), bool) for _ in views]       # what a view has not been handed yet
    handed = []
    weights = [logistic(v[0], m[0]) for v, m in zip(own, marks, strict=True)]
    for _ in range(ROUNDS):
        moved = []
        for k in (0, 1):
            a, b = _calibrate(views[k][aside] @ weights[k], y[aside])
            pick, label = _sure(_sigmoid(a * (pools[k] @ weights[k]) + b), free[1 - k],
                                max(1, int(SHARE * len(pool_text))))
            moved.append((pick, label))
        handed.append((len(moved[0][0]), len(moved[1][0])))
        for k, (pick, label) in enumerate(moved):
            if len(pick):
                own[1 - k].append(pools[1 - k][pick])
                marks[1 - k].append(label)
                free[1 - k][pick] = False
        if not any(handed[-1]):
            break
        weights = [logistic(np.concatenate(v), np.concatenate(m)) for v, m in zip(own, marks, strict=True)]
    scales = [_calibrate(v[aside] @ w, y[aside]) for v, w in zip(views, weights, strict=True)]
    z = np.c_[tuple(s[0] * (v[aside] @ w) + s[1] for v, w, s in zip(views, weights, scales, strict=True))]
    both = newton(np.c_[z, np.ones(len(z))], y[aside])
    return Model(weights[0], weights[1], scales[0], scales[1], both, handed)


def _columns(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
                       F.octet_length(text).alias("size"))


def _held_out(key):
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source", label_col: str = "quality", train_rows: int = TRAIN_ROWS,
        pool_rows: int = POOL_ROWS) -> Model | None:
    """Learns from labelled rows whose crc32(doc_id) mod 4 is not 1 (of several
    labels of a document the smallest counts); None without both classes."""
    key = F.col(id_col).cast("long")
    known = (labels.where(F.col(label_col).isNotNull() & key.isNotNull())
             .groupBy(key.alias("doc_id")).agg(F.min(F.col(label_col).cast("int")).alias("y")))
    some = bounded_sample(known.where(~_held_out(F.col("doc_id"))), "doc_id", train_rows)
    base = _columns(docs, id_col, text_col, lang_col, source_col)

    def rows(df: DataFrame) -> list:
        return df.withColumn("text", byte_pieces(F.col("text"), PIECE, PIECES)).collect()

    # both sides have a bound by a parameter: train_rows ids, pool_rows rows
    labelled = rows(base.join(F.broadcast(some), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id")))
    ids = base.select("doc_id").join(known.select("doc_id"), "doc_id", "left_anti").where("doc_id is not null")
    pool_ids = bounded_sample(ids.distinct(), "doc_id", pool_rows)
    pool = rows(base.join(F.broadcast(pool_ids), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id")))
    y = np.array([r["y"] for r in labelled], float)
    if len(y) < 6 or len(set(y[np.arange(len(y)) % 3 != 2])) < 2:
        return None

    def views(got: list) -> tuple[np.ndarray, np.ndarray]:
        return (text_features([b"".join(map(bytes, r["text"])) for r in got]),
                meta_features([r["lang"] for r in got], [r["source"] for r in got],
                              np.array([r["size"] for r in got], float)))

    return cotrain(*views(labelled), y, *views(pool))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(doc_id, held_out, text_score, meta_score, score, predicted)`` per row.

    Nulls in text, lang or source are values of their own (a null text is
    empty); a null doc_id stays null; repeated rows get equal scores; other
    columns are ignored.  If nothing could be learned every score is 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "text_score", "meta_score", "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in small_batches(batches, 2):
            n = batch.num_rows
            zt = zm = z = np.zeros(n)
            if m and n:
                data, offsets = utf8_column(batch.column(2))
                zt = m.text_scale[0] * text_logits(m.text, data, offsets) + m.text_scale[1]
                meta = meta_features(batch.column(3).to_pylist(), batch.column(4).to_pylist(),
                                     np.diff(offsets).astype(float))
                zm = m.meta_scale[0] * (meta @ m.meta) + m.meta_scale[1]
                z = np.c_[zt, zm, np.ones(n)] @ m.both
            p = _sigmoid(z)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(_sigmoid(zt)), pa.array(_sigmoid(zm)), pa.array(p),
                 pa.array((p >= 0.5).astype(np.int32))], names)

    base = _columns(docs, id_col, text_col, lang_col, source_col)
    return mapped(base.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "text", "lang", "source"), run,
                  "doc_id long, held_out boolean, text_score double, meta_score double, score double, predicted int")
