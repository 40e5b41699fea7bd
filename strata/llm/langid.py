"""Language identification by a byte convolutional network (operator 8).

Byte embeddings, filters of several widths, ReLU, max pooling over a window and
a softmax layer, trained in numpy on windows of labelled texts, then applied to
all consecutive fixed-length windows of every whole text.  A text's
probabilities are the mean over its windows, weighted by their bytes.

Training uses at most ``train_rows`` labelled rows (those with the smallest
hash of doc_id: the same rows at any partitioning) and at most
``windows_per_doc`` windows spread evenly over each: a stated bound on the fit;
prediction has none."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_sample, byte_pieces, mapped, ship_package, small_batches, utf8_column

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
TRAIN_ROWS, WINDOWS_PER_DOC, EPOCHS, BATCH = 4000, 4, 4, 64
STEP_WINDOWS = 256
KEEP_SCORE = 0.4


@dataclass
class ByteNet:
    """Weights; ``conv[w]`` maps w embedded bytes to the filters of width w."""
    labels: list[str]
    embed: np.ndarray
    conv: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.conv.values(), *self.bias.values(), self.out, self.out_bias]


def new_net(labels: list[str], seed: int) -> ByteNet:
    rng = np.random.default_rng(seed)
    f = np.float32
    return ByteNet(labels, rng.normal(0, 0.5, (256, EMBED)).astype(f),
                   {w: rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)).astype(f) for w in WIDTHS},
                   {w: np.zeros(FILTERS, f) for w in WIDTHS},
                   rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels))).astype(f), np.zeros(len(labels), f))


def _patches(x: np.ndarray, w: int) -> np.ndarray:
    n, size, e = x.shape
    view = np.lib.stride_tricks.as_strided(x, (n, size - w + 1, w * e), (x.strides[0], x.strides[1], x.itemsize))
    return view.reshape(-1, w * e)


def forward(net: ByteNet, windows: np.ndarray, keep: bool = False):
    """Class probabilities of (n, WINDOW) byte windows; with ``keep`` also what
    the backward pass needs."""
    x = net.embed[windows]
    pooled, kept = [], []
    for w in WIDTHS:
        act = (_patches(x, w) @ net.conv[w]).reshape(len(windows), -1, FILTERS)
        if keep:
            at = act.argmax(1)
            top = np.take_along_axis(act, at[:, None], 1)[:, 0]
            kept.append(at)
        else:
            top = act.max(1)
        pooled.append(np.maximum(top + net.bias[w], 0))
    hidden = np.concatenate(pooled, 1)
    logits = hidden @ net.out + net.out_bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    return (p, x, hidden, kept) if keep else p


def gradients(net: ByteNet, windows: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy, in the order of ``parameters``."""
    p, x, hidden, kept = forward(net, windows, keep=True)
    n = len(windows)
    d = p.copy()
    d[np.arange(n), y] -= 1
    d /= n
    d_hidden = (d @ net.out.T) * (hidden > 0)
    d_embed = np.zeros_like(net.embed)
    d_conv, d_bias = {}, {}
    rows = np.arange(n)[:, None]
    for k, w in enumerate(WIDTHS):
        g = d_hidden[:, k * FILTERS:(k + 1) * FILTERS]      # (n, F): only the position of the maximum has a gradient
        d_bias[w] = g.sum(0)
        d_conv[w] = np.zeros_like(net.conv[w])
        for j in range(w):
            at = kept[k] + j                                # (n, F)
            seen = x[rows, at]                              # (n, F, E)
            part = slice(j * EMBED, (j + 1) * EMBED)
            d_conv[w][part] = np.einsum("nf,nfe->ef", g, seen)
            np.add.at(d_embed, windows[rows, at].ravel(),
                      (g[:, :, None] * net.conv[w][part].T[None]).reshape(-1, EMBED))
    return [d_embed, *d_conv.values(), *d_bias.values(), hidden.T @ d, d.sum(0)]


def train(windows: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 7,
          rate: float = 3e-3) -> ByteNet:
    """Adam over shuffled batches; the seed fixes the result."""
    net, rng = new_net(labels, seed), np.random.default_rng(seed)
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            t += 1
            for p, g, m, v in zip(params, gradients(net, windows[pick], y[pick]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return net


def cut_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(n, WINDOW) bytes, zeros after the end of a short window."""
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < ends[:, None], data[np.minimum(at, max(len(data) - 1, 0))], 0).astype(np.uint8)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        train_rows: int = TRAIN_ROWS) -> ByteNet | None:
    """The network of the learning rows (crc32(doc_id) mod 5 other than 0, label
    and text not null); None if there is none."""
    key = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = (docs.where((key % 5 != 0) & F.col(label_col).isNotNull() & (F.length(text_col) > 0))
            .select(F.col(id_col).cast("long").alias("k"), F.col(label_col).cast("string").alias("y"),
                    F.col(text_col).cast("string").alias("text")))
    rows = rows.select("k", "y", byte_pieces(F.col("text"), WINDOW, WINDOWS_PER_DOC).alias("w"))
    sample = bounded_sample(rows, "k", train_rows).select("y", "w").collect()
    pairs = [(r["y"], bytes(w)) for r in sample for w in r["w"]]
    if not pairs:
        return None
    labels = sorted({y for y, _ in pairs})
    windows = np.zeros((len(pairs), WINDOW), np.uint8)
    for i, (_, w) in enumerate(pairs):
        windows[i, :len(w)] = np.frombuffer(w, np.uint8)
    index = {y: i for i, y in enumerate(labels)}
    return train(windows, np.array([index[y] for y, _ in pairs]), labels)


def has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def batch_probabilities(net: ByteNet, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, labels): byte-weighted mean over all windows of each text;
    zeros for an empty one."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][doc] + nth * WINDOW
    ends = np.minimum(starts + WINDOW, offsets[1:][doc])
    total = np.zeros((len(sizes), len(net.labels)))
    for a in range(0, len(doc), STEP_WINDOWS):
        part = slice(a, a + STEP_WINDOWS)
        p = forward(net, cut_windows(data, starts[part], ends[part]))
        np.add.at(total, doc[part], p * (ends[part] - starts[part])[:, None])
    return total / np.maximum(sizes, 1)[:, None]


def _judge(net: ByteNet | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    data, offsets = utf8_column(column)
    n = len(column)
    p = batch_probabilities(net, data, offsets) if net else np.zeros((n, 1))
    best, score = p.argmax(1), np.clip(p.max(1), 0, 1)
    letter = np.zeros(len(data) + 1, np.int64)
    low = data | 32
    np.cumsum((low >= 97) & (low <= 122) & (data < 128), out=letter[1:])
    plain = letter[offsets[1:]] > letter[offsets[:-1]]
    names = []
    for i in range(n):
        known = net is not None and (plain[i] or has_letter(data[offsets[i]:offsets[i + 1]].tobytes()))
        names.append(net.labels[best[i]] if known else "und")
        if not known:
            score[i] = 0.0
    return names, score


def identify(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for each row.  A null or empty
    text, one without a letter, and any text if nothing could be learned are
    ``und`` with score 0.  A null doc_id is never held out.  Other columns are
    ignored; repeated rows get equal results."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            names, score = _judge(shared.value, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()),
                                              pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"),
                              F.col(text_col).cast("string").alias("text")), run,
                  "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, net: ByteNet | None, text_col: str = "text", least: float = KEEP_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or less sure than
    ``least``; one pass, all columns as they are: only the text goes to Python."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("boolean")
    def known(column: pa.Array) -> pa.Array:
        keep = []
        for part in small_batches([pa.record_batch([column], ["text"])], 0):
            names, score = _judge(shared.value, part.column(0))
            keep.append(np.array([x != "und" for x in names], bool) & (score >= least))
        return pa.array(np.concatenate(keep) if keep else np.empty(0, bool))

    return docs.where(known(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
