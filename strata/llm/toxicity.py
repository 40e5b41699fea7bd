"""Toxicity by compression distance (operator 9).

Two kinds of window are compared, each by its lengths under separate zstandard
dictionaries that were trained on toxic and on ordinary text:

* stretches of ``WINDOW`` bytes: with the ordinary dictionary, and with the
  ordinary and the toxic one together (the toxic one holds runs of bytes whose
  6-grams are many times as frequent in toxic documents);
* words (at most ``WORD`` bytes each, longer ones in parts): with the words of
  ordinary text, and with the words of toxic text that hold a telling 6-gram.
  Texts fall into groups by their own byte trigrams (spherical k-means), and a
  group has its own two dictionaries, so the wording of a small language is not
  outweighed by a large one.

The bytes saved are a window's gain.  A text's score is a logistic function of
its largest and mean gains and of the share of windows over a gain.  The
sampled texts get the features, computed over whole texts in tasks by the code
that scores, from dictionaries of the half that does not hold them; each
group's weights are drawn to those of all groups.  Scores are shifted so that
``FALSE_ALARMS`` of the ordinary texts so measured lie at or over 0.7.

Dictionaries are trained on at most ``train_rows`` labelled documents of either
class (the smallest hashes of doc_id) and at most ``PIECES`` pieces of ``PIECE``
bytes, spread evenly over each: a stated bound on the fit; scoring has none."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_sample, byte_pieces, mapped, small_batches

TRAIN_ROWS, PIECE, PIECES = 3000, 1024, 16
WINDOW, STEP, LEVEL = 64, 48, 9
WORD, LEAST_WORD, WORDS_SIZE, STRETCH_WORDS = 48, 5, 16384, 64
ORDINARY_SIZE, TOXIC_SIZE = 16384, 4096
GRAM, BITS, RATIO, FLOOR, LEAST_SHARE = 6, 20, 10.0, 2.0, 0.03
LEAST_TEXTS, LEAST_Z, LEAST_LIFT = 3, 4.0, 4.0
GROUPS, GROUP_TEXTS, PROFILE_BITS = 8, 8, 12
THRESHOLD, FALSE_ALARMS = 0.7, 0.01
GAIN_STEPS, WORD_STEPS = (2, 4, 6), (1, 2, 3, 5)
MEMO = 50_000           # words a worker remembers for each group


@dataclass
class Dictionaries:
    """Of one set of texts: the two for stretches, and a pair of word dictionaries for each group."""
    ordinary: bytes
    toxic: bytes
    words: list[tuple[bytes, bytes]]


@dataclass
class Model:
    centres: np.ndarray
    dictionaries: Dictionaries
    weights: np.ndarray         # a row for each group
    centre: np.ndarray
    scale: np.ndarray
    shift: float


def _grams(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = max(0, len(a) - GRAM + 1)
    h = np.zeros(n, np.uint64)
    for j in range(GRAM):
        h = h * np.uint64(0x100000001B3) + a[j:j + n]
    return (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


def _gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of each gram per million, and the share of texts that hold it."""
    times, held = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for raw in texts:
        gram, n = np.unique(_grams(raw), return_counts=True)
        times[gram] += n
        held[gram] += 1
    return times * (1e6 / max(1, times.sum())), held / max(1, len(texts))


def telling_pieces(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Runs of toxic text whose grams are at least RATIO times as frequent there
    as in ordinary text, and not confined to a few texts."""
    (a, share), (b, _) = _gram_counts(toxic), _gram_counts(ordinary)
    telling = (a >= RATIO * (b + FLOOR)) & (share >= max(LEAST_SHARE, 2 / len(toxic)))
    out = []
    for raw in toxic:
        at = np.flatnonzero(telling[_grams(raw)])
        edge = np.zeros(len(raw) + 1, np.int32)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + GRAM, -1)
        ends = np.flatnonzero(np.diff(np.r_[False, np.cumsum(edge[:-1]) > 0, False]))
        out += [raw[s:t] for s, t in zip(ends[::2], ends[1::2], strict=True)]
    return out


def telling_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words of toxic text, as often as they occur, that hold a 6-gram (the space
    before counts) which far more toxic than ordinary texts hold: LEAST_LIFT
    times the share and LEAST_Z standard errors apart."""
    n, m = max(1, len(toxic)), max(1, len(ordinary))
    a, b = (np.round(_gram_counts(t)[1] * max(1, len(t))) for t in (toxic, ordinary))
    p = (a + b) / (n + m)
    z = (a / n - b / m) / np.sqrt(p * (1 - p) * (1 / n + 1 / m) + 1e-12)
    telling = (a >= LEAST_TEXTS) & (z >= LEAST_Z) & ((a + 0.5) / (n + 1) >= LEAST_LIFT * (b + 0.5) / (m + 1))
    out = []
    for raw in toxic:
        here = telling[_grams(raw)]
        at = 0
        for word in raw.split():
            at = raw.index(word, at)
            end = at + len(word)
            first = max(0, at - 1)
            if here[first:max(first + 1, end - GRAM + 2)].any():
                out += _parts(word)
            at = end
    return out


def _parts(word: bytes) -> list[bytes]:
    return [word] if len(word) <= WORD else [word[i:i + WORD] for i in range(0, len(word), WORD)]


def _word_dictionary(words: Counter) -> bytes:
    """The most frequent words, the commonest last, where offsets are shortest."""
    kept, size = [], 0
    for word, _ in sorted(words.items(), key=lambda x: (-x[1], x[0])):
        size += len(word) + 1
        if size > WORDS_SIZE:
            break
        kept.append(word)
    return b" " + b" ".join(reversed(kept)) + b" " * 8


def profiles(texts: list[bytes]) -> np.ndarray:
    """Unit vectors of square roots of hashed byte-trigram counts."""
    out = np.zeros((len(texts), 1 << PROFILE_BITS), np.float32)
    for row, raw in zip(out, texts, strict=True):
        a = np.frombuffer(raw, np.uint8).astype(np.uint64)
        if len(a) > 2:
            h = a[:-2] << np.uint64(16) | a[1:-1] << np.uint64(8) | a[2:]
            h = h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PROFILE_BITS)
            v = np.sqrt(np.bincount(h.astype(np.int64), minlength=len(row)))
            row[:] = v / np.linalg.norm(v)
    return out


def group_centres(p: np.ndarray, y: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from the rows farthest apart; groups with fewer than
    GROUP_TEXTS texts of a class are given up, smallest first."""
    centres = p[[int(np.argmax(p @ p.mean(0)))]]
    for _ in range(min(GROUPS, len(p)) - 1):
        centres = np.r_[centres, p[[int(np.argmin((p @ centres.T).max(1)))]]]
    for _ in range(rounds):
        own = np.argmax(p @ centres.T, 1)
        centres = np.array([p[own == g].mean(0) if (own == g).any() else c for g, c in enumerate(centres)])
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-9
    while len(centres) > 1:
        own = np.argmax(p @ centres.T, 1)
        least = np.minimum(*(np.bincount(own[y == v], minlength=len(centres)) for v in (0, 1)))
        if least.min() >= GROUP_TEXTS:
            break
        centres = np.delete(centres, int(np.argmin(least)), 0)
    return centres


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples to train on are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:] or b" " * 8


def _compressor(raw: bytes):
    """The same table sizes for any dictionary, so that lengths differ by content alone."""
    p = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, window_log=17, hash_log=16, chain_log=16, min_match=4, write_content_size=False, write_dict_id=False,
        write_checksum=False)
    d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress


class Gains:
    """Compressors of one set of dictionaries, and the word gains already known."""

    def __init__(self, d: Dictionaries):
        self.plain, self.both = _compressor(d.ordinary), _compressor(d.toxic + d.ordinary)
        self.words = [(_compressor(o), _compressor(t), {}) for o, t in d.words]

    def stretches(self, raw: bytes) -> list[int]:
        return [len(self.plain(w)) - len(self.both(w)) for at in range(0, max(1, len(raw) - WINDOW + STEP), STEP)
                if (w := raw[at:at + WINDOW])]

    def word_gains(self, raw: bytes, group: int) -> list[int]:
        """Words too short for zstandard to save a byte gain 0."""
        plain, toxic, known = self.words[group]
        if len(known) > MEMO:
            known.clear()
        out = []
        for whole in raw.split():
            for word in _parts(whole):
                if len(word) < LEAST_WORD:
                    out.append(0)
                    continue
                if word not in known:
                    w = b" " + word + b" "
                    known[word] = len(plain(w)) - len(toxic(w))
                out.append(known[word])
        return out


def features_of(raw: bytes, gains: Gains, group: int) -> list[float]:
    """Of one lower-case text: largest and mean gains of its stretches and words, shares and numbers over some gains."""
    g = np.array(gains.stretches(raw) or [0])
    over = [int((g >= s).sum()) for s in GAIN_STEPS]
    out = [*np.r_[np.sort(g)[::-1][:3], 0, 0, 0][:3], *[x / len(g) for x in over], *np.log1p(over), np.log1p(len(g))]
    w = np.array(gains.word_gains(raw, group) or [0])
    over = [int((w >= s).sum()) for s in WORD_STEPS]
    sums = np.cumsum(np.r_[0, np.maximum(w, 0)])
    k = min(STRETCH_WORDS, len(w))
    best = (sums[k:] - sums[:-k]).max() / k                     # the densest stretch of words
    return [float(x) for x in [
        *out, *np.r_[np.sort(w)[::-1][:3], 0, 0, 0][:3], w.mean(), np.maximum(w - 1, 0).mean(), best,
        *[x / len(w) for x in over], *np.log1p(over), np.log1p(len(w))]]


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton steps, drawn to ``prior``; the last column of x is one."""
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def _standard(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.c_[(x - centre) / scale, np.ones(len(x))]


def _scores(model: Model, x: np.ndarray, group: np.ndarray) -> np.ndarray:
    z = (_standard(x, model.centre, model.scale) * model.weights[group]).sum(1) + model.shift
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_dictionaries(texts: list[bytes], y: np.ndarray, group: np.ndarray, groups: int) -> Dictionaries:
    def some(label: int, g: int | None = None) -> list[bytes]:
        return [t for t, v, h in zip(texts, y, group, strict=True) if v == label and (g is None or h == g)]

    toxic, ordinary = some(1), some(0)
    plain = _dictionary(ORDINARY_SIZE, [raw[i:i + 512] for raw in ordinary for i in range(0, len(raw), 512)])
    extra = _dictionary(TOXIC_SIZE, [b" " + p + b" " for p in (telling_pieces(toxic, ordinary) if toxic else [])])
    words = []
    for g in range(groups):
        usual = Counter(part for raw in some(0, g) for w in raw.split() for part in _parts(w))
        words.append((_word_dictionary(usual), _word_dictionary(Counter(telling_words(some(1, g), some(0, g))))))
    return Dictionaries(plain, extra, words)


def train_scale(centres: np.ndarray, whole: Dictionaries, x: np.ndarray, y: np.ndarray, group: np.ndarray) -> Model:
    centre, scale = x.mean(0), x.std(0) + 1e-6
    a = _standard(x, centre, scale)
    shared = _logistic(a, y, np.zeros(a.shape[1]))
    weights = np.array([_logistic(a[group == g], y[group == g], shared) for g in range(len(centres))])
    z = (a * weights[group]).sum(1)
    shift = np.log(THRESHOLD / (1 - THRESHOLD)) - np.quantile(z[y == 0], 1 - FALSE_ALARMS)
    return Model(centres, whole, weights, centre, scale, float(shift))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model | None:
    """Learns from rows whose crc32(doc_id) mod 3 is not 1.  A doc_id with
    several labels counts as toxic if one says so."""
    key = F.col(id_col).cast("long")
    known = (labels.where(F.col(label_col).isNotNull() & key.isNotNull())
             .where(F.crc32(key.cast("string").cast("binary")) % 3 != 1)
             .groupBy(key.alias("k")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    some = (bounded_sample(known.where("y = 1"), "k", train_rows).select("k", "y")
            .unionByName(bounded_sample(known.where("y = 0"), "k", train_rows).select("k", "y")))
    # at most 2 * train_rows ids, so the side that is broadcast has a bound
    kept = (docs.select(key.alias("k"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(some), "k").groupBy("k", "y").agg(F.lower(F.min("text")).alias("text"))
            .where("text != ''").withColumn("half", F.pmod(F.xxhash64("k", F.lit(7)), F.lit(2)).cast("int")))
    rows = (kept.select("k", "y", "half", byte_pieces(F.col("text"), PIECE, PIECES).alias("p"))
            .orderBy(F.xxhash64("k"), "k").collect())
    texts = [b"".join(map(bytes, r["p"])) for r in rows]
    y, half = (np.array([r[c] for r in rows], np.int64) for c in ("y", "half"))
    if min((y == 1).sum(), (y == 0).sum()) < 2:
        return None
    p = profiles(texts)
    centres = group_centres(p, y)
    group = np.argmax(p @ centres.T, 1)

    def learnt(pick: np.ndarray) -> Dictionaries:
        return train_dictionaries([t for t, k in zip(texts, pick, strict=True) if k], y[pick], group[pick], len(centres))

    # a text's features come from the dictionaries of the other half
    other = docs.sparkSession.sparkContext.broadcast((centres, [learnt(half != h) for h in (0, 1)]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, pair = other.value
        gains = [Gains(d) for d in pair]
        for batch in small_batches(batches, 3):
            raws = [t.as_py().encode() for t in batch.column(3)]
            own = np.argmax(profiles(raws) @ middle.T, 1) if raws else np.zeros(0, np.int64)
            x = [features_of(raw, gains[h.as_py()], g) for raw, h, g in zip(raws, batch.column(2), own, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own.astype(np.int32)), pa.array(x, pa.list_(pa.float64()))],
                ["k", "y", "g", "x"])

    measured = (mapped(kept.select("k", "y", "half", "text"), measure, "k long, y int, g int, x array<double>")
                .orderBy("k").collect())
    return train_scale(centres, learnt(half >= 0), np.array([r["x"] for r in measured]),
                       *(np.array([r[c] for r in measured], np.int64) for c in ("y", "g")))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row.  A null or empty text is
    scored like a text without gains; if nothing could be learned every score is
    0.  A null doc_id is never held out.  Other columns are ignored; repeated
    rows get equal results."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        gains = Gains(m.dictionaries) if m else None
        for batch in small_batches(batches, 2):
            got = np.zeros(batch.num_rows)
            for lo in range(0, batch.num_rows if m else 0, 1024):       # 16 MB of profiles at once
                raws = [(t.as_py() or "").encode() for t in batch.column(2)[lo:lo + 1024]]
                own = np.argmax(profiles(raws) @ m.centres.T, 1)
                x = np.array([features_of(raw, gains, g) for raw, g in zip(raws, own, strict=True)])
                got[lo:lo + 1024] = _scores(m, x, own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got), pa.array((got >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"),
                              F.lower(F.col(text_col).cast("string")).alias("text")), run,
                  "doc_id long, held_out boolean, score double, predicted int")
