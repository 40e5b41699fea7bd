"""Operators 11 to 13 against plain versions."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import lexical, negatives, wavelet

from .conftest import SF, pairs, rows


# --- operator 11 --------------------------------------------------------------------
@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=60), st.integers(0, 301))
def test_wavelet_answers_as_the_list_does(ids, token):
    w = wavelet.Wavelet(wavelet.build(np.array(ids, np.uint32), [7], [len(ids)]) + b"\n")
    assert w.tokens().tolist() == ids == [w.access(i) for i in range(len(ids))]
    assert w.count(token) == ids.count(token)
    lo, hi = len(ids) // 4, len(ids) - len(ids) // 3
    assert w.count(token, lo, hi) == ids[lo:hi].count(token)
    for t in {token, *ids[:3]}:
        assert list(w.occurrences(t)) == [i for i, x in enumerate(ids) if x == t]


def test_wavelet_over_many_blocks():
    rng = np.random.default_rng(3)
    ids = np.where(rng.random(150_000) < 0.3, 11, rng.integers(0, 50_257, 150_000)).astype(np.uint32)
    ids[40_000:90_000] = 65_535
    w = wavelet.Wavelet(wavelet.build(ids, [None, 3], [100_000, 50_000]), cached=3)
    assert np.array_equal(w.tokens(), ids)
    for at in (0, 32_767, 32_768, 99_999, 149_999):
        assert w.access(at) == ids[at]
    for token in (11, 65_535, 50_256, int(ids[-1])):
        places = np.flatnonzero(ids == token)
        assert w.count(token) == len(places) and w.count(token, 33_000, 120_001) == (
            (places >= 33_000) & (places < 120_001)).sum()
        assert list(w.occurrences(token, 30_000, 41_000)) == places[(places >= 30_000) & (places < 41_000)].tolist()
    assert w.document(99_999) == (None, 99_999) and w.document(100_000) == (3, 0)
    with pytest.raises(IndexError):
        w.access(150_000)
    with pytest.raises(ValueError):
        wavelet.Wavelet(b"x" * 64)


def _documents(data):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, at = [], 0
    for i, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("sizes", [{}, {"shard_tokens": 500}])
def test_shards_give_back_what_was_written(spark, odd, docs, sizes):
    for df in (odd, docs):
        got = wavelet.documents(wavelet.shards(spark, wavelet.write(df, **sizes)))
        assert rows(got) == sorted(_documents(pairs(df)))


def test_shards_of_repeated_and_null_ids(spark, odd, twice, none):
    got = wavelet.documents(wavelet.shards(spark, wavelet.write(twice, shard_tokens=300))).collect()
    want = _documents(pairs(twice))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((i, n, c) for i, _, n, c in want)
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert [e for _, e in ends[:-1]] == [s for s, _ in ends[1:]] and ends[0][0] == 0
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [i for i, *_ in want]
    data = [(None, "one two"), (None, None), (5, "three"), (-3, "four")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(wavelet.documents(wavelet.shards(spark, wavelet.write(df))).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, -3, 5]
    assert wavelet.documents(wavelet.shards(spark, wavelet.write(none))).count() == 0


def test_files_answer_without_the_documents(spark, docs):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    files = wavelet.shards(spark, wavelet.write(docs, shard_tokens=40_000)).cache()
    assert files.count() > 3
    stream, where = [], []
    for i, t in sorted(pairs(docs)):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        where += [(i, k) for k in range(len(ids))]
        stream += ids
    wanted = [2, Counter(stream).most_common(5)[-1][0], 50_255]
    counts = {r["token"]: r["n"] for r in wavelet.count_tokens(files, wanted).collect()}
    assert counts == {t: stream.count(t) for t in wanted}
    assert rows(wavelet.find_token(files, 2)) == sorted((*where[p], p) for p, x in enumerate(stream) if x == 2)
    middle = len(stream) // 2
    assert rows(wavelet.read_tokens(files, middle - 40, middle + 40)) == [
        (p, stream[p]) for p in range(middle - 40, middle + 40)]


# --- operator 12 --------------------------------------------------------------------
@settings(max_examples=20, deadline=None)
@given(st.integers(1, 70), st.integers(0, 70), st.integers(1, 70), st.integers(0, 1 << 30))
def test_strassen_is_exact(m, k, p, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-1 << 40, 1 << 40, (m, k)), rng.integers(-1 << 18, 1 << 18, (k, p))
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a]).reshape(m, p)
    assert np.array_equal(negatives.strassen(a, b, 4), want)


def mined(data, every=50, n_pos=5, n_neg=3, low=50, high=95):
    kept = [(n, i, [math.floor(256 * float(x)) for x in v], str(lab)) for n, (i, v, lab) in enumerate(data)
            if i is not None and lab is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q, lab in kept:
        if i % every:
            continue
        s = [(-sum(a * b for a, b in zip(q, v)), j, other == lab) for o, j, v, other in kept if o != n and len(v) == len(q)]
        for ps, pos, _ in sorted(x for x in s if x[2])[:n_pos]:
            inside = sorted((ns, j) for ns, j, same in s if not same and low * -ps <= 100 * -ns <= high * -ps)[:n_neg]
            out += [(i, pos, r + 1, j, -ps, -ns) for r, (ns, j) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"block": 60, "anchor_block": 4}])
def test_hard_negatives_equal_brute_force(spark, sizes):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert rows(negatives.mine(table, **sizes)) == mined(data)


def test_hard_negatives_of_odd_rows(spark):
    rng = random.Random(8)
    data = [(i, [float(rng.randint(-1, 2)), float(i % 2), 1.0, 0.5], rng.choice([0, 0, 1, 2])) for i in range(300)]
    data += [(None, [1.0] * 4, 0), (301, None, 1), (350, [float("nan")] * 4, 1), (400, [1.0, float("inf"), 0.0, 0.0], 1),
             (450, [1.0, 1.0, 1.0, 1.0], None), (500, [0.0] * 4, 1), (550, [1.0, None, 1.0, 1.0], 0), (600, [2.0, 1.0], 0),
             (601, [1.0, 1.0], 0), (602, [1.0, 1.0], 1), (650, [], 0), (651, [], 0), (652, [], 1)]
    data += [(100, [2.0, 0.0, 1.0, 1.5], 1), (7, [2.0, 1.0, 1.0, 1.5], 2), (7, [2.0, 1.0, 1.0, 1.5], 2)]     # repeated ids
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    clash = df.selectExpr("*", "label AS row", "label AS x", "vec_id AS d", "label AS rb", "label AS anchor", "1 AS score")
    assert rows(negatives.mine(clash, every=10, block=50, anchor_block=9)) == mined(data, every=10)
    assert negatives.mine(df.limit(0)).count() == 0
    alone = df.where("vec_id = 50")
    assert negatives.mine(alone).count() == 0


# --- operator 13 --------------------------------------------------------------------
def _terms(text):
    found = re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]


def searched(docs, items, k=10):
    held = [(i, Counter(_terms(t))) for i, t in docs if _terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in _terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return out


def _key(row):
    return tuple((x is not None, x or 0) for x in row)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([bytes([c]) for c in range(97, 109)]), min_size=1, max_size=14), min_size=1,
                max_size=9), st.integers(1, 12))
def test_sharing_keeps_every_sum(queries, widest):
    dag = lexical.sharing_dag(queries, widest)
    impacts = np.random.default_rng(1).integers(0, 1 << 40, (len(dag.vocabulary), 4))
    want = [sum(impacts[dag.vocabulary[t]] for t in q) for q in queries]
    assert np.array_equal(dag.evaluate(impacts), np.array(want))


def test_common_parts_are_added_once():
    shared = [b"a", b"b", b"c", b"d"]
    dag = lexical.sharing_dag([[*shared, b"x"], [*shared, b"y"], [b"a", b"b", b"z", b"x"], [b"a", b"b", b"z", b"y"]])
    sums = len(dag.set_terms) - len(dag.set_nodes) + sum(len(n) for n, *_ in dag.levels) + len(dag.item_nodes) - 4
    assert len(dag.set_nodes) == 2 and sums < 4 + 4 + 3 + 3     # ab and cd, less than adding each query anew


def test_lexical_search_equals_brute_force(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    data = [(r["item_id"], r["text"]) for r in items.collect()]
    want = sorted(searched(pairs(docs), data))
    assert rows(lexical.search(docs, items)) == want
    assert rows(lexical.search(docs, items, block=7)) == want


def test_lexical_search_of_odd_rows(spark, odd, twice, none):
    data = [("a", "Ab c"), ("b", None), ("c", ""), ("d", "... !"), ("e", "7 7 7 x"), (None, "é x ab"), ("f", "zzz nowhere"),
            ("g", " ".join(r["text"] or "" for r in odd.where("doc_id in (8, 9, 11)").collect())), ("a", "Ab c")]
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in data], "item_id string, text string, rank int, score int")
    for df in (odd, twice):
        want = searched(pairs(df), data)
        assert sorted(rows_of(lexical.search(df, items)), key=_key) == sorted(want, key=_key)
    nulls = spark.createDataFrame([(None, "x y"), (3, "x y"), (None, "x y"), (1, "x")], "doc_id long, text string")
    assert sorted(rows_of(lexical.search(nulls, items)), key=_key) == sorted(searched(pairs(nulls), data), key=_key)
    assert lexical.search(none, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0


def rows_of(df):
    return [tuple(r) for r in df.collect()]
