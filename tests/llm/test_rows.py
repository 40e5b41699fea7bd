import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import decontaminate, packing, pii, topk

from . import brute
from .conftest import SF, pairs, rows


def test_personal_data_equals_brute_force(docs, odd, none):
    for df in (docs, odd):
        got = rows(pii.digest(pii.spans(df)).drop("spans"))
        assert got == sorted(brute.personal(pairs(df)))
    assert pii.spans(none).count() == 0


def test_personal_data_adds_confirmed_kinds(odd):
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.spans(odd)).collect()}
    assert got[13] == "ssn:4:15,iban:22:49" and got[1] == got[2] == ""


def test_ibans_of_every_country(spark):
    def made(country, n):
        body = ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2)[:n - 4]
        number = int("".join(str(int(c, 36)) for c in f"{body}{country}00"))
        return f"{country}{98 - number % 97:02d}{body}"

    data = [(i, f"pay {made(c, n)}.") for i, (c, n) in enumerate(sorted(pii.IBAN_LENGTH.items()))]
    data += [(900, "pay GR1601101250000000012300695, or GR16 0110 1250 0000 0001 2300 696.")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.spans(spark.createDataFrame(
        data, "doc_id long, text string"))).collect()}
    for i, text in data[:-1]:
        assert f"iban:4:{len(text) - 1}" in got[i], text
    assert got[900] == "iban:4:31"


def test_names_that_the_operators_use_themselves(spark):
    df = spark.createDataFrame([(1, "mail a@b.co", "x", 2, "k"), (2, None, None, None, "k")],
                               "doc_id long, text string, _pii_text string, _found int, pii string")
    found = pii.spans(df, out="told")
    assert found.columns == [*df.columns, "told"] and {r["_pii_text"] for r in found.collect()} == {"x", None}
    got = pii.redact(df)
    assert got.columns == df.columns and rows(got)[0] == (1, "mail [EMAIL]", "x", 2, "k")
    clash = df.selectExpr("doc_id", "text", "doc_id AS _id", "doc_id AS _th", "doc_id AS _bad_id", "'z' AS th")
    items = spark.createDataFrame([("i", "mail a b co")], "item_id string, text string")
    marked = decontaminate.decontaminate(clash, items)
    kept = decontaminate.drop_contaminated(clash, marked)
    assert kept.columns == clash.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_personal_data_many_and_long(spark):
    data = [(1, "a@b.cc 1.2.3.4 " * 3000), (2, "9" * 50_000 + "a" * 100_000 + "@" * 3), (3, "+1 " * 20_000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(pii.digest(pii.spans(df)).drop("spans")) == brute.personal(data)


def test_redaction(odd, twice):
    got = pii.redact(odd)
    assert got.columns == odd.columns
    text = dict(pairs(got))
    assert text[12] == "mail [EMAIL][EMAIL], [PHONE] and [IP].[IP]; [CARD], 999.1.1.1"
    assert text[13] == "ssn [SSN], IBAN [IBAN]." and text[1] is None and text[11] == dict(pairs(odd))[11]
    assert pii.redact(twice).count() == twice.count()


@pytest.mark.parametrize("sizes", [{}, {"block": 60, "query_block": 3}])
def test_top_k_equals_brute_force(spark, sizes):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert rows(topk.top_k(table, **sizes)) == brute.top(data)


def test_top_k_ties_and_bad_vectors(spark):
    data = [(i, [float(i * 7 % 3 - 1), 0.0, float(i % 2), 1.0]) for i in range(400)]
    data += [(401, None), (450, [float("nan")] * 4), (550, [1.0, float("inf"), 0.0, 0.0]), (500, [0.0] * 4),
             (402, [1.0, None, 1.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert rows(topk.top_k(df, block=100)) == brute.top(data)
    assert rows(topk.top_k(df.union(df), block=100)) == brute.top(data + data)
    again = [(50, [1.0, 0.0, 0.0, 0.0]), (1, [9.0, 0.0, 0.0, 0.0]), (1, [-5.0, 0.0, 0.0, 0.0]), (None, [9.0, 9.0, 9.0, 9.0])]
    df2 = spark.createDataFrame(again, "vec_id long, embedding array<float>")
    assert rows(topk.top_k(df2)) == brute.top(again)
    assert rows(topk.top_k(df.union(df2), block=90)) == brute.top(data + again)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 50")).count() == 0


def _ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def _check_packing(df, got):
    want = sorted((i, len(x), x) for (i, _), x in zip(pairs(df), _ids([t for _, t in pairs(df)])))
    pieces = sorted(tuple(r) for r in got.collect())
    assert sum(p[2] for p in pieces) == sum(n for _, n, _ in want)
    by_id = {}
    for i, n, x in want:
        by_id.setdefault(i, []).append(x)
    for doc, start, length, crc, n, _, _ in pieces:
        x = by_id[doc][0]
        assert len(x) == n and zlib.crc32(np.array(x[start:start + length], "<u4").tobytes()) == crc
    places = sorted((s, o, n) for _, _, n, _, _, s, o in pieces)
    at = 0
    for s, o, n in places:
        assert n > 0 and s * packing.LENGTH + o == at and o + n <= packing.LENGTH
        at += n


def test_packing_round_trip(docs, odd, twice, none):
    for df in (docs, odd, twice):
        _check_packing(df, packing.pack(df))
    assert packing.pack(none).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    start = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs, seen = start, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        seen.append(name)
        if name == "language ID":
            assert docs.count() >= 0.9 * before.count()
        elif name == "SimHash near-dedup":
            assert {i for i, _ in pairs(docs)} == {c for _, _, c in brute.near(pairs(before))}
        elif name == "benchmark decontamination":
            bad = {r[0] for r in brute.contamination(pairs(before), items) if r[-1]}
            assert {i for i, _ in pairs(docs)} == {i for i, _ in pairs(before)} - bad
        elif name == "PII":
            assert sum(sum(r[1:5]) for r in brute.personal(pairs(docs))) == 0 and docs.count() == before.count()
        else:
            _check_packing(before, docs)
            break
        assert docs.columns == start.columns
    assert len(seen) == 5
    whole = corpus_pipeline.run(spark, sf)      # the order of the stream follows the partitions
    assert rows(whole.select("doc_id", "doc_tokens").distinct()) == rows(docs.select("doc_id", "doc_tokens").distinct())
    _check_packing(before, whole)
