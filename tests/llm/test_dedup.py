import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, simhash, suffix_dedup

from . import brute
from .conftest import SF, pairs, rows


@pytest.mark.parametrize("chunk", [4096, 2])
def test_repeats_equal_brute_force(docs, odd, chunk):
    for df in (docs, odd):
        got = rows(suffix_dedup.remove_repeats(df, chunk=chunk).drop("kept"))
        assert got == brute.repeats(pairs(df))


def test_repeats_long_text_crosses_stretches(spark):
    rng = np.random.default_rng(1)
    big = "".join(rng.choice(list("abc d"), 600_000))
    data = [(1, big), (2, "q" + big[200_000:560_000] + "ü" + big[:99]), (3, "ab" * 700)]
    got = rows(suffix_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).drop("kept"))
    assert got == brute.repeats(data)


@pytest.mark.parametrize("tail", [100, 150, 201])
def test_repeats_short_last_stretch(spark, tail):
    rng = np.random.default_rng(tail)
    data = [(1, "".join(rng.choice(list("abcdefgh "), 2 * suffix_dedup.BLOCK + tail)))]
    got = rows(suffix_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).drop("kept"))
    assert got == brute.repeats(data) and got[0][2] == 0


def test_repeated_rows_are_one_document(odd, twice, none):
    want = rows(suffix_dedup.remove_repeats(odd).drop("kept"))
    got = suffix_dedup.remove_repeats(twice, chunk=3).drop("kept")
    assert got.count() == twice.count() and rows(got.distinct()) == want
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_repeats_null_id_comes_first(spark):
    text = "one two three " * 12
    df = spark.createDataFrame([(5, text), (None, text)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got[5] == len(text) and got[None] < len(text)


def test_simhash_equals_brute_force(docs, odd):
    for df in (docs, odd):
        got = rows(simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id"))
        assert got == brute.near(pairs(df))


def test_simhash_small_buckets_give_the_same(docs):
    small = rows(simhash.near_duplicates(docs, bucket=2, distance=6).select("doc_id", "component_id"))
    assert small == [(a, c) for a, _, c in brute.near(pairs(docs), 6)]


def test_forest_spans_a_chain():
    values = np.cumsum(np.r_[0, 2 ** np.arange(20)]).astype(np.uint64)      # neighbours differ in one bit
    left, right = simhash.forest(values, 1)
    assert sum(map(len, left)) == 20 and set(np.concatenate(right)) | {0} == set(values)


def test_keep_one(odd, twice, none):
    found = simhash.near_duplicates(twice)
    kept = simhash.keep_one(twice, found)
    want = {c for _, _, c in brute.near(pairs(odd))}
    assert kept.columns == twice.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    assert simhash.near_duplicates(none).count() == 0


def test_decontamination_equals_brute_force(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = rows(decontaminate.decontaminate(docs, items).drop("th"))
    assert got == brute.contamination(pairs(docs), [(r["item_id"], r["text"]) for r in items.collect()])
    assert any(r[-1] for r in got)


def test_decontamination_short_items_and_odd_texts(spark, odd, twice, none):
    long = " ".join(brute.words(dict(pairs(odd))[11])[40:75])
    items = [(1, "7"), (2, "Ab c"), (3, None), (4, "!!"), (5, long), (5, long), (11, long), (10, "ssn 123 45 6789"),
             (6, "7 7 7 7 7 7 7 7 7 7 7 7")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    got = decontaminate.decontaminate(twice, bench).drop("th")
    assert rows(got.distinct()) == brute.contamination(pairs(odd), items) and got.count() == twice.count()
    assert decontaminate.decontaminate(none, bench).count() == 0
    clean = decontaminate.decontaminate(odd, bench.limit(0))
    assert clean.where("contaminated").count() == 0 and clean.count() == odd.count()


def test_drop_contaminated_keeps_clean_rows(spark, odd):
    bench = spark.createDataFrame([(1, "ab c")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(odd, decontaminate.decontaminate(odd, bench))
    bad = {r[0] for r in brute.contamination(pairs(odd), [(1, "ab c")]) if r[-1]}
    assert bad and {r["doc_id"] for r in kept.collect()} == {i for i, _ in pairs(odd)} - bad


@pytest.mark.parametrize("alphabet,depth", [("ab", 100), ("a", 30), ("abcdefgh", 8), ("ab", 24)])
def test_refined_pointers_equal_prefixes(alphabet, depth):
    rng = np.random.default_rng(depth)
    part = rng.choice(np.frombuffer(alphabet.encode(), np.uint8), 400)
    data = np.r_[part, part[50:300], part]
    pointer = suffix_dedup.refine(data, depth)
    raw = data.tobytes()
    at = range(len(raw) - depth + 1)
    named = {pointer[i]: raw[i:i + depth] for i in at}
    assert all(named[pointer[i]] == raw[i:i + depth] for i in at)
    assert len(named) == len({raw[i:i + depth] for i in at})
    assert [named[p] for p in sorted(named)] == sorted(set(named.values()))


def test_parts_of_large_buckets():
    bucket = np.array([1, 1, 2, 2, 2, 3])
    part, ready, seen = suffix_dedup._parts(bucket, 0, 2)
    assert (part.tolist(), ready, seen) == ([-1, -1, 0, 0, 1, -1], 5, 1)
    assert suffix_dedup._parts(bucket[2:5], 3, 2)[0].tolist() == [1, 2, 2]


def test_rows_of_one_id_are_told_apart(spark):
    said = "".join(np.random.default_rng(5).choice(list("abcdefgh "), 150))
    df = spark.createDataFrame([(None, f"{i}-{said}") for i in range(300)], "doc_id long, text string")
    lost = sorted(r["n_removed"] for r in suffix_dedup.remove_repeats(df, chunk=5).collect())
    assert lost[0] == 0 and lost[1] > len(said) and len(lost) == 300


def test_parts_of_a_large_bucket_meet_by_stretches(spark):
    """A line of 60 documents in different contexts: what its parts send on are few rows, not a row a window."""
    import pyarrow as pa
    rng = np.random.default_rng(9)
    line = "".join(rng.choice(list("abcdefgh "), 95))
    texts = ["".join(rng.choice(list("abcdefgh "), 120)) + line + "".join(rng.choice(list("abcdefgh "), 120)) for _ in range(60)]
    raw = "".join(texts).encode()
    doc, bucket, _, at, n = (np.concatenate(c) for c in zip(*suffix_dedup.runs(
        np.frombuffer(raw, np.uint8), np.arange(0, len(raw) + 1, 335)), strict=True))
    names, count = np.unique(bucket, return_counts=True)
    hot = np.flatnonzero(bucket == names[count.argmax()])
    rows = pa.RecordBatch.from_arrays(
        [suffix_dedup._signed(bucket[hot]), pa.array((doc[hot] // 6).astype(np.int32)), pa.array(doc[hot]), pa.array(doc[hot]),
         pa.array(at[hot]), pa.array([raw[335 * d + a:335 * d + a + m + 99] for d, a, m in zip(doc[hot], at[hot], n[hot])], pa.binary())],
        ["bucket", "part", "doc_id", "th", "at", "body"])
    out = pa.Table.from_batches(list(suffix_dedup._window_scan(100)(iter([rows]))))
    windows = sum(map(len, out["held"].to_pylist()))
    assert len(hot) >= 20 and windows == n[hot].sum() and out.num_rows < windows / 5
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"), chunk=3).collect()}
    assert set(got.values()) == {0}
    sent = [r for r in out.to_pylist() if not r["salt"]]
    assert len(sent) < out.num_rows - 40 and any(r["stays"] for r in sent)


def test_names_that_several_rows_share():
    nth, several = suffix_dedup._nth(np.array([3, 1, 3, 3, 2]), np.array([7, 7, 7, 8, 7]))
    assert nth.tolist() == [0, 0, 1, 0, 0] and several.tolist() == [True, False, True, False, False]
    assert len(suffix_dedup._nth(np.empty(0, np.int64), np.empty(0, np.int64))[0]) == 0
