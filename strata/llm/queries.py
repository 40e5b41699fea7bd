"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (cotrain, decontaminate, html_extract, langid, lexical, negatives, oracle, packing, pii, simhash,
                        suffix_dedup, topk, toxicity, wavelet)
from strata.llm.common import table


def op1_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotrain.score(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.spans(table(spark, sf_dir, "documents")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = wavelet.write(table(spark, sf_dir, "documents"))
    return wavelet.documents(wavelet.shards(spark, path))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", shifted))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_cotrain, op2_pii, op3_suffix_dedup, op4_simhash, op5_topk, op6_html_crf,
                                   op7_decontaminate, op8_langid, op9_toxicity, op10_packing, op11_wavelet, op12_hard_negatives,
                                   op13_lexical)}
#: The others hash, train or tokenize; tests compare them with brute force, round trips and held-out labels.
ORACLE = {"op2_pii": oracle.PERSONAL, "op5_topk": oracle.TOP_K, "op7_decontaminate": oracle.CONTAMINATION,
          "op12_hard_negatives": oracle.HARD_NEGATIVES, "op13_lexical": oracle.LEXICAL}
