"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes
each result as Parquet in the shared folder and hands it, read back, to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, langid, packing, pii, simhash
from strata.llm.common import staged, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language the network tells (operator 8)."""
    return langid.keep_known(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group (operator 4)."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark windows (operator 7)."""
    return decontaminate.drop_contaminated(docs, decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind (operator 2)."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into sequences (operator 10)."""
    return packing.pack(docs)


STAGES = [("language ID", language), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("PII", personal_data), ("packing", pack)]

#: Fingerprints, trained weights and token ids have no SQL twin; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
