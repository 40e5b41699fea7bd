import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 3 = 0").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, copies, repeated rows, clashing column names."""
    rng = random.Random(5)
    passage = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(60))
               for _ in range(6)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "Ab C"), (6, "a" * 3000), (7, "7 " * 4000),
            (8, passage[0]), (9, passage[0]), (10, passage[0] + "!"), (11, " ".join(passage) * 40),
            (12, "mail a@b.co%x@y.org, +1 (988) 555-2485 and 1.2.3.4.5.6.7.8; 4111 1111 1111 1111, 999.1.1.1"),
            (13, "ssn 123-45-6789, IBAN DE89 3704 0044 0532 0130 00."), (14, "<|endoftext|> 🎉 é\x00\x7f"), (15, "...!!!")]
    rows += [(i, " ".join(rng.choice(passage)[rng.randint(0, 9):] for _ in range(rng.randint(1, 4))))
             for i in range(16, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("lang", "source", "fp", "th", "start", "spans", "n_words", "bucket", "score", "kept", "_stay", "at")
    return df.select("*", *[F.lit(None).cast("string").alias(n) for n in names]).repartition(5).cache()


@pytest.fixture(scope="session")
def twice(odd):
    """The same rows, some repeated in other partitions."""
    return odd.union(odd.where("doc_id % 4 = 0")).union(odd.where("doc_id % 4 = 0").repartition(3)).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted(tuple(r) for r in df.collect())
