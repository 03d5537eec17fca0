"""A training-data pipeline over ``documents``: quality classifier, near-duplicate
removal, benchmark decontamination, personal data, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns the rows that go on, with
the columns of ``documents``; the last one adds the encoding.  ``run`` writes
each stage as parquet below the folder in ``spark.checkpoint.dir`` and reads it
again for the next one, so an executor that is lost costs one stage at most.

What the stages decide: the first drops documents scored below 0.3, the second
keeps one document of each group of near duplicates (the least id; five-word
shingles, similarity 0.8), the third drops documents that hold a benchmark item,
the fourth replaces personal data in the text and counts its characters again,
the fifth encodes the text and returns the text its ids decode to.

Rows with NULL ids pass through; of repeated rows of one id and text one stays.
"""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, minhash_dedup, pii, quality
from tessera.llm.common import cut, read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"), threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.deduplicated(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.sanitise(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c != "text"]
    coded = byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                   keep=others, with_decoded=True, remember=False)
    return coded.select(*[F.col("decoded").alias("text") if c == "text" else F.col(c) for c in docs.columns],
                        "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", remove_personal_data),
    ("byte-level BPE", encode),
]

#: no stage but the last could be stated in SQL (a fitted model, min-hashes, a latent space)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's result written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
