"""The registered queries of the operators: whole tables, production
parameters.  ``QUERIES`` maps a name to its builder, ``ORACLES`` to DuckDB SQL
where SQL can express the operator."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, compact_windows, decontaminate, fingerprints, html_text, merkle, minhash_dedup, pii, ppm, quality, suffix_dedup, token_count, whitening
from .common import read_table

TOKEN_LIMIT = 2048

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by heap-and-linked-list merging; over_limit: more than 2048."""
    counted = token_count.count_tokens(read_table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to."""
    return byte_bpe.encode_decode(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every page by wrapper induction."""
    return html_text.main_text(read_table(spark, sf_dir, "pages"))


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    return pii.report(read_table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document: random Fourier features, ridge, isotonic calibration."""
    return quality.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.3)


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 4-word shingle similarity of 0.8 or more."""
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every document and of its edited text."""
    return fingerprints.report(read_table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 400-byte strings."""
    return suffix_dedup.report(read_table(spark, sf_dir, "documents"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, as copies or paraphrases."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate passages of 50 words or more, and whole copies."""
    return compact_windows.passages(read_table(spark, sf_dir, "documents"))


@query
def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under a byte-context model (and a word model) of the training rows."""
    return ppm.score(read_table(spark, sf_dir, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened coordinates of every embedding, distinct integer vectors fitted once."""
    return whitening.report(read_table(spark, sf_dir, "embeddings"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what tampered texts fold to."""
    return merkle.report(read_table(spark, sf_dir, "documents"))


ORACLES["op13_merkle_manifest"] = merkle.ORACLE
