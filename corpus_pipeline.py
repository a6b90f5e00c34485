"""A cleaning pipeline over `documents`: each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import bpe, decontamination, language, simhash, suffix_dedup
from clickweave.llm.common import table
from clickweave.llm.queries import tokenizer_path
from clickweave.session import work_folder


def with_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of which less than half is in one language, go."""
    return language.with_a_language(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints one row of the least doc_id stays.

    Linked by op9_simhash's rule (3-word shingles, 2 bits at most), not by a similarity of 0.8.
    """
    return simhash.without_near_copies(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes that start earlier elsewhere are taken out of the texts."""
    return suffix_dedup.without_repeats(docs).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark windows go."""
    return decontamination.without_contamination(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their tokens and the text these decode to, and digests of both."""
    encoded = bpe.encode_decode(docs, tokenizer_path())
    return encoded.withColumns(bpe.digests(encoded)).drop("decoded")


STAGES = [
    ("language ID", with_a_language),
    ("SimHash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmarks),
    ("BPE encoding and decoding", tokenized),
]

# Neither learned languages nor byte-pair merges have a SQL form: tests hold each stage, and the
# whole, against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` through all stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
