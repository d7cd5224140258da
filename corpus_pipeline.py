"""The corpus pipeline: documents in, tokens out.

STAGES lists (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronofold.llm import bpe, decontamination, jaccard, pii, quality
from chronofold.llm.labelled import crc_mod
from chronofold.llm.registry import VOCABULARY, pii_key
from chronofold.llm.session import dropped, shared_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go; it learns from the labelled two thirds of the rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels.where(crc_mod("doc_id", 3) != 1)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly such passages goes."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private data get keyed pseudonyms of their own format."""
    return pii.pseudonymise(docs, pii_key(spark), count_col=None, size_col="n_chars")


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of them and of what they decode to."""
    return bpe.encode_documents(docs, VOCABULARY)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("PII", pseudonymised),
    ("BPE encoding and decoding", tokenised),
]
#: SQL cannot express the classifier's fit; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of sf_dir; a stage's table goes once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for at, (_, stage) in enumerate(STAGES):
        path = shared_dir(spark, f"stage{at}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            dropped(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
