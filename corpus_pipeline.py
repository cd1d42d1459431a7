"""The corpus pipeline: five stages, each written and read again as the documents of the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpath.llm import decontaminate, minhash, packing, pii, quality
from barpath.llm.common import table
from barpath.session import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good stay."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles of a Jaccard similarity of at least 0.8.
    SimHash fingerprints of these shingles and MinHash bands propose; the shingles decide."""
    return minhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with the benchmark go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes the name of its kind; ``n_chars`` follows the text."""
    out = pii.find_pii(docs, redact=True).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", redact_pii),
    ("best_fit_packing", best_fit_packing),
]

#: Token ids, fingerprints and a trained model are not for SQL; tests compare the pipeline with a plain version of itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
