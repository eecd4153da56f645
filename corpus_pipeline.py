"""The training-data pipeline: five stages from raw documents to a weighted sample.

Each stage takes the documents that the one before kept and returns documents with the same
columns.  ``run`` applies them to the documents of a data folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidara.llm.common import stash
from evidara.llm.decontamination import drop_contaminated
from evidara.llm.minhash import keep_first
from evidara.llm.mixing import sample_mixture
from evidara.llm.substring import remove_repeats
from evidara.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text is not predicted toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return keep_first(docs, k=5, percent=80)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words or more that an earlier document holds."""
    return remove_repeats(docs, length=13)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, substitutions included."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample raked to the target shares of sources, languages and topics."""
    return sample_mixture(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("mixing", to_target_weights),
]

#: restoration, learned scores and raking are not SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stash(docs)
    return docs
