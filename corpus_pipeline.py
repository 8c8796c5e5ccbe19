"""A corpus pipeline: five operators, each over all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import decontaminate, pieces, pii, quality, simhash
from loomset.llm.queries import model_bytes, table
from loomset.llm.words import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier trained on the labels does not reject."""
    labels = quality.training_labels(table(spark, sf_dir, "labels"), parts=5, held_out=0)
    return quality.keep_good(docs, labels, least=0.3)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, of that the first
    text in the order of its hash; equal rows are one."""
    return simhash.deduplicate(docs, max_bits=2, size=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts generalised."""
    done = pii.sanitise(docs)
    return done.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids of pieces."""
    return pieces.encode(docs, model_bytes()).drop("text", "n_chars")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: A trained classifier, XXH64 fingerprints and a tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the others are written to the shared folder on the way."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
