"""One query per operator, over its whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import credentials, decontaminate, language, licenses, middle, negatives
from loomset.llm import pieces, pii, quality, quality_rules, repeats, simhash, warc
from loomset.llm.folds import in_fold

Query = Callable[[SparkSession, str], DataFrame]

#: The folder of vocabulary files, and the model that is used of them.
TOKENIZERS = os.environ.get("LOOMSET_TOKENIZERS", "/opt/tokenizers")
MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items, window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", *labels, "score"
    )


def model_bytes(folder: str = TOKENIZERS, name: str = MODEL) -> bytes:
    """The content of a vocabulary file, which the driver reads and sends to executors."""
    return (Path(folder) / name).read_bytes()


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, model_bytes()).select("doc_id", "n_pieces", "ids", "round_trip")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = repeats.remove_repeats(docs, size=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.judge(docs).drop("n_lines")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), max_bits=2, size=3)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, terms = pii.written("base"), pii.written("terms", F.lit(pii.TERM))
    counts = [
        F.expr(f"size(filter(base, x -> x.kind = '{k}'))").cast("bigint").alias(f"n_{k}")
        for k in pii.KINDS
    ]
    both = F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(terms, F.lit("")))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), both.alias("spans"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(language.training_documents(docs, parts=4, held_out=2))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", in_fold(4, 2).alias("held_out"), "lang_pred", "score")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    read = warc.read_archives(archives, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = quality.training_labels(table(spark, sf_dir, "labels"), parts=5, held_out=0)
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select(
        "doc_id",
        in_fold(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector against all; some labels are moved on by one."""
    moved = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return negatives.hard_negatives(rows, F.expr("vec_id % 100 = 0"), moved)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = middle.fill_in_middle(docs, seed=7, percent=100, percent_spm=50)
    return done.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(), 256).alias("restored_sha256"),
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document counts as a repository, and its source as the owner."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("doc_id").alias("repository"), F.col("source").alias("owner")
    )
    found = credentials.scan(docs)
    counts = [
        F.expr(f"size(filter(base, x -> x.kind = '{k}'))").cast("bigint").alias(f"n_{k}")
        for k in credentials.BASE
    ]
    base, spans = credentials.written("base"), credentials.written(credentials.merged())
    return found.select(
        "doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"), "n_examples", "n_live"
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_simhash": op6_simhash,
    "op7_pii": op7_pii,
    "op8_language_id": op8_language_id,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_secret_scan": op13_secret_scan,
}
