"""Documents to packed training sequences: reject bad and toxic ones, keep one of each group of near copies, redact, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm import packing, pii, quality, setjoin, toxicity
from pagetables.llm.common import free_name, text_or_empty
from pagetables.plans.workspace import new_folder, store


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    _, model = quality.score_documents(docs, _labels(spark, sf_dir), new_folder(spark, "quality"))
    score = free_name(docs, "score")
    return docs.withColumn(score, quality.score_column(docs, model)).filter(F.col(score) >= quality.KEPT_FROM).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples do not make them toxic."""
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    score = free_name(docs, "score")
    scored = docs.withColumn(score, toxicity.text_scorer(docs, model)(text_or_empty("text"))["score"])
    return scored.filter(F.col(score) < 0.5).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: five words a shingle, a likeness of 0.8 or more."""
    return setjoin.one_of_each(docs, new_folder(spark, "setjoin"), words_each=5, percent=80).select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; n_chars follows."""
    redacted = docs.withColumn("text", pii.redactor(docs, pii.fit(docs))("text"))
    return redacted.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of cost-balanced sequences, with their token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", redact),
    ("packing", pack),
]

# The stages hold fitted models and tokenizers, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), new_folder(spark, name.replace(" ", "-")))
    return docs
