"""From raw documents to token ids: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.storage import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule rejects."""
    from weftline.llm.quality_rules import kept_documents

    return kept_documents(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    from weftline.llm.ngram_join import representatives

    return representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind."""
    from weftline.llm.secrets import redact

    clean = redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document."""
    from weftline.llm.mixing import mixed_documents

    return mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    from weftline.llm.catalog import piece_model
    from weftline.llm.pieces import round_trip

    return round_trip(docs, piece_model())


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

#: The verdicts of the rules, the shard draws and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
