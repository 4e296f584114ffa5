"""The corpus pipeline: quality rules, near-duplicates, benchmark
decontamination, secrets, mixing. Every stage reads what the one before it
wrote and returns the columns of documents; the mix adds shard and epoch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frametide.llm import decontamination, mixing, parity_join, quality_rules, secrets
from frametide.llm.common import checkpoint_dir, start, table

#: Near-duplicates of the corpus: distinct shingles of so many words, Jaccard threshold in percent.
#: (op10's 4 words and 85 % are that query's own.)
SHINGLE = 5
PERCENT = 80


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list keeps."""
    start(spark)
    return quality_rules.filter_quality(docs, quality_rules.learn_rules(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each n-gram Jaccard class."""
    start(spark)
    return parity_join.keep_one(docs, SHINGLE, PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    start(spark)
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets redacted."""
    start(spark)
    found = secrets.scan(docs).checkpoint()
    return secrets.redact(docs, secrets.infer(found))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus, a row per draw, each shard in a partition."""
    start(spark)
    return mixing.mix(docs, mixing.plan_mix(docs))


STAGES = [
    ("quality_rules", rules),
    ("ngram_jaccard", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", remove_secrets),
    ("mixing", mix),
]

#: Learned rules, sketches and seeded draws have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet in the shared
    folder and reread as the next one's input."""
    import uuid

    base = f"{checkpoint_dir(start(spark)).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{base}/{i}_{name}")
            docs = spark.read.parquet(f"{base}/{i}_{name}")
    return docs
