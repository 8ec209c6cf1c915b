"""A corpus from raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import alike, bpe, credentials, mixing, quality, simhash
from tripweave.llm.common import bounded_batches, shipped, table
from tripweave.llm.queries import tokenizer_json
from tripweave.session import scratch_path

#: Each document at most once, so no copy comes back after the near-duplicates have gone.
RECIPE = mixing.Recipe(share=80, epochs=1)


def _prepared(spark: SparkSession) -> None:
    """The stages share executors, whose memory grows from one to the next; small batches keep it bounded."""
    shipped(spark)
    bounded_batches(spark)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    _prepared(spark)
    return quality.kept(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles alike at 0.8 or more stays."""
    _prepared(spark)
    return simhash.one_of_each(docs, alike.grouped)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays."""
    _prepared(spark)
    return credentials.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each source what its budget allows."""
    return mixing.kept(docs, RECIPE)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, told by their number and digest and by the digest of what they decode to."""
    _prepared(spark)
    return bpe.round_trip(docs, tokenizer_json())


STAGES = [
    ("quality_rules", judge_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: Fingerprints and learnt scores have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
