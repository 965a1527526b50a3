"""From raw documents to token digests of a clean, mixed corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. An empty table
passes through every stage; nulls, repeated rows and extra columns are handled as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, common, jaccard, mixing, pii, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the classifier, trained on the labelled ones among docs, scores 0.5 or more."""
    model = toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.kept(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return jaccard.representatives(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data removed from the texts; n_chars follows."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take; a document of several epochs is there as often."""
    return mixing.select(docs).select([F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's tokens."""
    return bpe.digests(docs).select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("pii", sanitise), ("mixing", mix), ("bpe", encode)]

#: The classifier can't be expressed in SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
