"""The corpus pipeline: five of the training-data operators, one after the other.

Each stage takes what its predecessor kept, whole, and returns the columns of
documents; the last returns a row for each packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwell.llm.line_dedup import clean_lines
from driftwell.llm.mixing import mix_documents
from driftwell.llm.packing import pack_documents
from driftwell.llm.near_links import keep_one
from driftwell.llm.store import discard, materialise
from driftwell.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3."""
    return drop_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that over a tenth of their source's documents hold."""
    return clean_lines(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: a Jaccard similarity of 0.8 or more of five-word shingles."""
    return keep_one(spark, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, a row for each epoch."""
    return mix_documents(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("simhash near-dedup", near_dedup), ("mixing", mixing), ("best-fit packing", packing)]
#: SQL can't express the classifier, SimHash groups nor the packing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; what a stage has read is deleted then."""
    docs = source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not source:
            discard(before)
    return docs
