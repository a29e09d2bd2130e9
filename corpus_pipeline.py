"""The corpus pipeline: documents go through the stages in order, each written as Parquet and read again.

All stages but the last return the columns of their documents, whatever they are called, and an empty table for an empty
one. Rows that a stage judges alike, such as repeated rows, go or stay together. Texts are read whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varloom.llm.byte_bpe import encode
from varloom.llm.common import durable, table
from varloom.llm.decontaminate import drop_contaminated
from varloom.llm.exact_dedup import drop_copies
from varloom.llm.jaccard_join import keep_one_of_each
from varloom.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above go. A null text counts as empty; it and a text too
    short for an n-gram stay, unless most of the sample is toxic. Without both labels no text reaches the threshold, unless
    most labels are toxic. A null id is judged by its text."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays. Null and empty texts are equal; a null id stays only where no other row has its
    text; rows that repeat the id and text that stay all stay."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the Jaccard join the smallest id stays: sets of five-word shingles, similarity 0.8 or more.
    Texts without words, null ones too, are alone in their component and stay, as do null ids; a text of fewer words is one
    shingle. An id on several rows is one document: it goes or stays whole."""
    return keep_one_of_each(docs, k=5, percent=80)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go. A null text has no words and stays; a null id is judged by its
    text; an empty benchmark drops nothing."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: token ids of each document that is left, with digests of them and of what they decode to. A null
    text has no ids; repeated rows and null ids each have their row."""
    return encode(docs)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("jaccard_join", near_stage), ("decontaminate", leak_stage), ("byte_bpe", encode_stage)]

#: SQL can't express the toxicity model; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
