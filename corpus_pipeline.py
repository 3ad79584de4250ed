"""Corpus cleaning: stages that each take all documents that the one before kept, written as Parquet between them."""

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm import harmonic_packing, jaccard_join, line_passages, string_tiling, subword_toxicity
from matchloom.llm.common import Scratch, load


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled ones among these documents."""
    return subword_toxicity.without_toxic(docs, subword_toxicity.train(docs, load(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that stand at an earlier place leave the texts."""
    return line_passages.without_repeated_passages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return jaccard_join.one_of_each_group(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item's words in tiles go."""
    return string_tiling.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return harmonic_packing.packed(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None  # a trained classifier and greedy tiling are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
