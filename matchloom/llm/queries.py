"""The corpus operators' queries; their SQL for DuckDB, where SQL can say the same, is in the module sql."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, content_archive, embedding_dedup, filter_audit, harmonic_packing, importance_resampling, jaccard_join, line_chunks, line_passages, media_columns, personal_data, preference_format, string_tiling, subword_toxicity
from .common import Scratch, load


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against its own turns with another conversation's last answer."""
    turns = load(spark, sf_dir, "conversations")
    return preference_format.preference_rows(turns, preference_format.with_other_answers(turns))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all documents, by their likeness to those labelled as good. Labels are merged in at any size: they grow with the documents."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    good = docs.select("doc_id", "text").join(labels.where("quality = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    return importance_resampling.drawn(docs, good)


def op3_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a stored FLAC stream, written to a table, which is then read back as PCM blocks in order."""
    media = media_columns.encoded(load(spark, sf_dir, "documents"))
    return media_columns.digests(media_columns.stored(media, Scratch(spark, "media")))


def op4_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return personal_data.personal_data(docs, personal_data.train(docs))


def op5_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic_packing.packed(load(spark, sf_dir, "documents"))


def op7_set_relation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(load(spark, sf_dir, "documents"), n=4, percent=85)


def op8_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, then every record rebuilt by the join of headers and payloads, and measured and hashed as rebuilt."""
    scratch = Scratch(spark, "warc")
    content_archive.write_archive(load(spark, sf_dir, "pages"), scratch.root)
    rows = content_archive.rebuilt_facts(spark, scratch.root)
    return rows.select(F.col("record").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return subword_toxicity.scored(docs, subword_toxicity.train(docs, load(spark, sf_dir, "labels")))


def op10_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of over 50 words that stands at an earlier place leaves the texts."""
    return line_passages.without_repeated_passages(load(spark, sf_dir, "documents").select("doc_id", "text"), report=True)


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))


def op13_quantised_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(load(spark, sf_dir, "embeddings"))


def content_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks between content-defined boundaries alone, as SQL can express them."""
    return line_chunks.without_repeated_chunks(load(spark, sf_dir, "documents").select("doc_id", "text"), report=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_preference_format,
        op2_importance_resampling,
        op3_flac_media,
        op4_bilstm_crf_pii,
        op5_greedy_string_tiling,
        op6_harmonic_packing,
        op7_set_relation_join,
        op8_content_archive,
        op9_subword_toxicity,
        op10_line_chunk_dedup,
        op11_filter_interactions,
        op12_phrase_collocations,
        op13_quantised_near_dedup,
        content_chunk_dedup,
    )
}
