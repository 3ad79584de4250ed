"""The pipeline's line dedup stage on passages of 1 to 6 lines in unlike documents."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_line_passages import SCHEMA, check_planted, planted


def test_pipeline_stage(spark):
    rows, passages = planted(random.Random(2))
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1)})
    got = dict(corpus_pipeline.line_dedup(spark, docs, "").select("doc_id", "text").collect())
    check_planted(rows, passages, got)
