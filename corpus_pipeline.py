"""A training corpus from raw documents, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  Its result is
written as Parquet to the shared folder and read again as the next stage's
documents, so a lost executor costs one stage's work at most.  All but the
last return the columns of ``documents``; the last one returns each
document's place and checksum in the token files.

Stages: drop documents that the quality classifier rejects; keep one document
of each group of near-duplicates; drop documents that contain benchmark
items; mix the sources to their target weights (a document is repeated as
often as the mix takes it); write token ids and read them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martspark.llm import decontaminate, jaccard_join, mixing, quality, token_files
from martspark.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_table(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: The classifier is trained and edit distances are computed: SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
