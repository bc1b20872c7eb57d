"""A pipeline that makes training data of the documents: five stages, each written and read again before the next.

Each stage takes (spark, docs, folder of the tables) and gives rows with the columns of docs, the last one digests.
Null, empty and blank texts are documents like any other: the classifier scores them, near-dedup takes them for copies
of one another, and the later stages leave them as they are. A long text is never shortened. Of rows that repeat (or
tie in all that a stage looks at) near-dedup keeps one; rows without doc_id pass it, all of them. Different texts under
one doc_id are different documents. Further columns of docs, whatever their names, stay with their rows up to the
last stage. An empty table gives empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidebar.llm import decontaminate, quality, secrets, simhash
from tidebar.llm.common import table
from tidebar.llm.queries import tokens
from tidebar.session import shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the least doc_id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage contaminates."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, as digests."""
    return tokens(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs.write.parquet(f"{folder}/{n}")
            docs = spark.read.parquet(f"{folder}/{n}")
    return docs


#: The stages are a trained classifier, a hash that DuckDB lacks, and a tokenizer: no SQL gives their rows.
ORACLE_SQL = None
