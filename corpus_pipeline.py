"""The corpus pipeline: documents to token ids in five stages, each through one operator of ``reviewloom.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All but
the last return the columns of ``documents``; :func:`run` writes each result to the shared folder and
reads it back, so lost executors never repeat an earlier stage. Empty tables, NULLs and clashing
columns are treated as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm.bpe import encode_documents
from reviewloom.llm.common import stored, table
from reviewloom.llm.decontaminate import clean_documents
from reviewloom.llm.exact_dedup import drop_copies
from reviewloom.llm.near_dedup import drop_near_copies
from reviewloom.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts: that with the largest id."""
    return drop_copies(docs, largest=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8: that with the smallest id."""
    return drop_near_copies(docs, width=5, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number of ids, digests of ids and decoded text, and the ids."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: SQL cannot express the classifier and the encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
