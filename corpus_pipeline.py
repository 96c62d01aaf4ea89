"""Corpus pipeline: the stages in ``STAGES`` applied one after another to ``documents``.

Every stage works on all documents that the one before it kept. All but the
last return the columns of ``documents``; ``n_chars`` follows the text.

Defined results for awkward rows are those of the operators: null and blank
texts fail the quality rules; of repeated rows one stays, rows without an id
included; an empty table gives no sequences; further columns pass
through all stages but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.llm.catalog import WORD_MODEL, tokenizer_path
from sigflow.llm.common import load
from sigflow.llm.jaccard import one_of_each
from sigflow.llm.mixture import pack_mixture
from sigflow.llm.quality import keep_good
from sigflow.llm.substring import drop_repeats
from sigflow.session import checkpoint_root


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near copies: five-word shingles, similarity 0.8."""
    return one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 20 words or more that start earlier in
    the corpus; a document made of such passages alone goes."""
    out = drop_repeats(docs).filter(F.col("text") != "")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, sources mixed in proportion: sequence_id,
    length, doc_ids, pieces and ids (little-endian unsigned 32-bit)."""
    packed = pack_mixture(docs, tokenizer_path(WORD_MODEL))
    return packed.select("sequence_id", "length", F.col("pieces.doc_id").alias("doc_ids"), "pieces", "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("packing", packing_stage),
]

# The near-duplicate and packing stages hash, cluster and pack; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet
    below the shared checkpoint folder and read again as the next one's input."""
    base = f"{checkpoint_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{k}")
            docs = spark.read.parquet(f"{base}/{k}")
    return docs
