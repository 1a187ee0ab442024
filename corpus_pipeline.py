"""From raw documents to packed sequences: quality, language, near-duplicates, packing.

Every stage reads what its predecessor kept from a written table; all but the last return the columns of
`documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import langid, packing, quality, simhash
from panelloom.llm.common import held_out, table
from panelloom.llm.queries import END_ID, MAX_BITS, PACKING_TOKENIZER, SEQUENCE, SHINGLE
from panelloom.sources.sinks import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.5 or more."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"), held_out(F.col("doc_id"), 3, 1))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of 0.5 or more."""
    return langid.identified(docs, held_out(F.col("doc_id"), 5, 0))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return simhash.one_of_each(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(PACKING_TOKENIZER), public_tokenizers.PATTERN, capacity=SEQUENCE, end_id=END_ID)


STAGES = [("quality", keep_quality), ("language", keep_identified), ("near_duplicates", keep_distinct), ("packing", pack)]

# Models and packing cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        out = step(spark, docs, sf_dir)
        docs = stage(out) if k + 1 < len(STAGES) else out
    return docs
