"""The corpus pipeline: toxicity, exact dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last the columns of
``documents``, for the rows that stay; the last the packed pieces. ``run`` writes each
result as Parquet and rereads it for the next stage, so that a stage's work is done once and survives
lost executors.

In every stage rows count one by one: null ids and columns of any name are carried along, texts are read whole however
long, a null text counts as empty, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from inkwell.llm.common import read_table, store
from inkwell.llm.queries import TOKENIZER


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer rejects go; null and empty texts score as texts without any match, repeated rows
    share their fate."""
    model = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that of the smallest doc_id (null ids last, of ties one); all null and
    empty texts are one group."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the smallest doc_id (null ids last, of ties one); null, empty
    and blank texts share fingerprint zero."""
    return simhash.drop_near_copies(docs, shingle=3, max_bits=3)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go; null and empty texts stay, repeated rows share their fate."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens; a null or empty text is its closing id alone, and every
    repeated row is packed."""
    return packing.pack(docs, TOKENIZER, size=2048)


STAGES = [("toxicity", toxic), ("exact dedup", exact), ("near-dedup", near), ("decontamination", clean),
          ("packing", pack)]

#: SimHash components, tokenizer ids and the learned scorer have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
