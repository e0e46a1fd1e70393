"""From raw documents to token ids.

Quality rules drop documents, line dedup drops repeated lines, SimHash near-dedup keeps
one document of each group, mixing takes documents by their source's target (a document
taken twice is two rows), and the last stage encodes what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catloss.llm import bpe_codec, line_dedup, mixing, quality_rules, simhash
from catloss.llm.common import materialize, table
from catloss.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality_rules.filter_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line equals or nearly equals."""
    return line_dedup.dedup_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest doc_id."""
    return simhash.keep_first(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text that they decode to."""
    return bpe_codec.encode_documents(docs, vocabulary("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("bpe_encoding", encoding_stage),
]
#: No stage can be put in SQL in full; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
