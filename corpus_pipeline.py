"""Corpus cleaning as five stages over a table of documents.

Every stage takes (spark, docs, sf_dir); its result is written and read back as the
docs of the next.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palisade.llm import jaccard, packing, quality, secrets, toxicity
from palisade.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the table of rules."""
    return quality.keep(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on labelled ones, does not call toxic."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    return jaccard.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark."""
    return secrets.redact(docs, secrets.fit(secrets.labelled_tokens(docs, "doc_id", "text")))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows that mix sources evenly."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("secrets", redact_secrets),
    ("packing", pack_windows),
]

# The severity model and the Markov chains are fitted, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
