"""Stages of a corpus pipeline: (spark, docs, sf_dir) -> DataFrame, each one operator.

docs has the columns of documents, and may have more; every stage but the last returns the
columns it got. Nulls in any column, repeated rows and very long texts pass through every
stage; an empty table stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegraph.llm import bpe, langid, mixing, pii, simhash


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """lang becomes the predicted language; documents without any (null or blank text, no letter) go.

    Learned from the labelled rows of docs; if no row has a label, every text is `und` and goes.
    Rows without an id are kept, and repeated rows stay repeated.
    """
    return langid.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Repeated rows and blank texts are near duplicates of each other; rows without an id all stay.
    """
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind, and n_chars is counted anew; no row goes. Null texts stay null."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as their source's weight and a hash of their id ask, in a global shuffle. A null source is one of its own."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: how many tokens, and digests of ids and decoded text. A null text has no tokens."""
    return bpe.encode_digests(docs)
