"""The corpus pipeline: documents whose language can't be told go, then exact
copies, then near copies; the rest is mixed to target weights and encoded.

Each stage takes ``(spark, docs, sf_dir)``, works on everything that the stage
before it kept, and returns rows with the columns of ``documents``; the last one
returns token ids and digests instead.  Defined cases are those of the operators
that the stages call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import bpe, exact_dedup, langid, mixing, simhash
from webloom.llm.common import saved
from webloom.session import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier doesn't reject (nulls, texts
    without a letter, ties).  Dictionaries are learned from labelled rows."""
    return langid.keep_identified(docs, docs.where(~langid.held_out()))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, that with the smallest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group, the document with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it."""
    return mixing.mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mixed documents' ids and decoded bytes,
    and the packed ids themselves."""
    return bpe.token_digests(docs, keep_tokens=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

#: Compression, fingerprint graphs, subset sums and BPE are beyond SQL; the
#: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
