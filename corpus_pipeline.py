"""The corpus pipeline: language ID, near-dedup, PII, source mix and encoding over ``documents``.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's docs. All stages but the last return the columns of
``documents``. No stage has a rule that SQL could state in full, so ORACLE_SQL is None
and the tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratum.llm import language, mixing, neardup, pieces, pii
from stratum.llm.common import Scratch, importable, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told (operator 7)."""
    importable(spark)
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (operator 9)."""
    importable(spark)
    return neardup.deduplicate(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind (operator 10); n_chars follows."""
    importable(spark)
    return pii.redact(docs, pii.fit(docs), length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents from the sources by their targets, some of them twice (operator 3)."""
    importable(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts that remain (operator 8): one row per document taken."""
    importable(spark)
    return pieces.digest_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
