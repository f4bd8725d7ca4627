"""Registered corpus queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from stratum.llm import attribution, decontaminate, embeddings, language, licenses, mixing, neardup, negatives, pieces, pii, tokenfile, variants
from stratum.llm.fingerprints import op1_fingerprints

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_nn_descent": embeddings.op2_nn_descent,
    "op3_mixing": mixing.op3_mixing,
    "op4_token_files": tokenfile.op4_token_files,
    "op5_licenses": licenses.op5_licenses,
    "op6_token_counts": attribution.op6_token_counts,
    "op7_language_id": language.op7_language_id,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_minhash": neardup.op9_minhash,
    "op10_pii": pii.op10_pii,
    "op11_variants": variants.op11_variants,
    "op12_decontaminate": decontaminate.op12_decontaminate,
    "op13_hard_negatives": negatives.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op2_nn_descent": embeddings.oracle_sql(),
    "op3_mixing": mixing.oracle_sql(),
    "op5_licenses": licenses.oracle_sql(),
    "op9_minhash": neardup.oracle_sql(),
    "op11_variants": variants.oracle_sql(),
    "op12_decontaminate": decontaminate.oracle_sql(),
    "op13_hard_negatives": negatives.oracle_sql(),
}
