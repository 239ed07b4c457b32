"""The queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rasterloom.llm import ann, embedding_dedup, line_dedup, merkle, mixing, packing, quality, sentencepiece_codec, simhash, suffix_dedup, toxicity, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_dedup.op1_query,
    "op2_simhash_near_dedup": simhash.op2_query,
    "op3_embedding_near_dedup": embedding_dedup.op3_query,
    "op4_toxicity": toxicity.op4_query,
    "op5_suffix_array_dedup": suffix_dedup.op5_query,
    "op6_nearest_neighbours": ann.op6_query,
    "op7_warc": warc.op7_query,
    "op8_quality_classifier": quality.op8_query,
    "op9_mixing_sources": mixing.op9_query,
    "op10_sentencepiece": sentencepiece_codec.op10_query,
    "op11_packing": packing.op11_query,
    "op12_merkle_manifest": merkle.op12_query,
    "op13_embedding_whitening": whitening.op13_query,
}

ORACLE_SQL: dict[str, str] = {"op1_line_dedup": line_dedup.OP1_SQL, "op9_mixing_sources": mixing.op9_sql(), "op12_merkle_manifest": merkle.op12_sql()}
