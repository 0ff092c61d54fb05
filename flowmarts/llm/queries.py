"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowmarts.llm import (
    conversation_repair,
    exact_dedup,
    host_paths,
    licenses,
    line_quality,
    mixing,
    near_dup,
    packing,
    personal_data,
    repetitions,
    sentence_pieces,
    shards,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_paragraph_classifier": licenses.op1_paragraph_classifier,
    "op2_consensus_paths": host_paths.op2_consensus_paths,
    "op3_line_frequency": line_quality.op3_line_frequency,
    "op4_superminhash": near_dup.op4_superminhash,
    "op5_streaming_viterbi": sentence_pieces.op5_streaming_viterbi,
    "op6_boosted_candidates": personal_data.op6_boosted_candidates,
    "op7_poisson_mix": mixing.op7_poisson_mix,
    "op8_stratified_shards": shards.op8_stratified_shards,
    "op9_chunk_recipes": exact_dedup.op9_chunk_recipes,
    "op10_levenshtein_lexicon": toxicity.op10_levenshtein_lexicon,
    "op11_weighted_cyk": conversation_repair.op11_weighted_cyk,
    "op12_synchronising_runs": repetitions.op12_synchronising_runs,
    "op13_linear_grouping": packing.op13_linear_grouping,
}
