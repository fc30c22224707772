"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat_format,
    exact_dedup,
    lexical_search,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    pii,
    quality_rules,
    quality_vectors,
    secrets,
    toxicity,
    training_order,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii_weak_supervision": pii.op1,
        "op2_toxicity_kneser_ney": toxicity.op2,
        "op3_pack_sequences": packing.op3,
        "op4_quality_rules": quality_rules.op4,
        "op5_quality_vectors": quality_vectors.op5,
        "op6_exact_dedup": exact_dedup.op6,
        "op7_secret_linking": secrets.op7,
        "op8_ngram_jaccard_join": ngram_join.op8,
        "op9_training_order": training_order.op9,
        "op10_mix_sources": mixing.op10,
        "op11_ranked_search": lexical_search.op11,
        "op12_chat_format": chat_format.op12,
        "op13_periodic_runs": periodic_runs.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_dedup": exact_dedup.SQL,
        "op11_ranked_search": lexical_search.SQL,
        "op12_chat_format": chat_format.SQL,
    }
