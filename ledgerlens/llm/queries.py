"""The ``opN_<name>`` queries over the corpus tables and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import centroids, decontam, filter_audit, lm, quality_rules, sharding
from ledgerlens.llm.bpe import byte_bpe
from ledgerlens.llm.corpus import shipped
from ledgerlens.llm.langid import language_id
from ledgerlens.llm.minhash import near_dedup
from ledgerlens.llm.packing import best_fit_packing
from ledgerlens.llm.quality_model import quality_model
from ledgerlens.llm.toxicity import toxicity
from ledgerlens.llm.wordpiece import token_counts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_near_dedup": near_dedup,
        "op2_byte_bpe": byte_bpe,
        "op3_lm_scores": lm.lm_scores,
        "op4_decontamination": decontam.decontamination,
        "op5_language_id": language_id,
        "op6_quality_model": quality_model,
        "op7_token_counts": token_counts,
        "op8_sharding": sharding.sharding,
        "op9_toxicity": toxicity,
        "op10_quality_rules": quality_rules.quality_rules,
        "op11_filter_audit": filter_audit.filter_audit,
        "op12_best_fit_packing": best_fit_packing,
        "op13_centroid_clusters": centroids.centroid_clusters,
    }
    return {name: shipped(run) for name, run in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op3_lm_scores": lm.SQL, "op4_decontamination": decontam.SQL, "op8_sharding": sharding.SQL, "op10_quality_rules": quality_rules.SQL,
            "op11_filter_audit": filter_audit.SQL, "op13_centroid_clusters": centroids.SQL}
