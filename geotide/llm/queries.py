"""The corpus operators as registered queries: name -> callable(spark, sf_dir), and the SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geotide.llm import bag_minhash, bpe, exact_topk, importance, line_dedup, merkle, mixing, oracles, pii, quality_rules, secret_scan, spelling, substring_dedup, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": mixing.op1,
        "op2_secret_scan": secret_scan.op2,
        "op3_line_dedup": line_dedup.op3,
        "op4_importance_resampling": importance.op4,
        "op5_exact_topk": exact_topk.op5,
        "op6_quality_rules": quality_rules.op6,
        "op7_toxicity": toxicity.op7,
        "op8_bag_minhash": bag_minhash.op8,
        "op9_bpe": bpe.op9,
        "op10_substring_dedup": substring_dedup.op10,
        "op11_pii": pii.op11,
        "op12_merkle_manifest": merkle.op12,
        "op13_spelling_variants": spelling.op13,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
