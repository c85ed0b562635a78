"""The corpus queries and, where SQL can express one, the SQL it is compared to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parceltrail.llm import bpe, class_lm, cube_mix, divergence, exact_dedup, fill_middle, hilbert_ann, language, license_scan, quality, simhash, suffix_dedup, token_blocks
from parceltrail.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_blocks": token_blocks.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_suffix_dedup": suffix_dedup.query,
    "op4_class_lm": class_lm.query,
    "op5_bpe_rounds": bpe.query,
    "op6_simhash_covering": simhash.query,
    "op7_hilbert_ann": hilbert_ann.query,
    "op8_cube_mix": cube_mix.query,
    "op9_quality": quality.query,
    "op10_license_scan": license_scan.query,
    "op11_source_divergence": divergence.query,
    "op12_fill_middle": fill_middle.query,
    "op13_language": language.query,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op11_source_divergence": divergence.SQL,
    "op12_fill_middle": fill_middle.SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {name: shipped(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
