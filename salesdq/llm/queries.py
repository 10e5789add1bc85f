"""Queries of this subpackage as the driver registers them, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesdq.llm import (
    bestfit,
    centroids,
    contamination,
    filter_audit,
    html_text,
    identifiers,
    jaccard,
    packing,
    quality,
    repeats,
    sharding,
    shared,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
OPERATORS: dict[str, Query] = {
    "op1_sharding": sharding.op1_sharding,
    "op2_warc_chunks": warc.op2_warc_chunks,
    "op3_best_fit_packing": bestfit.op3_best_fit_packing,
    "op4_main_text": html_text.op4_main_text,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_repeated_passages": repeats.op6_repeated_passages,
    "op7_concatenate_and_cut": packing.op7_concatenate_and_cut,
    "op8_benchmark_containment": contamination.op8_benchmark_containment,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_personal_data": identifiers.op10_personal_data,
    "op11_centroid_clusters": centroids.op11_centroid_clusters,
    "op12_filter_orders": filter_audit.op12_filter_orders,
    "op13_toxicity": toxicity.op13_toxicity,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shared.ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": quality.SQL, "op11_centroid_clusters": centroids.SQL, "op12_filter_orders": filter_audit.SQL}
