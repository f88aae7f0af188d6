"""The numbered queries of this package and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorjobs.llm import byte_bpe, decontaminate, html_extract, license_scan, line_dedup, quality_ledger, ranked_search, simhash_dedup, site_quality, source_mixing, spelling_variants, suffix_tree_lm, vector_sharding

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": html_extract.query,
    "op2_decontaminate": decontaminate.query,
    "op3_quality_ledger": quality_ledger.query,
    "op4_vector_sharding": vector_sharding.query,
    "op5_license_scan": license_scan.query,
    "op6_simhash_dedup": simhash_dedup.query,
    "op7_source_mixing": source_mixing.query,
    "op8_suffix_tree_lm": suffix_tree_lm.query,
    "op9_site_quality": site_quality.query,
    "op10_line_dedup": line_dedup.query,
    "op11_ranked_search": ranked_search.query,
    "op12_byte_bpe": byte_bpe.query,
    "op13_spelling_variants": spelling_variants.query,
    "quality_ablation": quality_ledger.ablation_query,
    "quality_policies": quality_ledger.policies_query,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op3_quality_ledger": quality_ledger.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "quality_ablation": quality_ledger.ABLATION_ORACLE,
    "quality_policies": quality_ledger.POLICIES_ORACLE,
}
