"""The queries of this subpackage with the SQL they are checked against, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickerlake.llm import (
    bpe_duckdb, chat_format, html_extract, k2_treap, lemp_negatives, minmax_hash, ngram_join, quality_cascade, quality_nbsvm, secret_scan, substring_dedup,
    template_decontam, toxicity_fm,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": html_extract.op1,
    "op2_substring_dedup": substring_dedup.op2,
    "op3_toxicity": toxicity_fm.op3,
    "op4_benchmark_decontamination": template_decontam.op4,
    "op5_byte_bpe": bpe_duckdb.op5,
    "op6_chat_formatting": chat_format.op6,
    "op7_secret_scan": secret_scan.op7,
    "op8_ngram_jaccard_join": ngram_join.op8,
    "op9_quality_rules": quality_cascade.op9,
    "op10_quality_classifier": quality_nbsvm.op10,
    "op11_lexical_search": k2_treap.op11,
    "op12_hard_negatives": lemp_negatives.op12,
    "op13_minhash_near_dedup": minmax_hash.op13,
}
ORACLE: dict[str, str] = {
    "op2_substring_dedup": substring_dedup.OP2_SQL,
    "op4_benchmark_decontamination": template_decontam.OP4_SQL,
    "op6_chat_formatting": chat_format.OP6_SQL,
    "op8_ngram_jaccard_join": minmax_hash.components_sql(3, 90, 100),
    "op9_quality_rules": quality_cascade.OP9_SQL,
    "op11_lexical_search": k2_treap.OP11_SQL,
    "op12_hard_negatives": lemp_negatives.OP12_SQL,
    "op13_minhash_near_dedup": minmax_hash.OP13_SQL,
}
