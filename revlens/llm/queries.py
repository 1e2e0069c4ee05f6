"""The contract queries of the operators, and their DuckDB SQL where there is some."""

from __future__ import annotations

from revlens.llm import alignment, chat, decontam, license_scan, neardup, packing, quality, resampling, secrets, sharding, simhash, substring, token_files
from revlens.llm.common import read

QUERIES = {
    "op1_best_fit_packing": lambda spark, d: packing.op1_best_fit_packing(spark, read(spark, d, "documents")),
    "op2_secret_scans": lambda spark, d: secrets.op2_secret_scans(read(spark, d, "documents")),
    "op3_sharding": lambda spark, d: sharding.op3_sharding(read(spark, d, "documents")),
    "op4_document_fingerprints": lambda spark, d: simhash.op4_document_fingerprints(read(spark, d, "documents")),
    "op5_chat_formatting": lambda spark, d: chat.op5_chat_formatting(spark, read(spark, d, "conversations")),
    "op6_license_scans": lambda spark, d: license_scan.op6_license_scans(read(spark, d, "documents")),
    "op7_minhash_near_dedup": lambda spark, d: neardup.op7_minhash_near_dedup(read(spark, d, "documents")),
    "op8_benchmark_decontamination": lambda spark, d: decontam.op8_benchmark_decontamination(read(spark, d, "documents"), read(spark, d, "benchmark")),
    "op9_substring_dedup": lambda spark, d: substring.op9_substring_dedup(read(spark, d, "documents")),
    "op10_quality_classifier": lambda spark, d: quality.op10_quality_classifier(read(spark, d, "documents"), read(spark, d, "labels")),
    "op11_importance_resampling": lambda spark, d: resampling.op11_importance_resampling(read(spark, d, "documents"), read(spark, d, "benchmark")),
    "op12_token_files": lambda spark, d: token_files.op12_token_files(spark, read(spark, d, "documents")),
    "op13_cross_tokenizer_alignment": lambda spark, d: alignment.op13_cross_tokenizer_alignment(spark, read(spark, d, "documents")),
}

ORACLE = {
    "op5_chat_formatting": chat.ORACLE,
    "op6_license_scans": license_scan.ORACLE,
    "op8_benchmark_decontamination": decontam.ORACLE,
    "op9_substring_dedup": substring.ORACLE,
    "op11_importance_resampling": resampling.ORACLE,
}
