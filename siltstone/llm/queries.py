"""Queries of the operators in this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from siltstone.llm.audit import OP11_SQL, op11_filter_audit
from siltstone.llm.decontaminate import OP10_SQL, op10_benchmark_decontamination
from siltstone.llm.licenses import OP4_SQL, op4_license_scan
from siltstone.llm.neighbours import op2_nearest_neighbours
from siltstone.llm.packing import op1_best_fit_packing
from siltstone.llm.quality import op9_quality_classifier
from siltstone.llm.resampling import OP13_SQL, op13_importance_resampling
from siltstone.llm.secrets import OP5_SQL, op5_secret_scan
from siltstone.llm.simhash import op7_simhash_near_dedup
from siltstone.llm.substrings import OP3_SQL, op3_substring_dedup
from siltstone.llm.toxicity import op8_toxicity
from siltstone.llm.urls import OP12_SQL, op12_url_filters
from siltstone.llm.warc import OP6_SQL, op6_warc

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_secret_scan": op5_secret_scan,
    "op6_warc": op6_warc,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_filter_audit": op11_filter_audit,
    "op12_url_filters": op12_url_filters,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE: dict[str, str] = {
    "op3_substring_dedup": OP3_SQL,
    "op4_license_scan": OP4_SQL,
    "op5_secret_scan": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_url_filters": OP12_SQL,
    "op13_importance_resampling": OP13_SQL,
}
