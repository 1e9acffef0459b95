"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import clustering, decontaminate, license_scan, line_dedup, lm_scoring, mixing, near_dedup, nearest, page_text, resampling, substring_dedup, toxicity, url_filter

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_lm_scoring": lm_scoring.op5_lm_scoring,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_mixing": mixing.op7_mixing,
    "op8_page_text": page_text.op8_page_text,
    "op9_nearest": nearest.op9_nearest,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_resampling": resampling.op11_resampling,
    "op12_url_filter": url_filter.op12_url_filter,
    "op13_clustering": clustering.op13_clustering,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op11_resampling": resampling.OP11_SQL,
    "op12_url_filter": url_filter.OP12_SQL,
    "op13_clustering": clustering.OP13_SQL,
}
