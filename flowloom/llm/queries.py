"""The training-data operators' queries and their DuckDB SQL."""

from __future__ import annotations

from flowloom.llm import decontamination, fill_middle, filter_audit, fingerprints, html_extract, language_id, packing, quality, simhash, suffix_dedup, token_files, toxicity, url_filters

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_language_id": language_id.op2_language_id,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_quality": quality.op5_quality,
    "op6_packing": packing.op6_packing,
    "op7_url_filters": url_filters.op7_url_filters,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_token_files": token_files.op9_token_files,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_html_extract": html_extract.op12_html_extract,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
SQL = {"op7_url_filters": url_filters.OP7_SQL, "op10_decontamination": decontamination.OP10_SQL, "op11_fill_middle": fill_middle.OP11_SQL, "op13_filter_audit": filter_audit.OP13_SQL}
