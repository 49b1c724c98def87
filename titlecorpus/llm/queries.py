"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from titlecorpus.llm import html_text, inner_product, line_dedup, near_dedup, neighbours, packing, periodic, pieces, quality, toxicity, url_filter, warc, whitening

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_warc": warc.op4_warc,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_neighbours": neighbours.op7_neighbours,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_html_text": html_text.op10_html_text,
    "op11_whitening": whitening.op11_whitening,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_exact_search": inner_product.op13_exact_search,
}
ORACLE_SQL = {
    "op1_quality_rules": quality.ORACLE_SQL,
    "op4_warc": warc.ORACLE_SQL,
    "op9_url_filter": url_filter.ORACLE_SQL,
    "op13_exact_search": inner_product.ORACLE_SQL,
}
