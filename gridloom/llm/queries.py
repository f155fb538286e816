"""Queries of this subpackage, and SQL with the same results where SQL can express them."""

from __future__ import annotations

from . import byte_bpe, chat, divergence, html_text, imatch, jaccard_join, knn_join, packing, quality, resampling, secrets, toxicity, url_filter

_ALL = (
    url_filter.op1_url_filter,
    jaccard_join.op2_ngram_jaccard_join,
    quality.op3_quality_classifier,
    packing.op4_packing,
    imatch.op5_imatch,
    byte_bpe.op6_byte_bpe,
    html_text.op7_html_extraction,
    knn_join.op8_voronoi_knn,
    chat.op9_perspective_rotation,
    secrets.op10_secret_scan,
    resampling.op11_importance_resampling,
    toxicity.op12_toxicity,
    divergence.op13_source_divergence,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {"op1_url_filter": url_filter.OP1_SQL, "op8_voronoi_knn": knn_join.OP8_SQL, "op9_perspective_rotation": chat.OP9_SQL, "op11_importance_resampling": resampling.OP11_SQL, "op13_source_divergence": divergence.OP13_SQL}
