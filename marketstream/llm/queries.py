"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from marketstream.llm.extraction import op2_html_extraction
from marketstream.llm.filter_audit import SQL as AUDIT_SQL
from marketstream.llm.filter_audit import op13_filter_audit
from marketstream.llm.langid import op10_language_id
from marketstream.llm.neighbours import op4_nearest_neighbours
from marketstream.llm.ngram_join import op6_ngram_join
from marketstream.llm.packing import op5_best_fit_packing
from marketstream.llm.pii import op9_pii
from marketstream.llm.quality import op7_quality_classifier
from marketstream.llm.rules import op8_quality_rules
from marketstream.llm.sentencepiece import op3_sentencepiece
from marketstream.llm.sharding import op1_sharding
from marketstream.llm.topk import SQL as TOPK_SQL
from marketstream.llm.topk import op11_exact_topk
from marketstream.llm.variants import SQL as VARIANTS_SQL
from marketstream.llm.variants import op12_spelling_variants

QUERIES = [op1_sharding, op2_html_extraction, op3_sentencepiece, op4_nearest_neighbours,
           op5_best_fit_packing, op6_ngram_join, op7_quality_classifier, op8_quality_rules, op9_pii,
           op10_language_id, op11_exact_topk, op12_spelling_variants,
           op13_filter_audit]


def all_queries() -> dict:
    return {q.__name__: q for q in QUERIES}


def all_sql() -> dict[str, str]:
    return {"op11_exact_topk": TOPK_SQL, "op12_spelling_variants": VARIANTS_SQL,
            "op13_filter_audit": AUDIT_SQL}
