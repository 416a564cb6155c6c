"""The queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from . import chat_format, decontaminate, html_extract, ngram_jaccard, packing, quality_classifier, quality_rules, secret_scan, toxicity, url_filters

QUERIES = {
    "op1_ngram_jaccard": ngram_jaccard.op1_ngram_jaccard,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_packing": packing.op4_packing,
    "op5_url_filters": url_filters.op5_url_filters,
    "op6_secret_scan": secret_scan.op6_secret_scan,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_html_extract": html_extract.op8_html_extract,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_toxicity": toxicity.op10_toxicity,
}
ORACLE_SQL = {**ngram_jaccard.ORACLE_SQL, **chat_format.ORACLE_SQL, **url_filters.ORACLE_SQL}
