"""The queries of this subpackage and their SQL twins, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from importlib import import_module

_MODULES = {
    "op1_decontamination": "op01_decontamination",
    "op2_chat_formatting": "op02_chat_formatting",
    "op3_best_fit_packing": "op03_best_fit_packing",
    "op4_ngram_jaccard": "op04_ngram_jaccard",
    "op5_url_filters": "op05_url_filters",
    "op6_suffix_array_dedup": "op06_suffix_array_dedup",
    "op7_language_id": "op07_language_id",
    "op8_quality_classifier": "op08_quality_classifier",
    "op9_substring_dedup": "op09_substring_dedup",
    "op10_embedding_neardup": "op10_embedding_neardup",
    "op11_hard_negatives": "op11_hard_negatives",
    "op12_sentencepiece": "op12_sentencepiece",
    "op13_fill_in_middle": "op13_fill_in_middle",
}

QUERIES = {}
ORACLE = {}
for _name, _module in _MODULES.items():
    _m = import_module(f".{_module}", __package__)
    QUERIES[_name] = getattr(_m, _name)
    if getattr(_m, "SQL", None):
        ORACLE[_name] = _m.SQL
