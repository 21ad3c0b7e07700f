"""The queries of this package and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "outliers", "exact_dedup", "licences", "personal_data", "packing",
    "near_dedup", "secret_scan", "lm_scoring", "mixing", "quality",
    "collocations", "hard_negatives", "suffix_dedup",
]


def queries() -> dict:
    found = {}
    for module in MODULES:
        found |= import_module(f"hardwood.llm.{module}").QUERIES
    return found | {"pipeline": import_module("corpus_pipeline").run}


def oracle_sql() -> dict:
    found = {}
    for module in MODULES:
        found |= import_module(f"hardwood.llm.{module}").SQL
    whole = import_module("corpus_pipeline").ORACLE_SQL
    return found | ({"pipeline": whole} if whole else {})
