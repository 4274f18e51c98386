"""Queries and SQL of this subpackage, for the entry module."""

from __future__ import annotations

import importlib

#: Modules with QUERIES (name -> function of (spark, sf_dir)) and, where SQL can express one, ORACLES (name -> SQL).
MODULES = ("suffix_dedup", "quality_classifier", "language_id", "toxicity", "warc", "line_dedup", "mixing", "quality_rules", "decontam", "simhash_dedup", "centroids", "turn_repair", "personal_data")


def _all(kind: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(f"stratavox.llm.{name}"), kind, {})
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLES")
