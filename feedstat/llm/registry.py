"""Registered queries of the corpus operators and their SQL checks."""

from __future__ import annotations

from feedstat.llm import (
    bpe, exact_dedup, line_dedup, ngram_join, packing, prefix_trie, quality_model, quality_rules, substring_dedup,
    suffix_dedup, top_search, toxicity, whitening,
)

SECTIONS = (
    bpe, ngram_join, substring_dedup, exact_dedup, quality_rules, packing, line_dedup, quality_model, suffix_dedup, toxicity,
    prefix_trie, top_search, whitening,
)
QUERIES = {name: query for section in SECTIONS for name, query in section.QUERIES.items()}
ORACLES = {name: sql for section in SECTIONS for name, sql in getattr(section, "ORACLES", {}).items()}
