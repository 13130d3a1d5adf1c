"""All registered queries and their SQL checks."""

from __future__ import annotations

from feedstat.plans import checks, choices, columns, inference, scans, summaries, windows, writes

SECTIONS = (scans, writes, columns, summaries, windows, choices, checks, inference)


def all_queries():
    return {name: query for section in SECTIONS for name, query in section.QUERIES.items()}


def all_oracles():
    return {name: sql for section in SECTIONS for name, sql in section.ORACLES.items()}
