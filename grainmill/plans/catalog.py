"""Registered queries of the library's own operators, and their SQL."""

from __future__ import annotations

from grainmill.plans import corpus, curation, duplicates, records, text, tokens

MODULES = (corpus, text, duplicates, curation, records, tokens)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
