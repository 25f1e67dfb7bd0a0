"""The registered queries of this package: one ``opN_<name>`` for each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from textsieve.llm import (
    bpe,
    collocations,
    filter_audit,
    graph_dedup,
    line_dedup,
    mixing,
    pii,
    quality_model,
    quality_rules,
    simhash,
    substring_dedup,
    toxicity,
    warc,
)

MODULES = (simhash, quality_model, line_dedup, quality_rules, warc, substring_dedup, mixing, bpe, graph_dedup, pii,
           filter_audit, toxicity, collocations)

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
