"""Queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from shardloom.llm import bpe, collocations, decontaminate, divergence, langid, mixing, near_duplicates, neighbours, phrases, quality, suffixes, toxicity, warc
from shardloom.llm.common import Query

MODULES = (decontaminate, langid, mixing, near_duplicates, neighbours, phrases, quality, suffixes, toxicity, warc, divergence, collocations, bpe)


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
