"""Queries and SQL of the ten operators."""

from . import bpe, neardup, packing, quality, rules, secret_scan, tokenfiles, topk, toxicity, warc

MODULES = (toxicity, bpe, quality, tokenfiles, topk, packing, rules, secret_scan, neardup, warc)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
