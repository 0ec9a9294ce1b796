"""The queries of this subpackage and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

_WHERE = {
    "op1_token_store": "token_store",
    "op2_warc": "warc",
    "op3_prefix_free": "prefix_free",
    "op4_hilbert_pack": "hilbert_pack",
    "op5_pruned_graph": "pruned_graph",
    "op6_quality_rules": "quality_rules",
    "op7_secret_scan": "secrets",
    "op8_simhash_forest": "simhash_forest",
    "op9_byte_bpe": "byte_bpe",
    "op10_pii": "pii",
}


def queries() -> dict[str, Callable]:
    return {name: getattr(import_module(f"asofia.llm.{module}"), name) for name, module in _WHERE.items()}


def oracle_sql() -> dict[str, str]:
    return {}
