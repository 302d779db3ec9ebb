"""The queries of this package, by name, and the SQL that checks them."""
from __future__ import annotations

import importlib

#: Query name -> module of this package that holds it.
MODULES = {
    "op1_fingerprint": "fingerprint",
    "op2_sharding": "sharding",
    "op3_toxicity": "toxicity",
    "op4_chat": "chat",
    "op5_simhash": "simhash",
    "op6_quality": "quality",
    "op7_packing": "packing",
    "op8_suffix_dedup": "suffix_dedup",
    "op9_warc": "warc",
    "op10_decontaminate": "decontaminate",
    "op11_jaccard": "count_tree",
    "op12_clusters": "exponion",
    "op13_whitening": "whitening",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"{__package__}.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, module in MODULES.items():
        sql = getattr(importlib.import_module(f"{__package__}.{module}"), "ORACLE_SQL", None)
        if sql:
            out[name] = sql
    return out
