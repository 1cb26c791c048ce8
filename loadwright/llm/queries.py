"""All registered queries of the package and their DuckDB SQL."""

from __future__ import annotations

from . import (
    op1_merkle,
    op2_outliers,
    op3_secrets,
    op4_wrapper,
    op5_decontaminate,
    op6_templates,
    op7_toxicity,
    op8_mixing,
    op9_jaccard,
    op10_sharding,
    op11_collocations,
    op12_topk,
    op13_conversations,
)

_MODULES = (
    op1_merkle, op2_outliers, op3_secrets, op4_wrapper, op5_decontaminate,
    op6_templates, op7_toxicity, op8_mixing, op9_jaccard, op10_sharding,
    op11_collocations, op12_topk, op13_conversations,
)
QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
