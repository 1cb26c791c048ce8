"""Predicates of UPDATE / DELETE statements."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.functions.columns import as_expr

_OPS = {
    "=": operator.eq,
    "==": operator.eq,
    "<>": operator.ne,
    "!=": operator.ne,
    "<": operator.lt,
    ">": operator.gt,
    "<=": operator.le,
    ">=": operator.ge,
}

Predicate = Column | str | tuple


def predicate(preds: Predicate | Sequence[Predicate]) -> Column:
    """Conjunction of predicates.

    Each predicate is a Column, a SQL string, or ``(column, op, literal)``
    with op one of ``= <> != < > <= >=``.
    """
    if isinstance(preds, (Column, str, tuple)):
        preds = [preds]
    parts = []
    for p in preds:
        if isinstance(p, tuple):
            col, op, value = p
            if op not in _OPS:
                raise ValueError(f"unsupported comparison {op!r}")
            parts.append(_OPS[op](F.col(col), F.lit(value)))
        else:
            parts.append(as_expr(p))
    if not parts:
        raise ValueError("predicate: empty predicate list")
    return reduce(lambda a, b: a & b, parts)


def where_all(df: DataFrame, preds: Predicate | Sequence[Predicate]) -> DataFrame:
    """F1 / F2: rows for which every predicate is true."""
    return df.where(predicate(preds))


def exclude(df: DataFrame, preds: Predicate | Sequence[Predicate]) -> DataFrame:
    """rows for which the predicate is not true (false or NULL)."""
    return df.where(~F.coalesce(predicate(preds), F.lit(False)))
