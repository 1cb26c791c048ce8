"""Duplicate-keeping unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def stack(*dfs: DataFrame) -> DataFrame:
    """``UNION ALL`` by column name, in the first frame's column order."""
    if not dfs:
        raise ValueError("stack: nothing to stack")
    cols = dfs[0].columns
    return reduce(lambda a, b: a.unionByName(b), dfs).select(*cols)
