"""Delimited stage files (S1) with Hive text-table semantics.

Each line is one row.  Fields are split on the separator with no quoting;
a missing trailing field is NULL, extra fields are dropped, ``\\N`` is NULL,
an empty field stays ``''`` for a string column and is NULL for any other
type, and a value that does not parse as its type is NULL.

Spark's CSV reader turns an empty string field into NULL even with
``emptyValue=''``, so lines are read with the text source and split by
built-in expressions, which stay inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadwright.functions.types import cast_text

# Hive text-table defaults.
DEFAULT_SEPARATOR = "|"
NULL_TOKEN = "\\N"


def parse_stage_lines(
    lines: DataFrame,
    schema: T.StructType,
    sep: str = DEFAULT_SEPARATOR,
    null_token: str = NULL_TOKEN,
    value_col: str = "value",
) -> DataFrame:
    """Split a one-column DataFrame of lines into typed columns."""
    fields = F.split(F.col(value_col), re.escape(sep), -1)
    out = []
    for i, field in enumerate(schema.fields):
        raw = F.get(fields, i)
        raw = F.when(raw == F.lit(null_token), F.lit(None)).otherwise(raw)
        out.append(cast_text(raw, field.dataType).alias(field.name))
    return lines.select(*out)


def scan_stage(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = DEFAULT_SEPARATOR,
    null_token: str = NULL_TOKEN,
) -> DataFrame:
    """Read ``sep``-delimited text files under a declared schema."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths)
    return parse_stage_lines(lines, schema, sep, null_token)


def stage_text(df: DataFrame, sep: str = DEFAULT_SEPARATOR, null_token: str = NULL_TOKEN) -> DataFrame:
    """Rows as Hive text lines: fields joined by ``sep``, NULL as ``\\N``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(null_token)) for c in df.columns]
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def write_stage(
    df: DataFrame,
    path: str,
    sep: str = DEFAULT_SEPARATOR,
    null_token: str = NULL_TOKEN,
    mode: str = "error",
) -> None:
    """Write rows as a Hive text stage folder (the inverse of ``scan_stage``)."""
    stage_text(df, sep, null_token).write.mode(mode).text(path)
