"""Column-level helpers: projections of a load statement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The one column rename the reference hard-codes.
LEGACY_RENAMES = {"item_nbr": "mds_fam_id"}


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_expr(e: str | Column) -> Column:
    """A column from a SQL expression string or a Column."""
    return F.expr(e) if isinstance(e, str) else e


def rename(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Rename columns; names match without regard to case."""
    mapping = dict(LEGACY_RENAMES if mapping is None else mapping)
    lowered = {k.lower(): v for k, v in mapping.items()}
    present = {c.lower(): c for c in df.columns}
    renames = {present[k]: v for k, v in lowered.items() if k in present}
    return df.withColumnsRenamed(renames) if renames else df


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def map_columns(
    stage: DataFrame,
    base_columns: Sequence[str],
    exprs: Sequence[str | Column],
    allow_prefix: bool = False,
    equal_counts: bool = False,
) -> DataFrame:
    """P5: ``INSERT INTO t (c1..cn) VALUES (e1..en)`` over the stage rows.

    Column i of the base gets expression i.  With fewer expressions than
    columns only the leading columns are filled (``allow_prefix=True``;
    otherwise an error); extra expressions are ignored, as upsert and insert
    do.  ``equal_counts`` (the rule of update and delete) refuses both.
    """
    if equal_counts and len(exprs) != len(base_columns):
        raise ValueError(f"map_columns: {len(base_columns)} columns but {len(exprs)} expressions")
    if len(exprs) < len(base_columns) and not allow_prefix:
        raise ValueError(
            f"map_columns: {len(base_columns)} columns but {len(exprs)} expressions"
        )
    pairs = list(zip(base_columns, exprs))
    return stage.select(*[as_expr(e).alias(c) for c, e in pairs])


def concat_cols(*cols: str | Column) -> Column:
    """``a || b``; NULL if any part is NULL."""
    return F.concat(*[as_col(c) for c in cols])


def substr_col(c: str | Column, start: int, length: int) -> Column:
    """``substr(c, start, length)``, 1-based like SQL."""
    return F.substring(as_col(c), start, length)


def set_literal(df: DataFrame, column: str, value, when: Column | None = None) -> DataFrame:
    """P10: a hard-coded SET value replaces a column (on rows meeting ``when``).

    The value is cast to the column's own type, so the schema is unchanged.
    """
    dtype = df.schema[column].dataType
    lit = F.lit(value).cast(dtype)
    new = lit if when is None else F.when(when, lit).otherwise(F.col(column))
    return df.withColumn(column, new)


def accumulate_exprs(
    columns: Sequence[str],
    sets: Mapping[str, str | Column],
    base_alias: str = "a",
    stage_alias: str = "m",
) -> list[Column]:
    """Select list for a matched pair (base ``a``, stage ``m``).

    A column in ``sets`` takes its expression (e.g. ``a.qty + m.qty``); every
    other column, keys included, keeps the stage value.
    """
    return [
        as_expr(sets[c]).alias(c) if c in sets else F.col(f"{stage_alias}.{c}").alias(c)
        for c in columns
    ]
