"""Load patterns (L1-L13): the new content of a base table as one lazy plan.

Each function takes the current base and the staged rows as DataFrames and
returns a DataFrame; nothing is written here (see ``loadwright.sources.tables``
for sinks and ``loadwright.plans.apply`` for running a load end to end).

Staged rows are de-duplicated per key first (latest arrival wins), then mapped
onto the base columns.  Results keep the base's column order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadwright.functions.columns import as_expr, lower_names, map_columns
from loadwright.functions.types import conform
from loadwright.operators.dedup import distinct_table, latest_per_key, select_distinct
from loadwright.operators.filters import Predicate, exclude, predicate
from loadwright.operators.joins import (
    affected_partitions,
    flag_matches,
    matching,
    new_rows,
    not_in_null_aware,
    unaffected,
)
from loadwright.operators.merge import fits_broadcast, hash_placed, merged
from loadwright.operators.setops import stack
from loadwright.operators.skew import key_join, resolve
from loadwright.session import checkpointed

HIT = "__hit"


def _delta(
    base: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None,
    exprs: Sequence[str | Column] | None,
    stage_keys: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Latest staged row per key, mapped to the base columns (or ``columns``)."""
    nodups = latest_per_key(stage, list(stage_keys or keys), order_by)
    target = list(columns or base.columns)
    if exprs is not None:
        return _as_base(map_columns(nodups, target, exprs, allow_prefix=columns is not None), base)
    return _as_base(nodups.select(*target), base)


def _as_base(rows: DataFrame, base: DataFrame) -> DataFrame:
    """Rows in the base's column types: a load keeps the table's schema."""
    types = {f.name: f.dataType for f in base.schema.fields}
    return rows.select(
        *[
            F.col(f.name).cast(types[f.name]).alias(f.name) if types.get(f.name, f.dataType) != f.dataType else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


# ------------------------------------------------------------------ L1-L5


def history_load(
    stage: DataFrame,
    types: Mapping[str, str | T.DataType] | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """L1 / L2: every staged row, conformed, names lower-cased, duplicates kept;
    the partition column (if any) last.  The old base is discarded."""
    df = lower_names(conform(stage, types) if types else stage)
    if partition_col:
        p = partition_col.lower()
        df = df.select(*[c for c in df.columns if c != p], p)
    return df


def full_refresh(stage: DataFrame, exprs: Sequence[str | Column]) -> DataFrame:
    """L3: ``DISTINCT exprs(stage)``; the old base is discarded."""
    return select_distinct(stage, exprs)


def append_distinct(
    base: DataFrame,
    stage: DataFrame,
    exprs: Sequence[str | Column] | None = None,
    base_is_distinct: bool = False,
) -> DataFrame:
    """L4: ``DISTINCT (base UNION ALL exprs(stage))``; copies already in the
    base go too.

    With ``base_is_distinct`` (the base holds no copies, as after any earlier
    append-distinct) the same rows are the base plus ``distinct_new_rows``:
    the base is then only read, never de-duplicated as a whole.
    """
    if base_is_distinct:
        return stack(base, distinct_new_rows(base, stage, exprs))
    return distinct_table(stack(base, _mapped(base, stage, exprs)))


def _mapped(base: DataFrame, stage: DataFrame, exprs) -> DataFrame:
    if exprs:
        return stage.select(*[as_expr(e) for e in exprs]).toDF(*base.columns)
    return stage.select(*base.columns)


def distinct_new_rows(base: DataFrame, stage: DataFrame, exprs: Sequence[str | Column] | None = None) -> DataFrame:
    """Distinct staged rows that are not already in the base, compared on all
    columns with NULLs equal (as DISTINCT compares them).  Appending them to a
    distinct base gives L4's result without rewriting the base.

    A base row equal to a staged row has the same row hash, so the base is
    first cut down to the rows sharing a hash with some staged row: a semi
    join against the staged rows' distinct hashes, a side as small as the
    stage, which the planner broadcasts when it is small enough (so the base
    is read but not shuffled).  The exact all-column comparison then runs on
    that remainder only; hash collisions cost a comparison, never a row.
    """
    mapped = _mapped(base, stage, exprs)
    # in the base's types: equal values must hash equal (an int 1 and a
    # bigint 1 do not), and the rows are appended to the base as such
    new = mapped.select(
        *[
            (F.col(c) if mapped.schema[c].dataType == f.dataType else F.col(c).cast(f.dataType)).alias(c)
            for c, f in zip(base.columns, base.schema.fields)
        ]
    ).distinct()
    row_hash = F.xxhash64(*[F.col(c) for c in base.columns])
    staged_hashes = new.select(row_hash.alias("__h")).distinct()
    near = base.join(staged_hashes, row_hash == staged_hashes["__h"], "left_semi")
    b = near.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(base.columns)])
    cond = reduce(lambda x, y: x & y, [new[c].eqNullSafe(b[f"__b{i}"]) for i, c in enumerate(base.columns)])
    return new.join(b, cond, "left_anti")


def selected_rows(base: DataFrame, source: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """``SELECT cols FROM source`` named as the base's columns, by position."""
    picked = source.select(*[as_expr(c) for c in cols])
    if len(picked.columns) != len(base.columns):
        raise ValueError(
            f"insert_select: {len(cols)} columns for a {len(base.columns)}-column base"
        )
    return picked.toDF(*base.columns)


def insert_select(base: DataFrame, source: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Base plus ``SELECT cols FROM source``, paired by position.  Written
    by ``run_load`` as an append of ``selected_rows``: the base is not read."""
    return stack(base, selected_rows(base, source, cols))


# ------------------------------------------------------------------ upserts


def upsert(
    base: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    exprs: Sequence[str | Column] | None = None,
    stage_keys: Sequence[str] | None = None,
    skew="auto",
    not_in: str | None = None,
) -> DataFrame:
    """Base rows of keys not staged, plus the latest staged row per key.

    ``not_in`` names a column whose ``NOT IN`` the staged rows of the same
    keys decides instead (J7): a base row stays if its key is not staged, or
    if it and all staged rows of its key have values there and differ.

    Plan: window group limit on the stage (one shuffle on the keys), anti join
    of the base against the staged keys, union.  Rows with a NULL key are
    never matched, so a NULL-key base row and a NULL-key staged row both stay.
    """
    d = _delta(base, stage, keys, order_by, exprs, stage_keys)
    if not_in is not None:
        return stack(not_in_null_aware(base, d, not_in, keys, skew=skew), d)
    return stack(unaffected(base, _key_source(stage, d, exprs, stage_keys), keys, skew), d)


def _key_source(stage: DataFrame, d: DataFrame, exprs, stage_keys) -> DataFrame:
    """Frame to take the staged key set from.

    De-duplication keeps every key, so when the stage carries the base key
    columns unchanged its own distinct keys equal the delta's; reading them
    there skips a second evaluation of the de-duplication window.
    """
    return stage if exprs is None and stage_keys is None else d


def _split_null_keys(d: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Staged rows with every key set, and those with a NULL key.

    A NULL key never matches, so those rows are always new.  Both join
    branches then read the same non-null frame: the two plans are identical
    below the de-duplication exchange, and Spark reuses that shuffle instead
    of running the window twice.
    """
    has_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return d.where(has_keys), d.where(~has_keys)


def _left_pair(base: DataFrame, d: DataFrame, keys: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Every base row (alias ``a``) with its staged row (alias ``m``) if any.

    A left outer join; the staged side holds one row per key and carries the
    ``HIT`` flag.  Hot base keys are salted (``hot``).
    """
    return key_join(base, d.withColumn(HIT, F.lit(True)), [(k, k) for k in keys], "left", hot)


def upsert_partial(
    base: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    exprs: Sequence[str | Column] | None = None,
    skew="auto",
    one_pass: bool | None = None,
) -> DataFrame:
    """Like ``upsert`` but the stage carries only the keys and ``columns``;
    every other base column keeps the existing row's value (P12), and is NULL
    for a new key.  ``one_pass`` as in ``upsert_accumulate``."""
    listed = list(dict.fromkeys([*keys, *columns]))
    d = _delta(base, stage, keys, order_by, exprs, columns=listed)
    return _partial(base, d, _key_source(stage, d, exprs, None), keys, listed, skew, one_pass)


def _in_one_pass(base: DataFrame, delta: DataFrame, skew, one_pass: bool | None) -> bool:
    """One pass over both sides, or joins that read the base's keys again?

    A stage that Catalyst would broadcast is joined (the base is not shuffled
    then), and so is one against a base that is bucketed already, or with hot
    keys that were not sampled from this base.
    """
    if one_pass is None:
        one_pass = not fits_broadcast(delta) and not hash_placed(base)
    return one_pass and not isinstance(skew, DataFrame)


def _partial(base: DataFrame, delta: DataFrame, key_source: DataFrame, keys: Sequence[str],
             listed: Sequence[str], skew, one_pass: bool | None = None) -> DataFrame:
    """L7 over staged rows that are de-duplicated already."""
    if _in_one_pass(base, delta, skew, one_pass):
        new, hit = F.col("a").isNull(), F.col("m").isNotNull()
        return merged(base, delta, keys, resolve(skew, base, keys)).select(*[
            (F.when(new | hit, F.col(f"m.{c}")).otherwise(F.col(f"a.{c}")) if c in listed else F.col(f"a.{c}")).alias(c)
            for c in base.columns
        ])
    d, d_null = _split_null_keys(delta, keys)
    hot = resolve(skew, base, keys)
    joined = _left_pair(base, d, keys, hot)
    hit = F.col(f"m.{HIT}").isNotNull()
    updated = joined.select(
        *[
            (F.when(hit, F.col(f"m.{c}")).otherwise(F.col(f"a.{c}")) if c in listed and c not in keys else F.col(f"a.{c}")).alias(c)
            for c in base.columns
        ]
    )
    fresh = stack(new_rows(d, base, keys, key_source, hot, None), d_null).select(
        *[(F.col(c) if c in listed else F.lit(None).cast(base.schema[c].dataType)).alias(c) for c in base.columns]
    )
    return stack(updated, fresh)


def fill_from_base(delta: DataFrame, base: DataFrame, keys: Sequence[str], skew="auto") -> DataFrame:
    """Staged rows completed with the existing row's values for the base
    columns they lack; NULL when the key is new.

    Planned as a salted inner pairing (one output row per matching base row)
    plus the staged rows with no base row, instead of a left join that keeps
    the staged side: a base key holding many rows is then spread over tasks.
    """
    hot = resolve(skew, base, list(keys))
    paired = key_join(base, delta, [(k, k) for k in keys], "inner", hot).select(
        *[(F.col(f"m.{c}") if c in delta.columns else F.col(f"a.{c}")).alias(c) for c in base.columns]
    )
    lonely = new_rows(delta, base, keys, None, hot).select(
        *[(F.col(c) if c in delta.columns else F.lit(None).cast(base.schema[c].dataType)).alias(c) for c in base.columns]
    )
    return stack(paired, lonely)


def upsert_accumulate(
    base: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    sets: Mapping[str, str | Column],
    order_by: Sequence[str | Column] | None = None,
    exprs: Sequence[str | Column] | None = None,
    skew="auto",
    one_pass: bool | None = None,
) -> DataFrame:
    """Unaffected base rows, new staged rows as they are, and for a key
    in both the staged row with the SET expressions applied over the old row
    (``a``) and the staged row (``m``), e.g. ``{"qty": "a.qty + m.qty"}``.

    A stage too large to broadcast is merged with the base in one pass
    (``operators.merge``): the base is read and shuffled once.  A smaller one
    takes two joins: base LEFT JOIN staged (matched and unaffected rows; a
    matched flag, not a data column, tells them apart) and staged ANTI JOIN
    distinct base keys (new rows); the base is not shuffled, its keys are read
    twice.  ``one_pass`` decides it instead of the size estimate.
    """
    d = _delta(base, stage, keys, order_by, exprs)
    return _accumulate(base, d, _key_source(stage, d, exprs, None), keys, sets, skew, one_pass)


def _accumulate(base: DataFrame, delta: DataFrame, key_source: DataFrame, keys: Sequence[str],
                sets: Mapping[str, str | Column], skew, one_pass: bool | None = None) -> DataFrame:
    """L8 over staged rows that are de-duplicated already."""
    if _in_one_pass(base, delta, skew, one_pass):
        return merged(base, delta, keys, resolve(skew, base, keys)).select(*[
            F.when(F.col("a").isNull(), F.col(f"m.{c}"))
            .when(F.col("m").isNotNull(), as_expr(sets[c]) if c in sets else F.col(f"m.{c}"))
            .otherwise(F.col(f"a.{c}")).cast(base.schema[c].dataType).alias(c)
            for c in base.columns
        ])
    d, d_null = _split_null_keys(delta, keys)
    hot = resolve(skew, base, keys)
    joined = _left_pair(base, d, keys, hot)
    hit = F.col(f"m.{HIT}").isNotNull()
    cols = []
    for c in base.columns:
        if c in sets:
            new = as_expr(sets[c])
        else:
            new = F.col(f"m.{c}")
        cols.append(F.when(hit, new).otherwise(F.col(f"a.{c}")).cast(base.schema[c].dataType).alias(c))
    updated = joined.select(*cols)
    return stack(updated, new_rows(d, base, keys, key_source, hot, None), d_null)


def upsert_partitioned(
    base: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    order_by: Sequence[str | Column] | None = None,
    exprs: Sequence[str | Column] | None = None,
    scope: str = "partition",
    skew="auto",
    sets: Mapping[str, str | Column] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The rebuilt partitions, to be written by ``overwrite_partitions``.

    With ``sets`` (as L8) or ``columns`` (as L7, the partition column among
    them) the staged rows are accumulated or filled from the old ones there.

    ``scope="partition"`` rebuilds the partitions the staged rows land in:
    their base rows not replaced by a staged key, plus the staged rows.  A
    key staged into another partition than its old one keeps its old copy
    (the old partition is not touched).  ``scope="table"`` also rebuilds the
    partitions that hold an old copy of a staged key, so every key stays
    unique.

    The staged rows are de-duplicated once and checkpointed, as they give the
    touched partitions and the new rows; with ``scope="table"`` one sample of
    the base's keys serves both joins.
    """
    if columns is not None and partition_col not in [*keys, *columns]:
        raise ValueError("a partial upsert by partition needs the partition column among its columns")
    listed = None if columns is None else list(dict.fromkeys([*keys, *columns]))
    if scope not in ("partition", "table"):
        raise ValueError("scope must be 'partition' or 'table'")
    d = checkpointed(_delta(base, stage, keys, order_by, exprs, columns=listed))
    touched = d.select(partition_col)
    if scope == "table":
        skew = resolve(skew, base, keys)
        touched = touched.unionByName(matching(base, d, keys, "left_semi", skew).select(partition_col))
    in_touched = affected_partitions(base, touched, partition_col)
    if sets:
        return _accumulate(in_touched, d, d, keys, sets, skew)
    if listed:
        return _partial(in_touched, d, d, keys, listed, skew)
    return stack(unaffected(in_touched, d, keys, skew), d)


def untouched_partitions(base: DataFrame, rebuilt: DataFrame, partition_col: str) -> DataFrame:
    """Base rows outside the rebuilt partitions (what dynamic overwrite keeps)."""
    return matching(base, rebuilt, [partition_col], "left_anti")


# ------------------------------------------------------------------ update / delete


def _sets(df: DataFrame, sets: Mapping[str, object], cond: Column) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in sets:
            v = sets[c]
            val = v if isinstance(v, Column) else F.lit(v)
            cols.append(F.when(cond, val.cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def update_where(base: DataFrame, preds: Predicate | Sequence[Predicate], sets: Mapping[str, object]) -> DataFrame:
    """``UPDATE base SET col = value WHERE preds`` (P10 with F1): rows
    meeting every predicate get the values; others, including rows where a
    predicate is NULL, are unchanged."""
    return _sets(base, sets, F.coalesce(predicate(preds), F.lit(False)))


def update_from(
    base: DataFrame,
    stage: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    sets: Mapping[str, object],
    skew="auto",
) -> DataFrame:
    """Rows with a matching stage row (J8) get the SET values."""
    flagged = flag_matches(base, stage, on, HIT, skew)
    return _sets(flagged, sets, F.col(HIT)).drop(HIT)


def delete_where(base: DataFrame, preds: Predicate | Sequence[Predicate]) -> DataFrame:
    """``DELETE FROM base WHERE preds``: keep rows where the predicate
    is false or NULL."""
    return exclude(base, preds)


def delete_from(base: DataFrame, stage: DataFrame, on: Mapping[str, str] | Sequence[str], skew="auto") -> DataFrame:
    """Base rows with no matching stage row."""
    return matching(base, stage, on, "left_anti", skew)
