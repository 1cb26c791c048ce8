"""Key joins of the load patterns.

All joins are equi-joins on key columns, with SQL equality: a NULL key never
matches.  Physical strategy is left to Catalyst and adaptive execution (a side
measured small at runtime is broadcast; otherwise sort-merge).

Where only the existence of a key on the other side matters (semi / anti
joins), that side is reduced to its distinct keys first: a partial
aggregation whose shuffle is the one the join needs anyway, so a key holding
a large share of those rows collapses to one row per map task.  The side
whose rows are kept is not reduced; its hot keys are salted
(``loadwright.operators.skew``) when ``skew="auto"`` finds any.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.operators.dedup import global_sequence
from loadwright.operators.merge import fits_broadcast, hash_placed, not_in_rows
from loadwright.operators.skew import key_join, resolve
from loadwright.session import checkpointed


def _key_map(keys: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    if isinstance(keys, Mapping):
        return dict(keys)
    return {k: k for k in keys}


def key_set(df: DataFrame, keys: Sequence[str] | Mapping[str, str], prefix: str = "__k") -> tuple[DataFrame, dict[str, str]]:
    """Distinct keys of ``df``, renamed ``__k0, __k1, ..``, and the key map.

    ``keys`` maps a column of the other (left) frame to a column of ``df``;
    a list means the same names on both sides.
    """
    km = _key_map(keys)
    renamed = [F.col(right).alias(f"{prefix}{i}") for i, right in enumerate(km.values())]
    return df.select(*renamed).distinct(), km


def _exists_join(left: DataFrame, right: DataFrame, keys, how: str, skew="auto") -> DataFrame:
    """Rows of ``left`` with (semi) or without (anti) a key match in ``right``."""
    ks, km = key_set(right, keys)
    lcols = list(km.keys())
    hot = resolve(skew, left, lcols)
    j = key_join(left, ks, [(lc, f"__k{i}") for i, lc in enumerate(lcols)], how, hot)
    return j.select(*[F.col(f"a.{c}").alias(c) for c in left.columns])


def _shared_keys(delta: DataFrame, base: DataFrame, keys: Sequence[str] | Mapping[str, str], skew="auto") -> DataFrame:
    """Distinct keys of ``base`` that also occur in ``delta``, as ``__k0..``.

    The base keys are first semi-joined against the delta's keys, so the
    distinct runs over matched keys only (bounded by the delta), and when the
    delta's keys are small enough to broadcast the base is not shuffled.
    """
    km = _key_map(keys)  # delta column -> base column
    hot = resolve(skew, base, list(km.values()))
    bk = base.select(*[F.col(b).alias(f"__k{i}") for i, b in enumerate(km.values())])
    dk = delta.select(*[F.col(d).alias(f"__d{i}") for i, d in enumerate(km.keys())]).distinct()
    pairs = [(f"__k{i}", f"__d{i}") for i in range(len(km))]
    if hot is not None:
        # With hot keys the base keys are made distinct first: the partial
        # aggregation leaves one row per key per map task, so no task
        # receives a hot key's rows and the semi join needs no salt.
        j = key_join(bk.distinct(), dk, pairs, "left_semi")
        return j.select(*[F.col(f"a.__k{i}").alias(f"__k{i}") for i in range(len(km))])
    j = key_join(bk, dk, pairs, "left_semi")
    return j.select(*[F.col(f"a.__k{i}").alias(f"__k{i}") for i in range(len(km))]).distinct()


def _against_shared(
    delta: DataFrame,
    base: DataFrame,
    keys,
    how: str,
    key_source: DataFrame | None = None,
    skew="auto",
    delta_skew="auto",
) -> DataFrame:
    km = _key_map(keys)
    shared = _shared_keys(delta if key_source is None else key_source, base, km, skew)
    dcols = list(km.keys())
    hot = resolve(delta_skew, delta, dcols)
    j = key_join(delta, shared, [(d, f"__k{i}") for i, d in enumerate(dcols)], how, hot)
    return j.select(*[F.col(f"a.{c}").alias(c) for c in delta.columns])


def unaffected(base: DataFrame, delta: DataFrame, keys: Sequence[str] | Mapping[str, str], skew="auto") -> DataFrame:
    """Base rows with no delta row of the same key (NOT IN / NOT EXISTS)."""
    return _exists_join(base, delta, keys, "left_anti", skew)


def new_rows(
    delta: DataFrame,
    base: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    key_source: DataFrame | None = None,
    skew="auto",
    delta_skew="auto",
) -> DataFrame:
    """Delta rows whose key is not in base.

    ``key_source`` may name a cheaper frame with the same key set as
    ``delta`` (e.g. the stage before de-duplication) to look keys up from.
    ``skew`` is about the base's keys, ``delta_skew`` about the delta's (None
    when the delta holds one row per key).
    """
    return _against_shared(delta, base, keys, "left_anti", key_source, skew, delta_skew)


def matched_rows(
    delta: DataFrame,
    base: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    skew="auto",
    delta_skew="auto",
) -> DataFrame:
    """Delta rows whose key is in base."""
    return _against_shared(delta, base, keys, "left_semi", None, skew, delta_skew)


# Bounds on the set of touched partition values.  Up to MAX_PRUNE_VALUES
# they become a literal IN filter on the partition column, which the file
# source turns into partition pruning at planning time (untouched partitions
# are never listed or read).  Up to MAX_BROADCAST_PARTITIONS they are joined
# as a broadcast side; beyond that the planner picks the join.
MAX_PRUNE_VALUES = 10_000
MAX_BROADCAST_PARTITIONS = 100_000
# A larger set prunes the scan by this many ranges that hold all its values.
PRUNE_RANGES = 500


def touched_values(delta: DataFrame, col: str) -> tuple[DataFrame, int]:
    """Distinct values of ``delta.col`` (as ``__k0``), written to the shared
    checkpoint folder, and how many there are.

    The set is materialised once, so counting it and using it do not compute
    the delta twice; it is bounded by the number of partitions of the table.
    """
    vals = delta.select(F.col(col).alias("__k0")).distinct()
    vals = checkpointed(vals)
    return vals, vals.count()


def affected_partitions(
    base: DataFrame, delta: DataFrame, partition_col: str, delta_col: str | None = None, max_listed: int = MAX_PRUNE_VALUES
) -> DataFrame:
    """Base rows in a partition the delta touches (``p IN (SELECT DISTINCT p ..)``).

    The touched values are counted first.  A small set (the partition values
    of one load; metadata, bounded by the table's partition count) becomes a
    literal ``IN`` list, so the scan reads only those partitions.  A larger
    one prunes the scan by ranges (``value_ranges``) and is joined: as a
    broadcast side up to ``MAX_BROADCAST_PARTITIONS``, so the base is not
    shuffled on its partition column, where a heavy partition would land in
    one task.
    """
    vals, n = touched_values(delta, delta_col or partition_col)
    if n <= max_listed:
        listed = sorted((r[0] for r in vals.collect()), key=lambda v: (v is not None, v))
        pred = F.col(partition_col).isin([v for v in listed if v is not None])
        if any(v is None for v in listed):
            # A NULL partition value is a partition too (Hive's default
            # partition): it is rewritten, so its base rows must be kept.
            pred = pred | F.col(partition_col).isNull()
        return base.where(pred)
    base = base.where(in_ranges(F.col(partition_col), value_ranges(vals, n)))
    if n <= MAX_BROADCAST_PARTITIONS:
        vals = F.broadcast(vals)
    return base.join(vals, base[partition_col].eqNullSafe(vals["__k0"]), "left_semi")


def value_ranges(vals: DataFrame, n: int) -> list[tuple]:
    """At most ``PRUNE_RANGES`` (low, high) ranges that hold all values of
    ``__k0``, in order; ``(None, None)`` stands for NULL.

    The sorted values are cut into runs of equal length, numbered over range
    partitions, so only the ends of the runs come to the driver.
    """
    run = -(-n // PRUNE_RANGES)
    known = global_sequence(vals.where(F.col("__k0").isNotNull()), ["__k0"], "__n")
    ends = known.groupBy(F.floor((F.col("__n") - 1) / run).alias("__run")).agg(F.min("__k0"), F.max("__k0")).collect()
    out = sorted((low, high) for _, low, high in ends)
    if vals.where(F.col("__k0").isNull()).head(1):
        out.append((None, None))
    return out


def in_ranges(col: Column, ranges: Sequence[tuple]) -> Column:
    """Is ``col`` in one of the ranges?  A filter on a partition column, as a
    balanced tree of ORs (a chain of hundreds would be a deep plan)."""
    tests = [col.isNull() if low is None else col.between(F.lit(low), F.lit(high)) for low, high in ranges] or [F.lit(False)]
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def unaffected_in_partitions(
    base: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    skew="auto",
) -> DataFrame:
    """Rows of the touched partitions that no delta row replaces."""
    return unaffected(affected_partitions(base, delta, partition_col), delta, keys, skew)


def pair(
    delta: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    flag: str | None = None,
    skew="auto",
) -> DataFrame:
    """Delta (alias ``m``) joined to base (alias ``a``) on the keys.

    Columns are reached as ``m.col`` / ``a.col``.  With ``flag`` the delta
    side carries a non-null marker column, so after an outer join a matched
    row is told apart from a miss without looking at nullable data columns.
    An inner pairing salts the base's hot keys.
    """
    m = delta.withColumn(flag, F.lit(True)) if flag else delta
    if how == "inner":
        hot = resolve(skew, base, list(keys))
        if hot is not None:
            return key_join(base, m, [(k, k) for k in keys], "inner", hot)
    cond = reduce(lambda a, b: a & b, [F.col(f"m.{k}") == F.col(f"a.{k}") for k in keys])
    return m.alias("m").join(base.alias("a"), cond, how)


def matching(
    base: DataFrame,
    stage: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    how: str = "left_semi",
    skew="auto",
) -> DataFrame:
    """Base rows that have (``left_semi``) or lack (``left_anti``) a stage
    row with ``base.a = stage.b`` for every ``{a: b}`` in ``on``."""
    if how not in ("left_semi", "left_anti"):
        raise ValueError("matching: how must be left_semi or left_anti")
    return _exists_join(base, stage, on, how, skew)


def flag_matches(
    base: DataFrame,
    stage: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    flag: str = "__hit",
    skew="auto",
) -> DataFrame:
    """Base rows, each with a boolean ``flag``: does a stage row match it?

    A left join against the stage's distinct keys, so no base row is repeated.
    """
    ks, km = key_set(stage, on)
    ks = ks.withColumn(flag, F.lit(True))
    lcols = list(km.keys())
    hot = resolve(skew, base, lcols)
    j = key_join(base, ks, [(lc, f"__k{i}") for i, lc in enumerate(lcols)], "left", hot)
    return j.select(
        *[F.col(f"a.{c}").alias(c) for c in base.columns],
        F.coalesce(F.col(f"m.{flag}"), F.lit(False)).alias(flag),
    )


def not_in_null_aware(
    base: DataFrame,
    delta: DataFrame,
    col: str,
    on: Sequence[str] | Mapping[str, str],
    delta_col: str | None = None,
    skew="auto",
    one_pass: bool | None = None,
) -> DataFrame:
    """``base.col NOT IN (SELECT s.col FROM delta s WHERE base.on = s.on)``.

    SQL three-valued logic: a base row whose correlated set is empty is kept;
    otherwise it is dropped when its ``col`` is NULL, when the set holds its
    value, or when the set holds a NULL.

    A delta too large to broadcast goes through ``merge.not_in_rows``: one
    shuffle of the base, by ``on``.  Otherwise (``one_pass`` decides it instead
    of the size estimate) planned as two left joins against aggregates of the delta (per ``on``
    group: does it exist, does it hold a NULL; and the distinct non-null
    ``(on, col)`` pairs) instead of the anti join with an ``OR isnull``
    condition that a correlated NOT IN becomes; the aggregates shrink before
    the shuffle, so a heavy group does not pile up in one task.
    """
    km = _key_map(on)
    dcol = delta_col or col
    lon = list(km.keys())
    if one_pass is None:
        one_pass = not fits_broadcast(delta) and not hash_placed(base)
    if one_pass:
        return not_in_rows(base, delta, col, lon, dcol, list(km.values()), resolve(skew, base, lon))
    groups = delta.groupBy(*[F.col(r).alias(f"__g{i}") for i, r in enumerate(km.values())]).agg(
        F.max(F.col(dcol).isNull()).alias("__anynull")
    )
    pairs = (
        delta.where(F.col(dcol).isNotNull())
        .select(*[F.col(r).alias(f"__p{i}") for i, r in enumerate(km.values())], F.col(dcol).alias("__pv"))
        .distinct()
        .withColumn("__hitv", F.lit(True))
    )
    # both joins keep the base's rows: count them once for both hot-key checks
    rows = base.count() if isinstance(skew, str) and skew == "auto" else None
    j1 = key_join(base, groups, [(lc, f"__g{i}") for i, lc in enumerate(lon)], "left",
                  resolve(skew, base, lon, rows))
    j1 = j1.select(*[F.col(f"a.{c}").alias(c) for c in base.columns], F.col("m.__anynull").alias("__anynull"))
    # j1 holds exactly the base rows, so the base's key columns tell its hot keys
    pkeys = [*lon, col]
    j2 = key_join(j1, pairs, [(lc, f"__p{i}") for i, lc in enumerate(lon)] + [(col, "__pv")], "left",
                  resolve(skew, base, pkeys, rows))
    anynull, hitv = F.col("a.__anynull"), F.col("m.__hitv")
    keep = anynull.isNull() | (F.col(f"a.{col}").isNotNull() & ~anynull & hitv.isNull())
    return j2.where(keep).select(*[F.col(f"a.{c}").alias(c) for c in base.columns])
