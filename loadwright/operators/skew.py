"""Hot keys and salted key joins.

A load may meet a key that holds a large share of the base (a default key, a
dummy customer, one busy store).  A shuffle join sends all rows of a key to
one task.  Spark's adaptive skew-join rule splits such a partition only when
both join inputs are plain shuffles; here one side is always a
de-duplication window or a distinct-key aggregate, so the rule does not
apply.  The hot keys are therefore salted explicitly:

1. ``hot_keys`` samples the key columns of the side whose rows are kept and
   keeps the keys whose estimated row count exceeds the per-task target.  On
   a table so large that more than ``MAX_HOT_KEYS`` keys could reach that
   target, the threshold rises to ``rows / MAX_HOT_KEYS``, and if sampling
   noise still lets more keys through, the largest ``MAX_HOT_KEYS`` are kept
   (the others take the plain join, which is exact too).  So the set has a
   proven size bound at any table size; it is written once to the checkpoint
   folder.  Each hot key gets a bucket count: its estimated rows / rows per
   task, or / an average shuffle partition's rows if that is more, so that a
   bucket is no larger than the other partitions and two in one task do no harm.
2. ``key_join`` spreads the rows of a hot key over its buckets by a hash of
   the whole row and its input split, and repeats the other side's rows of that key once per
   bucket (that side holds about one row per key: staged rows after
   de-duplication, or distinct keys).  Both sides find their hot keys through
   a broadcast join with the small hot-key set, which needs no shuffle.  The
   join is then on (key, bucket).

Rows whose key has a NULL part match nothing; the salted join spreads them by
the same hash, and is used for them alone too when they are many.

Which rows match is unchanged: a row and its partner always share key and
bucket.  Tables below ``spark.loadwright.skew.minRows`` rows are not sampled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.session import checkpointed

MIN_ROWS_CONF = "spark.loadwright.skew.minRows"
ROWS_PER_TASK_CONF = "spark.loadwright.skew.rowsPerTask"
DEFAULT_MIN_ROWS = 10_000_000
DEFAULT_ROWS_PER_TASK = 5_000_000
# Bound on the hot-key set (one row of key columns and a bucket count per
# key: a few MB at most, safe to broadcast).  A key is hot above
# max(rowsPerTask, rows / MAX_HOT_KEYS); at most MAX_HOT_KEYS keys can hold
# that many rows.
MAX_HOT_KEYS = 100_000
MAX_BUCKETS = 100_000
# Rows sampled to estimate key sizes.  The sample is taken and grouped by the
# executors; at 10^12 rows a key at the threshold (10^7 rows) is seen ~100
# times.
SAMPLE_ROWS = 10_000_000
SAMPLE_SEED = 17


def hot_keys(df: DataFrame, cols: Sequence[str], rows: int | None = None) -> DataFrame | None:
    """Hot keys of ``df`` as ``__h0..`` plus a bucket count ``__n``; None if none.

    ``rows`` is ``df``'s row count when the caller already knows it.
    """
    spark = df.sparkSession
    min_rows = int(spark.conf.get(MIN_ROWS_CONF, str(DEFAULT_MIN_ROWS)))
    per_task = max(1, int(spark.conf.get(ROWS_PER_TASK_CONF, str(DEFAULT_ROWS_PER_TASK))))
    n = df.count() if rows is None else rows
    if n == 0 or n < min_rows:
        return None
    fraction = min(1.0, SAMPLE_ROWS / n)
    hot_rows = max(per_task, n / MAX_HOT_KEYS)
    bucket_rows = max(1, min(per_task, n // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    renamed = [F.col(c).alias(f"__h{i}") for i, c in enumerate(cols)]
    sampled = df.select(*renamed)
    if fraction < 1.0:
        sampled = sampled.sample(fraction, seed=SAMPLE_SEED)
    est = F.col("count") / F.lit(fraction)
    hot = (
        sampled.where(reduce(lambda a, b: a & b, [F.col(f"__h{i}").isNotNull() for i in range(len(cols))]))
        .groupBy(*[f"__h{i}" for i in range(len(cols))])
        .count()
        .where(est >= F.lit(hot_rows))
        .select(
            *[f"__h{i}" for i in range(len(cols))],
            F.least(F.ceil(est / F.lit(bucket_rows)), F.lit(MAX_BUCKETS)).cast("int").alias("__n"),
        )
    )
    hot = checkpointed(hot)
    k = hot.count()
    if k == 0:
        # NULL keys match nothing, but one task would gather them: above the
        # threshold an empty set makes key_join spread them.
        unkeyed = sampled.where(reduce(lambda a, b: a | b, [F.col(f"__h{i}").isNull() for i in range(len(cols))]))
        return hot if unkeyed.count() / fraction >= hot_rows else None
    if k > MAX_HOT_KEYS:
        # sampling noise: keep the largest keys; the rest join unsalted
        hot = checkpointed(hot.orderBy(F.desc("__n")).limit(MAX_HOT_KEYS))
    return hot


def resolve(skew, df: DataFrame, cols: Sequence[str], rows: int | None = None) -> DataFrame | None:
    """``skew``: ``"auto"`` (sample ``df``), a hot-key frame, or None/False."""
    if skew is None or skew is False:
        return None
    if isinstance(skew, DataFrame):
        return skew
    if skew == "auto":
        return hot_keys(df, cols, rows)
    raise ValueError(f"skew must be 'auto', a hot-key frame or None, not {skew!r}")


# Join types for which repeating a right row per bucket changes no result:
# unmatched right rows are never emitted.
_SALTABLE = {"inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"}


def _cond(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [a == b for a, b in pairs])


def key_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str,
    hot: DataFrame | None = None,
    left_alias: str = "a",
    right_alias: str = "m",
) -> DataFrame:
    """``left`` (alias ``a``) joined to ``right`` (alias ``m``) on
    ``a.l = m.r`` for each ``(l, r)`` in ``pairs``.

    With ``hot`` (from ``hot_keys`` over ``left``'s key columns, in ``pairs``
    order) the hot keys are salted; otherwise a plain join.  Callers select
    ``a.col`` / ``m.col``; the salt columns ``__salt`` / ``__rsalt`` are extra.
    """
    la, ra = left_alias, right_alias
    if hot is not None and how not in _SALTABLE:
        raise ValueError(f"key_join: a salted {how} join would repeat unmatched right rows")
    if hot is None:
        cond = _cond([(F.col(f"{la}.{l}"), F.col(f"{ra}.{r}")) for l, r in pairs])
        return left.alias(la).join(right.alias(ra), cond, how)

    h = F.broadcast(hot)
    lj = left.join(h, _cond([(left[l], h[f"__h{i}"]) for i, (l, _) in enumerate(pairs)]), "left")
    # Hash of the row and its input split: rows that are exact copies still
    # spread, by split; both are stable when a lost task is recomputed.
    row_hash = F.xxhash64(*[left[c] for c in left.columns], F.spark_partition_id())
    # Rows with a NULL key find no partner wherever they are: spread them.
    unkeyed = reduce(lambda a, b: a | b, [left[l].isNull() for l, _ in pairs])
    salt = (
        F.when(h["__n"].isNotNull(), F.pmod(row_hash, h["__n"])).when(unkeyed, F.pmod(row_hash, F.lit(MAX_BUCKETS)))
        .otherwise(F.lit(0)).cast("int")
    )
    ls = lj.select(*[left[c] for c in left.columns], salt.alias("__salt"))

    g = F.broadcast(hot.select(*[F.col(f"__h{i}").alias(f"__g{i}") for i in range(len(pairs))], F.col("__n").alias("__gn")))
    rj = right.join(g, _cond([(right[r], g[f"__g{i}"]) for i, (_, r) in enumerate(pairs)]), "left")
    buckets = F.when(g["__gn"].isNotNull(), F.sequence(F.lit(0), g["__gn"] - 1)).otherwise(F.array(F.lit(0)))
    rs = rj.select(*[right[c] for c in right.columns], F.explode(buckets).alias("__rsalt"))

    cond = _cond(
        [(F.col(f"{la}.{l}"), F.col(f"{ra}.{r}")) for l, r in pairs]
        + [(F.col(f"{la}.__salt"), F.col(f"{ra}.__rsalt"))]
    )
    return ls.alias(la).join(rs.alias(ra), cond, how)
