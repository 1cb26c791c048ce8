"""Arrival order and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadwright.functions.columns import as_col, as_expr
from loadwright.operators.skew import resolve
from loadwright.session import checkpointed

SEQ_COL = "row_num"


def _order_cols(order_by: Sequence[str | Column] | None) -> list[Column]:
    if not order_by:
        # No arrival column was given: the scan position stands in for it.
        # It follows file and line order of a file scan and is stable when a
        # lost task re-reads the same split, but it is not a business order.
        return [F.monotonically_increasing_id()]
    return [as_col(c) for c in order_by]


def _placed(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Rows in ``order_by`` order over range partitions, checkpointed, with the
    partition (``__pid``) and the position in it (``__pos``, from 0)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [as_col(c) for c in order_by] + [F.col("__tie")]
    pid = F.spark_partition_id()
    return checkpointed(
        df.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("__pid", pid)
        .withColumn("__pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    )


def global_sequence(df: DataFrame, order_by: Sequence[str | Column], name: str = SEQ_COL) -> DataFrame:
    """Dense 1..n in ``order_by`` order, without moving all rows to one task.

    Rows are range-partitioned and sorted on the order columns; each row's
    number is its position in its partition plus the row count of all earlier
    partitions.  The counts table has one row per partition, so the window
    over it and its broadcast are bounded by the partition count.  The sorted
    partitions are checkpointed before they are counted: two plans over them
    would each sample range bounds of their own, and count other partitions
    than the rows come in.

    Rows tied on every order column are numbered by input position (the
    last sort and range column), so ties follow file order and a group of
    ties or exact copies, however large, is split across range partitions
    like any other rows.  The input position is stable when a lost task
    re-reads the same split.
    """
    s = _placed(df, order_by)
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"))
    out = s.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, F.col("__off") + F.col("__pos") + 1).drop("__pid", "__pos", "__off", "__tie")


def with_sequence(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str | Column] | None = None,
    name: str = SEQ_COL,
    skew="auto",
) -> DataFrame:
    """Arrival number, 1 for the earliest row.

    With ``keys`` the number restarts per key: a window per key for ordinary
    keys.  The rows of hot keys (``skew="auto"`` samples for them) are range-partitioned
    over (key, order) as in ``global_sequence`` instead and numbered from their
    key's rows in the partitions before; rows with a NULL key go with them, so a
    key holding a large share of the rows is spread over many tasks.  Without keys and order, the scan position
    (``monotonically_increasing_id``: unique and increasing, not dense) is
    used; without keys but with an order, ``global_sequence``.
    """
    if not keys:
        if order_by:
            return global_sequence(df, order_by, name)
        return df.withColumn(name, F.monotonically_increasing_id() + 1)
    order = _order_cols(order_by)
    w = Window.partitionBy(*keys).orderBy(*[c.asc() for c in order])
    hot = resolve(skew, df, list(keys))
    if hot is None:
        return df.withColumn(name, F.row_number().over(w).cast("long"))
    h = F.broadcast(hot.select(*[F.col(f"__h{i}").alias(k) for i, k in enumerate(keys)]))
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    cold = df.where(~unkeyed).join(h, list(keys), "left_anti")
    warm = df.where(~unkeyed).join(h, list(keys), "left_semi").select(*df.columns).unionByName(df.where(unkeyed))
    s = _placed(warm, [*keys, *order])
    # A key's rows lie together: its first position in a partition, and its rows
    # in the partitions before, number them.  One row per key and partition, and
    # the join on both, so no task gets more of a key than one partition holds.
    names = [f"__f{i}" for i in range(len(keys))]
    starts = s.groupBy(F.col("__pid").alias("__p"), *[F.col(k).alias(f) for k, f in zip(keys, names)]).agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    before = Window.partitionBy(*names).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f)) for k, f in zip(keys, names)])
    warm_out = s.join(starts, (F.col("__pid") == F.col("__p")) & same).withColumn(
        name, F.col("__before") + F.col("__pos") - F.col("__first") + 1
    ).select(*df.columns, name)
    cold_out = cold.withColumn(name, F.row_number().over(w).cast("long"))
    return cold_out.unionByName(warm_out)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """A1: the latest row of each key (``MAX(row_num)`` per key).

    ``order_by`` lists arrival columns, latest = greatest; list enough of
    them to make the order total, or ties are broken arbitrarily.  NULL keys
    form one group, as in ``GROUP BY``.

    Planned as ``row_number() = 1`` over the key window, which Spark runs as a
    window group limit on both sides of the shuffle: each map task keeps only
    its own best row per key before the exchange, so a key holding a large
    share of the rows reaches the final task as one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in _order_cols(order_by)])
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def select_distinct(df: DataFrame, exprs: Sequence[str | Column]) -> DataFrame:
    """A2: ``SELECT DISTINCT exprs``.  Partial aggregation removes copies
    before the shuffle, so a heavily repeated row costs one row per task."""
    return df.select(*[as_expr(e) for e in exprs]).distinct()


def distinct_table(df: DataFrame) -> DataFrame:
    """A3: ``SELECT DISTINCT *``."""
    return df.distinct()


def distinct_keys(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """A4: distinct key / partition values."""
    return df.select(*[as_col(c) for c in cols]).distinct()
