"""One pass over base and staged rows by key (the merge of L7 and L8, and J7).

Base and staged rows are stacked with a tag, moved once by (key, salt) and
sorted with the staged row first.  Running down a key, every base row sees the
staged row, and a staged row that is followed by no base row is new.  So the
base is read, shuffled and sorted once, where a join for the matched rows and
another for the new ones read it twice.

It suits a stage too large to broadcast.  A small one is better joined as a
broadcast side: the base is then not shuffled at all, and its keys alone are
read again (``fits_broadcast`` tells by Catalyst's size estimate).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadwright.operators.skew import MAX_BUCKETS


def fits_broadcast(df: DataFrame) -> bool:
    """Would Catalyst broadcast ``df`` by its size estimate (no job is run)?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def hash_placed(df: DataFrame) -> bool:
    """Do the rows come hash-partitioned already (a bucketed table)?"""
    return "HashPartitioning" in df._jdf.queryExecution().sparkPlan().outputPartitioning().getClass().getSimpleName()


def merged(base: DataFrame, delta: DataFrame, keys: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """Structs ``a`` (base row) and ``m`` (staged row): every base row with the
    staged row of its key, if any, and every staged row of a key the base lacks
    (``a`` is NULL).

    ``delta`` holds one row per key, in the base's key types.  A NULL key never
    matches; such rows come out unpaired and are spread by a hash.  ``hot``
    (from ``hot_keys`` over this base) salts the keys holding very many base
    rows; since the base holds them, no staged row of such a key is new.
    """
    names = [f"__k{i}" for i in range(len(keys))]

    def tagged(df: DataFrame, tag: int) -> DataFrame:
        row = F.struct(*[df[c] for c in df.columns]).alias("a" if tag else "m")
        return df.select(*[df[k].alias(n) for k, n in zip(keys, names)], row, *_tags(df, keys, tag))

    rows = _dealt(tagged(base, 1), tagged(delta, 0), names, hot)
    down = Window.partitionBy(*names, "__salt").orderBy("__tag")
    rows = rows.withColumns({
        "__m": F.first("m").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__next": F.lead("__tag").over(down),
    })
    new = F.col("__unkeyed") | (F.col("__n").isNull() & F.col("__next").isNull())
    staged = F.col("__tag") == 0
    return rows.where(~staged | new).select(
        "a", F.when(staged | ~F.col("__unkeyed"), F.when(staged, F.col("m")).otherwise(F.col("__m"))).alias("m")
    )


def _tags(df: DataFrame, keys: Sequence[str], tag: int) -> list[Column]:
    """Tag, NULL-key flag and a spreading hash of each row."""
    unkeyed = reduce(lambda x, y: x | y, [df[k].isNull() for k in keys])
    spread = F.pmod(F.xxhash64(*[df[c] for c in df.columns], F.spark_partition_id()), F.lit(MAX_BUCKETS)).cast("int")
    return [F.lit(tag).alias("__tag"), unkeyed.alias("__unkeyed"), spread.alias("__spread")]


def _dealt(left: DataFrame, right: DataFrame, names: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Both sides stacked, with ``__salt``: base rows of a hot key (``__n``
    buckets) and rows of a NULL key are spread, staged rows of a hot key are
    repeated once a bucket."""
    def with_buckets(df: DataFrame) -> DataFrame:
        if hot is None:
            return df.withColumn("__n", F.lit(None).cast("int"))
        h = F.broadcast(hot.select(*[F.col(f"__h{i}") for i in range(len(names))], F.col("__n").cast("int").alias("__n")))
        return df.join(h, reduce(lambda x, y: x & y, [df[n] == h[f"__h{i}"] for i, n in enumerate(names)]), "left").drop(
            *[f"__h{i}" for i in range(len(names))]
        )

    left, right = with_buckets(left), with_buckets(right)
    own = F.when(F.col("__unkeyed"), F.col("__spread")).otherwise(F.lit(0))
    left = left.withColumn("__salt", F.when(F.col("__n").isNotNull(), F.pmod(F.col("__spread"), F.col("__n"))).otherwise(own))
    buckets = F.when(F.col("__n").isNotNull(), F.sequence(F.lit(0), F.col("__n") - 1)).otherwise(F.array(own))
    return left.unionByName(right.withColumn("__salt", F.explode(buckets)), allowMissingColumns=True)


def not_in_rows(
    base: DataFrame, delta: DataFrame, col: str, on: Sequence[str], delta_col: str, delta_on: Sequence[str], hot: DataFrame | None = None
) -> DataFrame:
    """J7 in one pass: base rows meeting ``col NOT IN (SELECT delta_col FROM
    delta WHERE on = delta_on)``.

    The delta's distinct (on, value) pairs are stacked before the base rows of
    their group.  Going down a group tells whether it exists and holds a NULL,
    going down a value in it whether it is listed; the second order needs only
    a sort, as the rows lie together by group already.
    """
    names = [f"__k{i}" for i in range(len(on))]
    left = base.select(
        *[base[k].alias(n) for k, n in zip(on, names)], base[col].alias("__v"),
        F.struct(*[base[c] for c in base.columns]).alias("a"), *_tags(base, on, 1),
    )
    right = delta.select(*[delta[k].alias(n) for k, n in zip(delta_on, names)], delta[delta_col].alias("__v")).dropna("any", subset=names).distinct()
    right = right.select(*names, "__v", *_tags(right, names, 0))
    rows = _dealt(left, right, names, hot)
    listed = F.when(F.col("__tag") == 0, 1).otherwise(0)

    def down(*more: str):
        return Window.partitionBy(*names, "__salt", *more).orderBy("__tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    no_null = F.when((F.col("__tag") == 0) & F.col("__v").isNull(), 1).otherwise(0)
    rows = rows.withColumns({"__some": F.max(listed).over(down()), "__null": F.max(no_null).over(down())})
    rows = rows.withColumn("__hit", F.max(listed).over(down("__v")))
    keep = F.col("__unkeyed") | (F.col("__some") == 0) | (F.col("__v").isNotNull() & (F.col("__null") == 0) & (F.col("__hit") == 0))
    return rows.where((F.col("__tag") == 1) & keep).select("a.*")
