"""Shared helpers of the training-data operators.

Row identities, global order and connected components are all computed from
tables written once to the shared scratch folder (``spark.checkpoint.dir``),
so a lost executor or a different number of cores cannot change them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadwright.session import scratch_path

# Rows of one Arrow batch given to Python. Documents can be long; 1,000 of
# them stay within a few tens of MB.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of text handed to Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back.

    Cuts the lineage and pins whatever is not repeatable across plans
    (row numbers, partition numbers).
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_unit(*cols: Column) -> Column:
    """A uniform number in (0, 1), fixed by the given values.

    52 bits of an md5, so DuckDB computes the same double.
    """
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def ordered_sums(
    df: DataFrame, order: list[Column], values: dict[str, str], group: list[str], name: str
) -> DataFrame:
    """Running sums in a total order, without a window over a whole group.

    ``values`` maps an output column to the (long) column it sums; the sum is
    exclusive, over the earlier rows of the same ``group``.  ``order`` must
    start with the group columns.  Rows are range-partitioned on the order
    plus a row number, so ties and repeated rows spread over tasks too; the
    partitions are written once, then each one's totals (one row per
    partition and group in it) give the later ones their start.
    """
    ranged = (
        df.withColumn("__row", F.monotonically_increasing_id())
        .withColumn("__ord", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("__row")))
        .repartitionByRange(F.col("__ord"))
        .withColumn("__part", F.spark_partition_id())
    )
    ranged = materialise(ranged, name)
    keys = ["__part", *group]
    totals = ranged.groupBy(*keys).agg(*[F.sum(v).alias(f"__t_{k}") for k, v in values.items()])
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    if not group:
        before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__s_{k}") for k in values],
    )
    inside = Window.partitionBy(*keys).orderBy("__ord").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"__i_{k}") for k, v in values.items()]
    )
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return (
        summed.join(starts, on)
        .withColumns({k: F.col(f"__i_{k}") + F.col(f"__s_{k}") for k in values})
        .drop("__row", "__ord", "__part")
        .drop(*[f"__k_{k}" for k in keys], *[f"__{x}_{k}" for k in values for x in "is"])
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components: ``node``, ``comp`` (its least node) of the nodes in edges.

    ``edges`` has long columns ``a`` and ``b``.  Each round takes the least
    label among a node's neighbours, then jumps to that label's own label, so
    the rounds grow with the logarithm of the longest path.  Every round is
    written to the shared folder; joins read plain tables, so AQE can split a
    node with very many edges.
    """
    edges = edges.where("a <> b")
    both = materialise(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-edges",
    )
    labels = materialise(
        both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).select(F.col("a").alias("node"), "comp"),
        f"{name}-labels",
    )
    while True:
        # Least label of the neighbours, then the label of that label.
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "comp")
        least = near.union(labels).groupBy("node").agg(F.min("comp").alias("low"))
        jump = labels.select(F.col("node").alias("j"), F.col("comp").alias("jc"))
        new = materialise(
            least.join(jump, F.col("low") == F.col("j"), "left")
            .select("node", F.least("low", F.coalesce("jc", "low")).alias("comp")),
            f"{name}-labels",
        )
        moved = new.join(labels.withColumnRenamed("comp", "old"), "node").where("comp <> old").limit(1).count()
        labels = new
        if not moved:
            return labels
