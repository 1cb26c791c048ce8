"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that stays together.  Groups go, largest
first, to the least loaded of the shards, kept in a heap (law ``bytes``).

The heap needs each group's size only.  Sizes are kept to ``BITS`` leading
bits, so there are at most 2^(BITS-1) * 52 distinct ones (about 107,000) at
any corpus size; only their counts reach the driver.  Groups of one size take
turns among the shards the heap has reached, in a fixed order; a shard above
the others (one with a hot group) joins when they have come up to it.  So a
size's result is at most one cycle per shard, found by division whatever the
number of groups (``turns``).  Each group then finds its shard from its rank
among the groups of its size.  Ranks and the rows' slots are running counts
over range partitions (``ordered_sums``): no task holds a whole size, group or
shard.

Cases: a null text has no bytes, size 16, crc32 0, and is equal to other null
texts only; empty texts are one group; repeated rows are equal texts; a group
larger than a fair share makes its shard larger, as it must stay whole; empty
input gives an empty result; other columns are carried in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, ordered_sums, table

SHARDS = 40
ROW_BYTES = 16
BITS = 12


def rounded(size: Column) -> Column:
    """A size cut to its leading BITS bits."""
    drop = F.greatest(F.length(F.bin(size)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def turns(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, list[int]]]:
    """For (size, number of groups), runs (size, start, stop, cycle) of ranks:
    rank r goes to cycle[(r - start) % len(cycle)].

    A heap of (load, shard) pops load + k * size of all shards in order.  With
    load = level * size + rest that order is by level + k, then rest, then
    shard: a round of each level, of the shards that start at it or below.
    """
    loads = [0] * shards
    out = []
    for size, n in sorted(sizes, reverse=True):
        order = sorted(range(shards), key=lambda s: (loads[s] % size, s))
        level = [load // size for load in loads]
        joins = sorted(set(level))
        start = 0
        for now, after in zip(joins, [*joins[1:], None], strict=True):
            if start == n:
                break
            cycle = [s for s in order if level[s] <= now]
            count = n - start if after is None else min(n - start, (after - now) * len(cycle))
            full, extra = divmod(count, len(cycle))
            for i, s in enumerate(cycle):
                loads[s] += size * (full + (i < extra))
            out.append((size, start, start + count, cycle[:count]))
            start += count
    return out


def lpt(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """``turns`` written out rank by rank, to be read beside a plain heap: (size, shards by rank, a cycle)."""
    ranks: dict[int, list[int]] = {}
    for size, start, stop, cycle in turns(sizes, shards):
        ranks.setdefault(size, []).extend(cycle[(r - start) % len(cycle)] for r in range(start, stop))
    return [(size, first, list(range(shards))) for size, first in ranks.items()]


def assign_shards(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows (rid, doc_id, size, same, ...) plus shard and slot."""
    one = F.lit(1).cast("long")
    groups = materialise(
        rows.groupBy("same").agg(F.sum("size").alias("bytes")).withColumn("class", rounded(F.col("bytes"))), "groups"
    )
    counted = [(r["class"], r["n"]) for r in groups.groupBy("class").agg(F.count("*").alias("n")).collect()]
    # At most a cycle per shard and size, whatever the corpus.
    plan = rows.sparkSession.createDataFrame(turns(counted, shards), "of long, start long, stop long, cycle array<int>")
    ranked = ordered_sums(
        groups.withColumn("one", one), [F.col("class"), F.col("same")], {"rank": "one"}, ["class"], "ranks"
    )
    run = (F.col("class") == F.col("of")) & (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("stop"))
    shard = F.get("cycle", ((F.col("rank") - F.col("start")) % F.size("cycle")).cast("int"))
    placed = ranked.join(F.broadcast(plan), run).select("same", shard.alias("shard"))
    placed = materialise(placed, "shards")
    out = rows.join(placed, "same").withColumn("one", one)
    return ordered_sums(out, [F.col("shard"), F.col("same"), F.col("doc_id")], {"slot": "one"}, ["shard"], "slots").drop("one", "same")


def sized(docs: DataFrame, *more: Column) -> DataFrame:
    """rid, doc_id, size, text_crc32 and an md5 of the text, written once."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return materialise(
        docs.select(
            F.monotonically_increasing_id().alias("rid"), "doc_id",
            (F.octet_length(F.coalesce("text", F.lit(""))) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(data).cast("long").alias("text_crc32"),
            F.coalesce(F.md5("text"), F.lit("")).alias("same"), *more,
        ),
        "documents",
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` plus columns ``shard`` and ``slot`` (in place of its own, if any)."""
    rows = sized(docs, F.struct("*").alias("doc"))
    placed = assign_shards(rows.drop("doc"), shards).select("rid", "shard", "slot")
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    return rows.select("rid", "doc").join(placed, "rid").select(
        *[F.col("doc").getField(c).alias(c) for c in own], "shard", "slot"
    )


def op10_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sized(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return assign_shards(rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op10_lpt_shards": op10_lpt_shards}
ORACLES: dict[str, str] = {}
