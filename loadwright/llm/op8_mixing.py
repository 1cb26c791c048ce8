"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources, in code point order (null last), weigh 1, 2, 3, repeating, and share
the size of the whole corpus; a target stops at ``MAX_EPOCHS`` times its
source's size and the excess is shared again by weight.  A source's complete
epochs are taken first.  The rest of its budget goes to documents in the order
of their exponential keys ``-ln(u) / quality``: u is a hash of the doc_id, and
the quality weight falls with the text's symbols, so better documents come
first more often.  Running sums over the key order cut at the budget; what is
left is filled by the largest document that fits, ``FILLS`` times, so a source
comes close to its target even if the document at the cut is long.

The running sums come from a range partitioning (``ordered_sums``), so a
source with a third of all rows is spread over many tasks; only one row per
source takes part in setting the targets.

Cases: a null or empty text has size 0 and takes 0 words; a null source is a
source of its own; sources without words have target 0; repeated rows are
separate documents, told apart by an internal row number; ties in the key go
by doc_id (nulls first); empty input gives an empty result; other columns are
carried in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_unit, materialise, ordered_sums, table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SYMBOL_COST = 4
FILLS = 3  # documents a source that fill what the cut leaves of its budget
SYMBOLS = "#*$%&|<>"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """1 for plain text, less with every symbol."""
    symbols = F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), F.lit(0))
    words = size.cast("double") + F.lit(1.0)
    return words / (words + symbols.cast("double") * F.lit(float(SYMBOL_COST)))


def source_targets(rows: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, epochs, budget."""
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = ordered_sums(
        per.withColumn("one", F.lit(1).cast("long")), [F.col("source").isNull(), F.col("source")], {"place": "one"}, [], "sources"
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    per = materialise(per.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    total, shares = per.agg(F.sum("source_size"), F.sum("weight")).first()
    left, shares = total or 0, shares or 1
    while True:
        # Sources whose share is above their limit take the limit; the rest share anew.
        rate = left / shares if shares else 0.0
        above = F.col("weight") * F.lit(float(rate)) > F.col("source_size") * max_epochs
        capped, rest = per.agg(
            F.sum(F.when(above, F.col("source_size") * max_epochs).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if (total or 0) - (capped or 0) == left and (rest or 0) == shares:
            break
        left, shares = (total or 0) - (capped or 0), rest or 0
        if not shares:
            break
    limit = (F.col("source_size") * max_epochs).cast("double")
    target = F.least(F.col("weight") * F.lit(float(rate)), limit)
    per = per.withColumn("target", target)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return per.withColumn("epochs", epochs).withColumn(
        "budget", F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double")
    )


def copies(rows: DataFrame) -> DataFrame:
    """Rows (rid, doc_id, source, size, key) plus their source's source_size and
    target and how often each is taken (``copies``)."""
    targets = materialise(source_targets(rows), "targets")
    sums = ordered_sums(
        rows, [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("doc_id")], {"before": "size"}, ["source"], "keys"
    )
    t = targets.withColumnRenamed("source", "t_source")
    placed = sums.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    placed = materialise(placed.withColumn("whole", F.col("before") + F.col("size") <= F.col("budget")), "placed")
    # What the whole documents leave of the budget, filled by the largest that fits, again and again.
    gaps = placed.groupBy("source").agg(
        (F.first("budget") - F.sum(F.when(F.col("whole"), F.col("size")).otherwise(0)).cast("double")).alias("gap")
    )
    gaps = materialise(gaps.withColumnRenamed("source", "g_source"), "gaps")
    rest = placed.where("NOT whole AND size > 0").select("rid", "doc_id", "source", "size", "key")
    chosen = None
    for _ in range(FILLS):
        free = rest if chosen is None else rest.join(chosen.select("rid"), "rid", "left_anti")
        fits = free.join(gaps, F.col("source").eqNullSafe(F.col("g_source"))).where(F.col("size") <= F.col("gap"))
        best = fits.groupBy("source").agg(F.min(F.struct(F.col("gap") - F.col("size"), "key", "doc_id", "rid", "size")).alias("m"))
        best = materialise(best.select("source", F.col("m.rid").alias("rid"), F.col("m.size").alias("size")), "fill")
        chosen = best if chosen is None else chosen.union(best)
        used = best.select(F.col("source").alias("u_source"), F.col("size").alias("used"))
        gaps = materialise(
            gaps.join(used, F.col("g_source").eqNullSafe(F.col("u_source")), "left")
            .select("g_source", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")),
            "gaps",
        )
    chosen = chosen.select(F.col("rid").alias("chosen"))
    return placed.join(chosen, F.col("rid") == F.col("chosen"), "left").withColumn(
        "copies", F.col("epochs") + (F.col("whole") | F.col("chosen").isNotNull()).cast("long")
    ).select("rid", "doc_id", "source", "size", "source_size", "target", "copies")


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """rid, doc_id, source, size and key of every document, written once."""
    size = n_words(F.col("text"))
    key = -F.log(hash_unit(F.col("doc_id"))) / quality(F.col("text"), size)
    return materialise(
        docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", size.alias("size"), key.alias("key"), *more),
        "documents",
    )


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with each document as often as the mix takes it."""
    rows = keyed(docs, F.struct("*").alias("doc"))
    taken = copies(rows.drop("doc")).where("copies > 0").select("rid", "copies")
    out = rows.select("rid", "doc").join(taken, "rid")
    out = out.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return copies(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols
  FROM documents),
k AS (
  SELECT rid, doc_id, source, size,
    -ln((CAST(('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '\N'))[1:13]) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / ((size::DOUBLE + 1) / ((size::DOUBLE + 1) + symbols::DOUBLE * 4)) AS key
  FROM d),
s AS (
  SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1)),
-- The common rate: sources in the order of limit / weight, the first ones at their limit.
r AS (
  SELECT *, 3 * source_size / weight::DOUBLE AS lim,
    ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER w, 0))::BIGINT AS num,
    (SELECT sum(weight) FROM s)::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT AS den
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (SELECT arg_min(num::DOUBLE / den, lim) AS rate FROM r WHERE num::DOUBLE / den <= lim),
t AS (
  SELECT source, source_size, least(weight * rate, 3 * source_size::DOUBLE) AS target FROM s, rate),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (
  SELECT k.*, e.source_size, e.target, e.epochs, e.target - (e.epochs * e.source_size)::DOUBLE AS budget,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, rid) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
g0 AS (
  SELECT source, any_value(budget) - sum(CASE WHEN upto <= budget THEN size ELSE 0 END)::DOUBLE AS gap FROM p GROUP BY 1),
r0 AS (SELECT rid, doc_id, source, size, key FROM p WHERE upto > budget AND size > 0),
""" + "".join(
    f"""
c{n} AS (SELECT * FROM (
  SELECT r{n}.*, row_number() OVER (PARTITION BY r{n}.source ORDER BY gap - size, key, doc_id NULLS FIRST, rid) AS n
  FROM r{n} JOIN g{n} ON r{n}.source IS NOT DISTINCT FROM g{n}.source WHERE size <= gap) WHERE n = 1),
g{n + 1} AS (SELECT g{n}.source, gap - coalesce(c{n}.size, 0) AS gap FROM g{n} LEFT JOIN c{n} ON g{n}.source IS NOT DISTINCT FROM c{n}.source),
r{n + 1} AS (SELECT * FROM r{n} WHERE rid NOT IN (SELECT rid FROM c{n})),"""
    for n in range(FILLS)
) + f"""
c AS ({' UNION ALL '.join(f'SELECT rid AS chosen FROM c{n}' for n in range(FILLS))})
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN upto <= budget OR chosen IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p LEFT JOIN c ON rid = chosen
"""

QUERIES = {"op8_source_mix": op8_source_mix}
ORACLES = {"op8_source_mix": ORACLE}
