"""Targets by hand, closeness to them, and the order of the keys."""

from collections import defaultdict

from pyspark.sql import functions as F

from loadwright.llm import op8_mixing as m


def shares(sizes):
    """Water-filling by definition; sizes in code point order."""
    w = [m.WEIGHTS[i % 3] for i in range(len(sizes))]
    capped = [False] * len(sizes)
    while True:
        left = sum(sizes) - sum(3 * s for s, c in zip(sizes, capped, strict=True) if c)
        rate = left / max(1, sum(x for x, c in zip(w, capped, strict=True) if not c))
        new = [c or rate * x > 3 * s for c, x, s in zip(capped, w, sizes, strict=True)]
        if new == capped:
            return [3 * s if c else rate * x for c, x, s in zip(capped, w, sizes, strict=True)]
        capped = new


def test_targets(spark):
    rows = spark.createDataFrame([("a", 1000), ("b", 5), ("c", 40), ("Z", 3), (None, 0), ("é", 900)], "source string, size long")
    got = {r["source"]: r["target"] for r in m.source_targets(rows).collect()}
    order = ["Z", "a", "b", "c", "é", None]
    sizes = {r["source"]: r["size"] for r in rows.collect()}
    assert [round(got[s], 6) for s in order] == [round(x, 6) for x in shares([sizes[s] for s in order])]


def test_taken_near_target_and_at_most_three_times(spark):
    out = m.op8_source_mix(spark, "/root/testdata/sf0.01").collect()
    taken, target = defaultdict(int), {}
    for r in out:
        source = r["source_size"], r["target"]
        taken[source] += r["taken"]
        target[source] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 50 for s in target)


def test_better_documents_come_first_more_often(spark):
    text = F.when(F.col("id") % 2 == 0, "plain words and no more").otherwise("bad $$$ ### words &&& here ***")
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("s").alias("source"))
    rows = m.keyed(docs)
    first = rows.orderBy("key").limit(500).where("doc_id % 2 = 0").count()
    assert first > 350


def test_mix_repeats_documents(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    mixed = m.mix(docs)
    assert mixed.columns == docs.columns
    words = mixed.select(F.sum(m.n_words(F.col("text")))).first()[0]
    taken = m.op8_source_mix(spark, edge_dir).agg(F.sum("taken")).first()[0]
    assert words == taken
