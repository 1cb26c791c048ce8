"""Every stage on the edge cases and on empty input; the stages' decisions hold."""

import sys

import pytest

import corpus_pipeline as c
from loadwright.llm.common import components, materialise, ordered_sums
from pyspark.sql import functions as F


@pytest.mark.parametrize("step", range(len(c.STAGES)))
def test_stage_alone(spark, edge_dir, empty_dir, step):
    _, stage = c.STAGES[step]
    for folder in (edge_dir, empty_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        out = materialise(stage(spark, docs, folder), "test")
        if step < len(c.STAGES) - 1:
            assert out.columns == docs.columns
        if folder == empty_dir:
            assert out.count() == 0


def test_run(spark):
    folder = "/root/testdata/sf0.001"
    out = c.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert {*docs.columns, "shard", "slot"} == set(out.columns)
    assert out.join(docs, ["doc_id", "text"], "left_anti").count() == 0
    # Toxic, contaminated and duplicate documents are gone.
    from loadwright.llm.op5_decontaminate import op5_decontaminate
    from loadwright.llm.op9_jaccard import jaccard_join

    bad = op5_decontaminate(spark, folder).where("contaminated").select("doc_id")
    assert out.join(bad, "doc_id").count() == 0
    once = out.dropDuplicates(["doc_id"])
    assert jaccard_join(once.select("doc_id", "text")).where("n_links > 0").count() == 0
    assert out.groupBy("text").agg(F.count_distinct("shard").alias("n")).where("n > 1").count() == 0


def test_stages_do_not_import_by_accident():
    assert len(c.STAGES) in (4, 5) and "loadwright.llm" in sys.modules


def test_ordered_sums_with_ties(spark):
    df = spark.createDataFrame([("a" if i % 3 else None, i % 4, 1 + i % 5) for i in range(200)], "g string, o int, v long")
    out = ordered_sums(df, [F.col("g"), F.col("o")], {"before": "v"}, ["g"], "test").collect()
    for g in ("a", None):
        got = sorted((r["before"], r["v"]) for r in out if r["g"] == g)
        total = 0
        for before, v in got:
            assert before == total
            total += v


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70), (5, 5)], "a long, b long")
    got = {r["node"]: r["comp"] for r in components(edges, "test").collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[100] == got[70] == got[50] == 50
