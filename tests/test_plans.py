"""Physical-plan properties that matter at scale, checked on the smallest tables.

Correctness is covered by ``test_oracle``; these tests pin down *how* the
plans run: no Python evaluation and no nested-loop or cartesian joins in any
registered query, filters and column pruning reaching the scan, map-side
reduction before every de-duplication shuffle, map-only updates and deletes,
and partition pruning in the partitioned upsert.
"""

from __future__ import annotations

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from loadwright import queries as Q
from loadwright.operators import joins as J
from loadwright.plans import loads as L
from loadwright.session import scratch_path
from loadwright.sources import tables as S

SF = "/root/testdata/sf0.001"

# Plan nodes that leave the JVM or pair rows without an equi-join key.
FORBIDDEN = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "PythonUDF",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def operators(text: str) -> list[str]:
    """Node names of a plan string, top-down."""
    return [m.group(1) for m in re.finditer(r"(?:^|\n)[ :+\-|*()0-9]*?([A-Z][A-Za-z]+)", text)]


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_python_or_cross_join(spark, name):
    text = plan(Q.QUERIES[name](spark, SF))
    bad = [f for f in FORBIDDEN if f in text]
    assert not bad, f"{name}: {bad}\n{text}"


def test_library_has_no_udfs_or_local_checkpoints():
    root = pathlib.Path(__file__).resolve().parents[1] / "loadwright"
    for path in root.rglob("*.py"):
        src = path.read_text()
        # the training-data operators may use Arrow functions
        own = () if "llm" in path.parts else ("udf(", "pandas_udf", "toPandas(")
        for word in ("localCheckpoint", ".rdd", *own):
            assert word not in src, f"{path.name} uses {word}"


def test_upsert_pushes_filters_and_prunes_key_scan(spark):
    text = plan(Q.q_upsert(spark, SF))
    # the base's and the stage's date filters reach the parquet reader
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in text
    assert "GreaterThanOrEqual(o_orderdate" in text
    # the staged key set is read with the key and the filter column only
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    # de-duplication: partial window group limit below the exchange
    assert "WindowGroupLimit [o_orderkey" in text and "row_number(), 1, Partial" in text


def test_upsert_base_not_shuffled_when_stage_keys_broadcast(spark):
    text = plan(Q.q_upsert(spark, SF))
    ops = operators(text)
    # only the stage moves: one exchange for the de-duplication window and one
    # for the distinct staged keys; the base scan feeds a broadcast anti join
    assert ops.count("Exchange") == 2, text
    assert "LeftAnti, BuildRight" in text


@pytest.mark.parametrize("name", ["latest_per_key", "upsert_dedup", "latest_per_hot_key"])
def test_dedup_reduces_before_shuffle(spark, name):
    text = plan(Q.QUERIES[name](spark, SF))
    partial = text.find("row_number(), 1, Partial")
    exchange = text.find("Exchange hashpartitioning")
    assert partial > exchange > 0, text  # partial limit sits under (after, in text) the exchange


def test_distinct_combines_map_side(spark):
    text = plan(Q.q_select_distinct(spark, SF))
    # HashAggregate above and below the exchange: partial, then final
    ops = operators(text)
    i = ops.index("Exchange")
    assert "HashAggregate" in ops[:i] and "HashAggregate" in ops[i + 1:], text


@pytest.mark.parametrize("name", ["update_where", "delete_where", "where_all", "exclude", "conform"])
def test_row_local_patterns_do_not_shuffle(spark, name):
    text = plan(Q.QUERIES[name](spark, SF))
    assert "Exchange" not in text, text


def test_not_in_is_equi_joined(spark):
    text = plan(Q.q_not_in_null_aware(spark, SF))
    # the correlated NOT IN is planned as equi-joins on aggregates, never as
    # the null-aware nested-loop join a literal NOT IN subquery gets
    assert "BroadcastNestedLoopJoin" not in text
    assert "HashJoin" in text or "SortMergeJoin" in text


def test_partitioned_upsert_prunes_untouched_partitions(spark):
    path = scratch_path(spark, "prune")
    S.write_table(Q.orders_by_year(spark, SF), path, partition_by=["o_year"])
    base = S.scan_base(spark, path)
    st = Q.partition_stage(spark, SF)
    text = plan(J.affected_partitions(base, st, "o_year"))
    assert re.search(r"PartitionFilters: \[[^\]]*o_year#\d+ IN \(1996,1997\)", text), text
    # every read of the base in the rebuilt partitions is pruned the same way
    text = plan(L.upsert_partitioned(base, st, ["o_orderkey"], "o_year", skew=None))
    scans = [line for line in text.splitlines() if "FileScan orc" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*IN \(1996,1997\)", s) for s in scans), text


def test_salted_join_spreads_hot_key(spark):
    spark.conf.set("spark.loadwright.skew.minRows", "0")
    spark.conf.set("spark.loadwright.skew.rowsPerTask", "100")
    try:
        text = plan(Q.q_upsert_hot_key(spark, SF))
    finally:
        spark.conf.unset("spark.loadwright.skew.minRows")
        spark.conf.unset("spark.loadwright.skew.rowsPerTask")
    # the join key carries the salt on both sides
    assert "__salt" in text and "__rsalt" in text, text


def test_update_from_keeps_base_rows_once(spark):
    base = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "k bigint, v double")
    st = spark.createDataFrame([(1,), (1,), (1,)], "k bigint")
    # a staged key repeated three times must not repeat base rows
    got = L.update_from(base, st, ["k"], {"v": 0.0}).groupBy("k").agg(F.count("*").alias("n"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2), (2, 1)]


def test_partitioned_update_finds_touched_partitions_by_pruning(spark):
    from loadwright.plans.apply import _hit_rows

    path = scratch_path(spark, "hits")
    S.write_table(Q.orders_by_year(spark, SF), path, partition_by=["o_year"])
    hits = _hit_rows(S.scan_base(spark, path), None, {"where": "o_orderstatus = 'P' AND o_year = 1997"})
    scan = next(line for line in plan(hits).splitlines() if "FileScan orc" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*o_year#\d+ = 1997", scan), scan
    assert "EqualTo(o_orderstatus,P)" in scan, scan


def test_append_distinct_reads_base_without_shuffling_it(spark):
    ev = Q.table(spark, SF, "events")
    base, st = ev.where(F.col("ts") < Q._ts("2024-01-20")), ev.where(F.col("ts") >= Q._ts("2024-01-15"))
    text = plan(L.distinct_new_rows(base, st))
    # the base is cut to rows sharing a hash with a staged row by a broadcast
    # semi join; only that remainder meets the all-column comparison
    assert re.search(r"BroadcastHashJoin \[xxhash64\([^\]]*\)\], \[__h#\d+L\], LeftSemi, BuildRight", text), text
    base_scan = next(i for i, line in enumerate(text.splitlines()) if "LessThan(ts," in line)
    above = text.splitlines()[base_scan - 2]
    assert "Exchange" not in above, text


def test_partitioned_upsert_runs_the_staged_window_once(spark):
    path = scratch_path(spark, "once")
    S.write_table(Q.orders_by_year(spark, SF), path, partition_by=["o_year"])
    base, st = S.scan_base(spark, path), Q.partition_stage(spark, SF)
    forms = [{}, {"sets": {"o_totalprice": "a.o_totalprice + m.o_totalprice"}}, {"columns": ["o_year", "o_totalprice"]}]
    for form in forms:
        # the window ran into a checkpoint; what is left joins its rows
        text = plan(L.upsert_partitioned(base, st, ["o_orderkey"], "o_year", skew=None, **form))
        assert "Window" not in text, text


@pytest.mark.parametrize("pattern", ["update", "delete"])
def test_partitioned_rewrite_samples_the_base_once(spark, monkeypatch, pattern):
    from loadwright.operators import skew
    from loadwright.plans.apply import run_load

    calls = []
    sample = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda *a: calls.append(a) or sample(*a))
    path = scratch_path(spark, f"sample-{pattern}")
    S.write_table(spark.createDataFrame([(1, 1, 1.0), (2, 2, 2.0), (3, 2, 3.0)], "k bigint, y int, v double"), path, partition_by=["y"])
    spec = {"pattern": pattern, "on": ["k"], "partition": "y"}
    if pattern == "update":
        spec["sets"] = {"v": 9.0}
    run_load(path, spark.createDataFrame([(2,)], "k bigint"), spec)
    assert len(calls) == 1
    left = [(1, 1, 1.0), (2, 2, 9.0), (3, 2, 3.0)] if pattern == "update" else [(1, 1, 1.0), (3, 2, 3.0)]
    assert sorted(tuple(r) for r in S.scan_base(spark, path).select("k", "y", "v").collect()) == left


def test_table_scope_samples_the_base_once(spark, monkeypatch):
    from loadwright.operators import skew

    calls = []
    sample = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda *a: calls.append(a) or sample(*a))
    base = spark.createDataFrame([(1, 1, 1.0), (2, 2, 2.0)], "k bigint, y int, v double")
    st = spark.createDataFrame([(2, 1, 5.0)], "k bigint, y int, v double")
    got = L.upsert_partitioned(base, st, ["k"], "y", order_by=["v"], scope="table")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 1.0), (2, 1, 5.0)]
    assert len(calls) == 1
