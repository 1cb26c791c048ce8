"""Faults found by probing in ordinary use: each stays mended."""

import pytest

from loadwright.functions.types import ddl_schema
from loadwright.operators.dedup import global_sequence, with_sequence
from loadwright.operators.joins import unaffected
from loadwright.operators.skew import MIN_ROWS_CONF, ROWS_PER_TASK_CONF
from loadwright.plans.apply import apply_load, run_load
from loadwright.plans.loads import update_from, upsert, upsert_accumulate, upsert_partial
from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import tables as S
from loadwright.sources.stage import write_stage
from loadwright.streaming.stage_files import start_stage_load
from pyspark.sql import functions as F
from tests.conftest import rows


@pytest.fixture
def salted(spark):
    keys = {MIN_ROWS_CONF: "1", ROWS_PER_TASK_CONF: "500"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("pattern", ["history", "overwrite", "full_refresh"])
def test_stream_refuses_to_replace_the_table_per_batch(spark, pattern):
    schema = ddl_schema({"k": "INTEGER"})
    for how in ({"max_files_per_batch": 1}, {"processing_time": "1 second"}):
        with pytest.raises(ValueError, match="several batches"):
            start_stage_load(spark, "/tmp/none", schema, "t", {"pattern": pattern, "exprs": ["k"]}, **how)


def test_stream_history_loads_all_files(spark):
    stage_dir, name = scratch_path(spark, "drops_h"), scratch_table_name("stream_h")
    for k in range(3):
        write_stage(spark.createDataFrame([(k,)], "k int"), stage_dir, mode="append")
    spec = {"pattern": "history", "location": scratch_path(spark, "h")}
    q = start_stage_load(spark, stage_dir, ddl_schema({"k": "INTEGER"}), name, spec, checkpoint_location=scratch_path(spark, "h_ckpt"))
    q.awaitTermination(120)
    assert q.exception() is None and rows(spark.table(name)) == [(0,), (1,), (2,)]


def test_global_sequence_orders_by_some_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").repartition(6)
    out = global_sequence(df, ["l_shipdate", "l_orderkey"], "n").agg(F.max("n"), F.count_distinct("n"), F.count("*")).first()
    assert out[0] == out[1] == out[2]


def test_salted_sequence_and_null_keys(spark, salted):
    df = spark.range(8000).select(
        F.when(F.col("id") % 2 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("o"), F.lit("x").alias("v")
    )
    out = with_sequence(df, ["k"], ["o"])
    bad = out.groupBy("k").agg(F.max("row_num").alias("m"), F.count_distinct("row_num").alias("d"), F.count("*").alias("c")).where("m <> d OR d <> c")
    assert bad.count() == 0 and out.count() == 8000


def test_null_keys_are_spread(spark, salted):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        delta = spark.range(100).select(F.col("id").alias("k"))
        for out in (unaffected(base, delta, ["k"]), update_from(base, delta, ["k"], {"v": -1})):
            sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
            assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        assert unaffected(base, delta, ["k"]).count() == 20_000 - 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unused_spec_keys_are_refused(spark):
    base = spark.createDataFrame([(1, 1)], "k int, v int")
    for spec in (
        {"pattern": "update", "where": "k = 1", "sets": {"v": 2}, "keys": ["k"]},
        {"pattern": "upsert", "keys": ["k"], "sets": {"v": "a.v"}, "columns": ["v"]},
        {"pattern": "delete", "where": "k = 1", "on": ["k"]},
        {"pattern": "insert", "cols": ["k", "v"], "where": "k = 1"},
    ):
        with pytest.raises(ValueError):
            apply_load(base, base, spec)


@pytest.mark.parametrize("scope", ["partition", "table"])
def test_accumulate_and_partial_by_partition(spark, scope):
    base = spark.createDataFrame([(1, 10, "a", 1), (2, 20, "b", 1), (3, 30, "c", 2)], "k int, qty int, x string, p int")
    stage = spark.createDataFrame([(1, 5, "s", 1), (4, 7, "n", 1)], "k int, qty int, x string, p int")
    spec = {"pattern": "summarize", "keys": ["k"], "partition": "p", "scope": scope, "sets": {"qty": "a.qty + m.qty"}}
    assert rows(apply_load(base, stage, spec)) == [(1, 15, "s", 1), (2, 20, "b", 1), (4, 7, "n", 1)]
    spec = {"pattern": "upsert", "keys": ["k"], "partition": "p", "scope": scope, "columns": ["qty", "p"]}
    got = rows(apply_load(base, stage.drop("x"), spec))
    assert got == [(1, 5, "a", 1), (2, 20, "b", 1), (4, 7, None, 1)]


def test_base_types_are_kept(spark):
    base = spark.createDataFrame([(1, 10)], "k int, qty int")
    stage = spark.createDataFrame([(1, 5), (2, 6)], "k bigint, qty bigint")
    for out in (upsert(base, stage, ["k"]), upsert_partial(base, stage, ["k"], ["qty"]), upsert_accumulate(base, stage, ["k"], {"qty": "a.qty + m.qty"})):
        assert out.dtypes == base.dtypes and out.count() == 2


def test_insert_into_a_partitioned_folder(spark):
    path = scratch_path(spark, "parted")
    S.append_partitioned(spark.createDataFrame([(1, "a")], "v int, p string"), path, "p")
    more = spark.createDataFrame([(2, "b")], "v int, p string")
    out = run_load(path, more, {"pattern": "insert", "cols": ["v", "p"]})
    assert rows(out, "v", "p") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="partitioned by"):
        run_load(path, more, {"pattern": "insert", "cols": ["v", "p"], "partition": "v"})


def test_run_load_returns_the_live_table(spark):
    name = scratch_table_name("live")
    S.write_table(spark.createDataFrame([(1, 10)], "k int, qty int"), name, location=scratch_path(spark, name))
    stage = spark.createDataFrame([(1, 5), (2, 1)], "k int, qty int")
    spec = {"pattern": "summarize", "keys": ["k"], "sets": {"qty": "a.qty + m.qty"}, "location": scratch_path(spark, "live2")}
    assert rows(run_load(name, stage, spec)) == [(1, 15), (2, 1)]
