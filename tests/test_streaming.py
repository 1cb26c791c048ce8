"""Stage-folder stream: each landed file is loaded once, in arrival batches."""

from loadwright.functions.types import ddl_schema
from loadwright.plans import loads as L
from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import tables as S
from loadwright.sources.stage import write_stage
from loadwright.streaming.stage_files import start_stage_load
from tests.conftest import rows

SCHEMA = ddl_schema({"k": "INTEGER", "v": "INTEGER", "x": "VARCHAR(5)"})


def _run(spark, stage_dir, name, spec, ckpt):
    q = start_stage_load(spark, stage_dir, SCHEMA, name, spec, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert q.exception() is None
    # batches run in a clone of the session; drop the caller's cached relation
    spark.catalog.refreshTable(name)


def test_stream_upsert_loads_each_drop_once(spark):
    base = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, v int, x string")
    name = scratch_table_name("stream_base")
    S.write_table(base, name, location=scratch_path(spark, name))
    stage_dir, ckpt = scratch_path(spark, "drops"), scratch_path(spark, "stream_ckpt")
    spec = {"pattern": "upsert", "keys": ["k"], "order_by": ["v"], "location": None}

    drop1 = spark.createDataFrame([(2, 21, "b1"), (3, 30, "c")], "k int, v int, x string")
    write_stage(drop1, stage_dir, mode="append")
    _run(spark, stage_dir, name, dict(spec, location=scratch_path(spark, "v1")), ckpt)
    after1 = L.upsert(base, drop1, ["k"], ["v"])
    assert rows(spark.table(name)) == rows(after1)

    drop2 = spark.createDataFrame([(3, 31, "c2"), (4, 40, "d")], "k int, v int, x string")
    write_stage(drop2, stage_dir, mode="append")
    _run(spark, stage_dir, name, dict(spec, location=scratch_path(spark, "v2")), ckpt)
    assert rows(spark.table(name)) == rows(L.upsert(after1, drop2, ["k"], ["v"]))


def test_stream_accumulate_skips_replayed_batches(spark):
    base = spark.createDataFrame([(1, 10, "a")], "k int, v int, x string")
    name = scratch_table_name("stream_acc")
    S.write_table(base, name, location=scratch_path(spark, name))
    stage_dir, ckpt = scratch_path(spark, "drops_acc"), scratch_path(spark, "acc_ckpt")
    write_stage(spark.createDataFrame([(1, 5, "s")], "k int, v int, x string"), stage_dir, mode="append")
    spec = {"pattern": "summarize", "keys": ["k"], "sets": {"v": "a.v + m.v"},
            "location": scratch_path(spark, "acc_v1")}
    _run(spark, stage_dir, name, spec, ckpt)
    assert rows(spark.table(name)) == [(1, 15, "s")]
    # same checkpoint, no new files: nothing is applied again
    _run(spark, stage_dir, name, dict(spec, location=scratch_path(spark, "acc_v2")), ckpt)
    assert rows(spark.table(name)) == [(1, 15, "s")]


def test_stream_backlog_in_bounded_batches(spark):
    # three files waiting: with one file per batch they load as three
    # batches, in arrival order, into one table location folder
    base = spark.createDataFrame([(1, 10, "a")], "k int, v int, x string")
    name = scratch_table_name("stream_backlog")
    S.write_table(base, name, location=scratch_path(spark, name))
    stage_dir, ckpt = scratch_path(spark, "backlog"), scratch_path(spark, "backlog_ckpt")
    drops = [[(1, 11, "a1"), (2, 20, "b")], [(2, 21, "b1")], [(3, 30, "c"), (1, 12, "a2")]]
    for d in drops:
        write_stage(spark.createDataFrame(d, "k int, v int, x string").coalesce(1), stage_dir, mode="append")
    spec = {"pattern": "upsert", "keys": ["k"], "order_by": ["v"], "location": scratch_path(spark, "backlog_v")}
    q = start_stage_load(spark, stage_dir, SCHEMA, name, spec, checkpoint_location=ckpt, max_files_per_batch=1)
    q.awaitTermination(180)
    assert q.exception() is None
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name)) == [(1, 12, "a2"), (2, 21, "b1"), (3, 30, "c")]
