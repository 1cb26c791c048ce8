"""Loads cut off midway: a replayed batch is applied once, a failed write
leaves the old rows, and a replaced external table leaves no old files."""

import os

import pytest
from pyspark.sql import functions as F

from loadwright.functions.types import ddl_schema
from loadwright.plans.apply import Batch, run_load
from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import swaps
from loadwright.sources import tables as S
from loadwright.sources.stage import write_stage
from loadwright.streaming.stage_files import start_stage_load
from tests.conftest import rows

SCHEMA = ddl_schema({"k": "INTEGER", "v": "INTEGER", "p": "INTEGER"})
DDL = "k int, v int, p int"
BASE = [(1, 10, 1), (2, 20, 2)]
STAGE = [(1, 5, 1), (3, 30, 1), (None, 7, 1)]
SUMS = {"pattern": "summarize", "keys": ["k"], "sets": {"v": "a.v + m.v"}}
SUMMED = [(1, 15, 1), (2, 20, 2), (3, 30, 1), (None, 7, 1)]

CASES = {
    "accumulate": (SUMS, SUMMED, False),
    "accumulate_partitions": (dict(SUMS, partition="p"), SUMMED, True),
    "upsert_null_keys": ({"pattern": "upsert", "keys": ["k"]}, [(1, 5, 1), (2, 20, 2), (3, 30, 1), (None, 7, 1)], False),
    "insert": ({"pattern": "insert", "cols": ["k", "v", "p"]}, BASE + STAGE, False),
    "update_partitions": ({"pattern": "update", "where": "p = 1", "sets": {"v": lambda: F.col("v") + 1}, "partition": "p"}, [(1, 11, 1), (2, 20, 2)], True),
}


def _sorted(values):
    return sorted(values, key=repr)


@pytest.mark.parametrize("case", sorted(CASES))
def test_batch_cut_after_the_load_is_not_applied_again(spark, monkeypatch, case):
    spec, expected, folder = CASES[case]
    if spec.get("sets"):
        spec = dict(spec, sets={c: e() if callable(e) else e for c, e in spec["sets"].items()})
    base = spark.createDataFrame(BASE, DDL)
    if folder:
        target = scratch_path(spark, "replay_target")
        S.append_partitioned(base, target, "p")
    else:
        target = scratch_table_name("replay")
        S.write_table(base, target, location=scratch_path(spark, target))
    stage_dir, ckpt = scratch_path(spark, "replay_stage"), scratch_path(spark, "replay_ckpt")
    write_stage(spark.createDataFrame(STAGE, DDL), stage_dir, mode="append")

    def cut(self, spark):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(Batch, "applied", cut)
        q = start_stage_load(spark, stage_dir, SCHEMA, target, spec, checkpoint_location=ckpt)
        with pytest.raises(Exception, match="driver lost"):
            q.awaitTermination(120)
    q = start_stage_load(spark, stage_dir, SCHEMA, target, spec, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert q.exception() is None
    if not folder:
        spark.catalog.refreshTable(target)
    got = S.scan_base(spark, target).select("k", "v", "p").collect()
    assert _sorted(tuple(r) for r in got) == _sorted(expected)


def test_failed_overwrite_leaves_the_folder(spark):
    path = scratch_path(spark, "kept")
    S.overwrite(spark.range(3), path)
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        S.overwrite(bad, path)
    assert rows(S.scan_base(spark, path)) == [(0,), (1,), (2,)]
    # the new rows may come from the folder itself
    S.overwrite(S.scan_base(spark, path).where("id > 0"), path)
    assert rows(S.scan_base(spark, path)) == [(1,), (2,)]


def test_external_table_stays_external_without_old_files(spark):
    name, home = scratch_table_name("ext"), scratch_path(spark, "ext")
    S.write_table(spark.createDataFrame([(1, 1)], "k int, v int"), name, location=home)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner.team' = 'it''s')")
    stage = spark.createDataFrame([(1, 2), (2, 3)], "k int, v int")
    for _ in range(2):
        out = run_load(name, stage, {"pattern": "upsert", "keys": ["k"]})
    assert rows(out) == [(1, 2), (2, 3)]
    parent = os.path.dirname(home).removeprefix("file:")
    versions = [d for d in os.listdir(parent) if d.startswith(os.path.basename(home))]
    now = S.external_location(spark, name)
    assert now and versions == [os.path.basename(now)]
    assert S.table_properties(spark, name)["owner.team"] in ("it's", "its")


def test_emptied_catalog_partitions_are_dropped(spark):
    name = scratch_table_name("emptied")
    df = spark.range(40).select(F.col("id").alias("v"), (F.col("id") % 4).cast("int").alias("p"))
    S.write_table(df, name, partition_by=["p"], location=scratch_path(spark, name))
    out = run_load(name, None, {"pattern": "delete", "where": "p < 2 OR v = 2"})
    assert out.count() == 19
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"p=2", "p=3"}


class Cut(Exception):
    pass


def _cut_at(monkeypatch, owner, name, call):
    """Let ``owner.name`` run ``call`` times, then lose the driver."""
    real, left = getattr(owner, name), [call]

    def cut(*args, **kw):
        if not left[0]:
            raise Cut(name)
        left[0] -= 1
        return real(*args, **kw)

    monkeypatch.setattr(owner, name, cut)


def _stored_target(spark, kind):
    base = spark.createDataFrame(BASE, DDL)
    if kind == "folder":
        target = scratch_path(spark, "once")
        S.write_table(base, target)
    elif kind == "partitioned_folder":
        target = scratch_path(spark, "once_p")
        S.append_partitioned(base, target, "p")
    else:
        target = scratch_table_name(f"once_{kind}")
        layout = {"partitioned_table": {"partition_by": ["p"]}, "bucketed_table": {"buckets": 2, "bucket_by": ["k"]}}.get(kind, {})
        S.write_table(base, target, location=scratch_path(spark, target), **layout)
    return target


KINDS = ["folder", "partitioned_folder", "table", "partitioned_table", "bucketed_table"]
CUTS = [(swaps, "move_files", 0), (swaps, "move_file", 1), (S, "_add_partitions", 0), (Batch, "note", 0)]


@pytest.mark.parametrize("kind", KINDS)
def test_append_cut_at_each_step_beside_a_second_writer(spark, monkeypatch, kind):
    target = _stored_target(spark, kind)
    staged = [(3, 30, 1), (4, 40, 3), (5, 50, None), (6, 60, 4)]
    stage = spark.createDataFrame(staged, DDL).repartition(2, "k")
    spec = {"pattern": "insert", "cols": ["k", "v", "p"]}
    expected = list(BASE)
    for number, (owner, name, call) in enumerate(CUTS):
        if name == "_add_partitions" and kind != "partitioned_table":
            continue
        batch = Batch("s", number, scratch_path(spark, "once_marks"))
        with monkeypatch.context() as m:
            _cut_at(m, owner, name, call)
            with pytest.raises(Cut):
                run_load(target, stage, spec, batch=batch)
        # another writer's rows, as many as the batch's, before the replay
        other = [(100 + number, i, 2) for i in range(len(staged))]
        S.append(spark.createDataFrame(other, DDL), target)
        for _ in range(2):
            out = run_load(target, stage, spec, batch=batch)
        expected += staged + other
        assert _sorted(tuple(r) for r in out.select("k", "v", "p").collect()) == _sorted(expected), name
    if kind == "partitioned_table":
        shown = {r[0] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()}
        assert shown == {"p=1", "p=2", "p=3", "p=4", "p=__HIVE_DEFAULT_PARTITION__"}
    if kind == "bucketed_table":
        plan = spark.table(target).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 2 out of 2" in plan
    home = target if "/" in target else S.external_location(spark, target)
    names = [f for _, _, fs in os.walk(home.removeprefix("file:")) for f in fs]
    assert any(f.startswith("batch-s-0-part-") for f in names) and "_complete" not in names


def test_appended_rows_take_the_tables_types(spark):
    target = scratch_table_name("once_types")
    S.write_table(spark.createDataFrame([(1, "a")], "k long, p string"), target, partition_by=["p"], location=scratch_path(spark, target))
    stage = spark.createDataFrame([(2, "x/y 1%"), (3, "it's")], "k int, q string")
    Batch("t", 0, scratch_path(spark, "once_marks")).append(stage, target, "orc", None)
    assert rows(spark.table(target)) == [(1, "a"), (2, "x/y 1%"), (3, "it's")]
