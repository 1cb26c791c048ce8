"""Loads that rewrite only the files they touch."""

import os

import pytest
from pyspark.sql import functions as F

from loadwright.plans import apply as A
from loadwright.plans.apply import Batch, apply_load, run_load
from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import swaps
from loadwright.sources import tables as S

DDL = "k long, v long"
STAGE = [(3, 100), (4, 100), (900, 1), (None, 5)]
UPSERT = {"pattern": "upsert", "keys": ["k"], "order_by": ["v"]}
SPECS = {
    "upsert": (UPSERT, True),
    "accumulate": ({"pattern": "summarize", "keys": ["k"], "sets": {"v": "a.v + m.v"}, "order_by": ["v"]}, True),
    "partial": ({"pattern": "upsert", "keys": ["k"], "columns": ["v"], "order_by": ["v"]}, True),
    "mapped": (dict(UPSERT, exprs=["k + 1", "v"]), True),
    "not_in": (dict(UPSERT, not_in="v"), True),
    "update_from": ({"pattern": "update", "on": {"k": "k"}, "sets": {"v": 0}}, True),
    "update_where": ({"pattern": "update", "where": "k < 5", "sets": {"v": 0}}, False),
    "delete_from": ({"pattern": "delete", "on": {"k": "k"}}, True),
    "delete_where": ({"pattern": "delete", "where": "k < 10 OR k = 12"}, False),
    "delete_none": ({"pattern": "delete", "where": "k = -1"}, False),
    "delete_all": ({"pattern": "delete", "where": "k IS NULL OR k >= 0"}, False),
}


def base(spark):
    """100 keys and a NULL one, in 10 files of neighbouring keys."""
    known = spark.range(0, 100, 1, 10).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return known.union(spark.createDataFrame([(None, 7)], DDL).coalesce(1))


def stored(spark, kind):
    if kind == "folder":
        # a blank in the name
        target = scratch_path(spark, "touched a b")
        S.write_table(base(spark), target)
        return target
    target = scratch_table_name("touched")
    layout = {"buckets": 4, "bucket_by": ["k"]} if kind == "bucketed" else {}
    S.write_table(base(spark), target, location=scratch_path(spark, target), **layout)
    return target


def data_files(spark, target):
    home = S.table_home(spark, target).removeprefix("file:")
    return {f for f in os.listdir(home) if f.endswith(".orc") and not f.startswith(".")}


def values(df):
    return sorted((tuple(r) for r in df.select("k", "v").collect()), key=repr)


@pytest.mark.parametrize("kind", ["folder", "table"])
@pytest.mark.parametrize("case", sorted(SPECS))
def test_same_rows_as_the_whole_load(spark, case, kind):
    spec, staged = SPECS[case]
    stage = spark.createDataFrame(STAGE, DDL) if staged else None
    target = stored(spark, kind)
    before = data_files(spark, target)
    expected = values(apply_load(base(spark), stage, spec))
    out = run_load(target, stage, {**spec, "rewrite": "files"})
    assert values(out) == expected
    kept = before & data_files(spark, target)
    # the keys 3 and 4 lie in one file of ten, 0 to 12 in two
    gone = {"delete_where": 2, "delete_none": 0, "delete_all": len(before)}.get(case, 1)
    assert len(before) - len(kept) == gone
    assert not [d for d in os.listdir(S.table_home(spark, target).removeprefix("file:")) if d.startswith(swaps.ASIDE)]


def test_bucketed_table_stays_bucketed(spark):
    target = stored(spark, "bucketed")
    stage = spark.createDataFrame(STAGE, DDL)
    expected = values(apply_load(base(spark), stage, UPSERT))
    assert values(run_load(target, stage, {**UPSERT, "rewrite": "files"})) == expected
    grouped = spark.table(target).groupBy("k").count()
    assert "SelectedBucketsCount: 4 out of 4" in grouped._jdf.queryExecution().executedPlan().toString()
    assert grouped.where("k IS NOT NULL AND count > 1").count() == 0


class Cut(Exception):
    pass


STEPS = [(S, "write_table"), (swaps, "mark_complete"), (swaps, "move_file"), (swaps, "delete_file"), (swaps.Record, "remove"), (Batch, "note")]


@pytest.mark.parametrize("owner, step", STEPS, ids=[s for _, s in STEPS])
def test_batch_cut_at_each_step_is_applied_once(spark, monkeypatch, owner, step):
    spec = {**SPECS["accumulate"][0], "rewrite": "files"}
    stage = spark.createDataFrame(STAGE, DDL)
    for kind in ("folder", "table"):
        target = stored(spark, kind)
        expected = values(apply_load(base(spark), stage, SPECS["accumulate"][0]))
        batch = Batch("s", 7, scratch_path(spark, "touched_marks"))

        def cut(*a, **k):
            raise Cut(step)

        with monkeypatch.context() as m:
            # the record's own clean-up before the load is not the step meant
            if step == "remove":
                real = swaps.Record.remove
                m.setattr(owner, step, lambda self: cut() if self.read() else real(self))
            else:
                m.setattr(owner, step, cut)
            with pytest.raises(Cut):
                run_load(target, stage, spec, batch=batch)
        for _ in range(2):
            out = run_load(target, stage, spec, batch=batch)
            assert values(out) == expected


def test_beyond_the_limit_the_table_is_swapped(spark, monkeypatch):
    monkeypatch.setattr(A, "MAX_TOUCHED_FILES", 0)
    stage = spark.createDataFrame(STAGE, DDL)
    for kind in ("folder", "table"):
        target = stored(spark, kind)
        before = data_files(spark, target)
        out = run_load(target, stage, {**UPSERT, "rewrite": "files"})
        assert values(out) == values(apply_load(base(spark), stage, UPSERT))
        assert not before & data_files(spark, target)


def test_refused(spark):
    folder = scratch_path(spark, "touched_p")
    S.append_partitioned(spark.createDataFrame([(1, 1, 1)], "k long, v long, p int"), folder, "p")
    with pytest.raises(ValueError, match="unpartitioned"):
        run_load(folder, None, {"pattern": "delete", "where": "k = 1", "rewrite": "files"})
    with pytest.raises(ValueError, match="not both"):
        run_load(folder, None, {"pattern": "delete", "where": "k = 1", "rewrite": "files", "partition": "p"})
    with pytest.raises(ValueError, match="rewrite is"):
        run_load(folder, None, {"pattern": "delete", "where": "k = 1", "rewrite": "rows"})
