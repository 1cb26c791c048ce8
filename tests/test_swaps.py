"""Loads cut at every step of a swap, then run again."""

import pytest

from loadwright.plans.apply import run_load
from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import swaps
from loadwright.sources import tables as S

SPEC = {"pattern": "upsert", "keys": ["k"], "sets": {"v": "a.v + m.v"}}
OLD = [(1, 10), (2, 20)]
NEW = [(1, 10), (2, 21), (3, 1)]


class Cut(BaseException):
    """The driver is lost."""


def stage(spark):
    return spark.createDataFrame([(2, 1), (3, 1)], "k bigint, v bigint")


def old_table(spark, external):
    name = scratch_table_name("cut")
    location = scratch_path(spark, name) if external else None
    S.write_table(spark.createDataFrame(OLD, "k bigint, v bigint"), name, location=location)
    return name


def rows(spark, name):
    return sorted(map(tuple, S.scan_base(spark, name).collect()))


def side_tables(spark, name):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "_")]


def cut(monkeypatch, owner, step, before):
    own = getattr(owner, step)

    def stopped(*a, **k):
        if not before:
            own(*a, **k)
        raise Cut(step)

    monkeypatch.setattr(owner, step, stopped)


TABLE_STEPS = [(S, "write_table"), (S.TableSwap, "set_aside"), (S.TableSwap, "put_in_place"), (S.TableSwap, "finish"), (swaps, "drop_table")]


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("owner, step", TABLE_STEPS, ids=[s for _, s in TABLE_STEPS])
def test_table_after_a_cut(spark, monkeypatch, owner, step, before, external):
    name = old_table(spark, external)
    with monkeypatch.context() as m:
        cut(m, owner, step, before)
        with pytest.raises(Cut):
            run_load(name, stage(spark), SPEC)
    outcome = S.recover(spark, name)
    in_place = step in ("finish", "drop_table") or (step == "put_in_place" and not before)
    # nothing is open once the last step ended
    assert outcome == (None if (step, before) == ("finish", False) else "done" if in_place else "undone")
    assert rows(spark, name) == (NEW if in_place else OLD)
    assert side_tables(spark, name) == []
    assert S.recover(spark, name) is None
    if not in_place:
        run_load(name, stage(spark), SPEC)
        assert rows(spark, name) == NEW and side_tables(spark, name) == []


def test_replay_recovers_by_itself(spark, monkeypatch):
    name = old_table(spark, False)
    with monkeypatch.context() as m:
        cut(m, S.TableSwap, "set_aside", False)
        with pytest.raises(Cut):
            run_load(name, stage(spark), SPEC)
    assert not spark.catalog.tableExists(name)
    run_load(name, stage(spark), SPEC)
    assert rows(spark, name) == NEW and side_tables(spark, name) == []


def test_a_cut_first_load_leaves_nothing(spark, monkeypatch):
    name = scratch_table_name("first")
    df = spark.createDataFrame(OLD, "k bigint, v bigint")
    with monkeypatch.context() as m:
        cut(m, S.TableSwap, "set_aside", True)
        with pytest.raises(Cut):
            S.overwrite(df, name)
    assert S.recover(spark, name) == "undone" and side_tables(spark, name) == []
    S.overwrite(df, name)
    assert rows(spark, name) == OLD


def test_external_folders_in_use_are_kept(spark):
    name = old_table(spark, True)
    run_load(name, stage(spark), SPEC)
    run_load(name, stage(spark), SPEC)
    assert rows(spark, name) == [(1, 10), (2, 22), (3, 2)]
    here = S.external_location(spark, name)
    parent = here.rsplit("/", 1)[0]
    fs, path = swaps.filesystem(spark, parent)
    mine = [str(f.getPath().getName()) for f in fs.listStatus(path(parent)) if str(f.getPath().getName()).startswith(name)]
    assert mine == [here.rsplit("/", 1)[1]]


def test_a_folder_with_files_is_refused_as_the_new_place(spark):
    name = old_table(spark, True)
    taken = scratch_path(spark, "taken")
    spark.range(3).write.parquet(taken)
    with pytest.raises(ValueError, match="not empty"):
        S.swap_in(spark.createDataFrame(NEW, "k bigint, v bigint"), name, location=taken)
    assert S.recover(spark, name) is None
    assert spark.read.parquet(taken).count() == 3


@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("owner, step", [(S, "write_table"), (S.FolderSwap, "set_aside"), (S.FolderSwap, "put_in_place"),
                                         (S.FolderSwap, "finish"), (swaps, "delete_folder")], ids=lambda x: str(x)[-20:])
def test_folder_after_a_cut(spark, monkeypatch, owner, step, before):
    path = scratch_path(spark, "cut-folder")
    S.write_table(spark.createDataFrame(OLD, "k bigint, v bigint"), path)
    new = spark.createDataFrame(NEW, "k bigint, v bigint")
    with monkeypatch.context() as m:
        cut(m, owner, step, before)
        with pytest.raises(Cut):
            S.overwrite(new, path)
    in_place = step in ("finish", "delete_folder") or (step == "put_in_place" and not before)
    S.recover(spark, path)
    assert rows(spark, path) == (NEW if in_place else OLD)
    parent, name = path.rsplit("/", 1)
    fs, p = swaps.filesystem(spark, parent)
    assert [str(f.getPath().getName()) for f in fs.listStatus(p(parent)) if str(f.getPath().getName()).startswith(name)] == [name]
    S.overwrite(new, path)
    assert rows(spark, path) == NEW


def test_record_cut_while_it_is_replaced_is_still_read(spark):
    name = scratch_table_name("rec")
    record = swaps.Record(spark, name)
    record.write(kind="folder", new="x", old="y")
    record.fs.rename(record.path(record.file), record.path(record.file + ".part"))
    assert record.read() == {"kind": "folder", "new": "x", "old": "y"}
    out = record.fs.create(record.path(record.file + ".part"), True)
    out.write(b'{"kind": "fol')
    out.close()
    assert record.read() is None
    record.remove()
