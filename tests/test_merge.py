"""The one-pass merge against the joins, its plan, and pruning by ranges."""

import re

import pytest
from pyspark.sql import functions as F

from loadwright import queries as Q
from loadwright.operators import joins as J
from loadwright.operators.skew import MIN_ROWS_CONF, ROWS_PER_TASK_CONF
from loadwright.plans import loads as L
from loadwright.plans.apply import run_load
from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import tables as S

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frames(spark):
    base = [(1, "a", 1, None), (1, "a", 2, "x"), (2, "b", 3, "y"), (None, "a", 4, "n"), (3, None, 5, None), (5, "e", 6, "z")]
    base += [(7, "hot", i, str(i)) for i in range(300)]
    stage = [(1, "a", 10, "s"), (2, "zz", 11, "s"), (None, "a", 12, "s"), (None, "a", 12, "s"), (3, None, 13, None), (7, "hot", 14, None), (9, "new", 15, "s")]
    schema = "k bigint, g string, v bigint, t string"
    return spark.createDataFrame(base, schema), spark.createDataFrame(stage, schema)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("per_task", [None, "20"])
@pytest.mark.parametrize("keys", [["k"], ["k", "g"]])
def test_same_rows_as_the_joins(spark, keys, per_task):
    base, stage = frames(spark)
    if per_task:
        spark.conf.set(MIN_ROWS_CONF, "0")
        spark.conf.set(ROWS_PER_TASK_CONF, per_task)
    try:
        sets = {"v": "a.v + m.v"}
        both = [L.upsert_accumulate(base, stage, keys, sets, ["v"], one_pass=p) for p in (True, False)]
        assert sorted_rows(both[0]) == sorted_rows(both[1])
        both = [L.upsert_partial(base, stage.select("k", "g", "v"), keys, ["v"], ["v"], one_pass=p) for p in (True, False)]
        assert sorted_rows(both[0]) == sorted_rows(both[1])
        if per_task:
            assert "__n" in plan(L.upsert_accumulate(base, stage, keys, sets, ["v"], one_pass=True))
    finally:
        spark.conf.unset(MIN_ROWS_CONF)
        spark.conf.unset(ROWS_PER_TASK_CONF)


def test_one_pass_reads_and_shuffles_the_base_once(spark):
    path = scratch_path(spark, "one-pass")
    S.write_table(Q.orders_base(spark, SF), path)
    base, st = S.scan_base(spark, path), Q.orders_stage(spark, SF)
    cheap = st.select("o_orderkey", "o_totalprice", "o_orderdate")
    for df in (
        L.upsert_accumulate(base, st, ["o_orderkey"], {"o_totalprice": "a.o_totalprice + m.o_totalprice"}, ["o_orderdate"], one_pass=True),
        L.upsert_partial(base, cheap, ["o_orderkey"], ["o_totalprice"], ["o_orderdate"], one_pass=True),
    ):
        text = plan(df)
        assert text.count("FileScan orc") == 1, text
        assert "Join" not in text, text


def test_a_large_stage_takes_one_pass_and_a_small_one_does_not_move_the_base(spark):
    path = scratch_path(spark, "by-size")
    S.write_table(Q.orders_base(spark, SF), path)
    base, st = S.scan_base(spark, path), Q.orders_stage(spark, SF)
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def scans():
        text = plan(L.upsert_accumulate(base, st, ["o_orderkey"], {"o_totalprice": "a.o_totalprice"}, ["o_orderdate"], skew=None))
        return text.count("FileScan orc"), text

    try:
        spark.conf.set(key, "1")
        assert scans()[0] == 1
        spark.conf.set(key, str(1 << 30))
        n, text = scans()
        assert n == 2 and "SortMergeJoin" not in text
    finally:
        spark.conf.set(key, before)


def test_a_wide_set_prunes_by_ranges(spark):
    path = scratch_path(spark, "wide")
    base = spark.range(60).select("id", (F.col("id") % 30 * 1000).cast("int").alias("p"))
    S.write_table(base, path, partition_by=["p"])
    # 20,001 touched values, all but NULL in 3000..22999: partitions 3000 to 22000
    touched = spark.range(20_000).select((F.col("id") + 3000).cast("int").alias("p")).union(spark.sql("SELECT CAST(NULL AS INT)"))
    got = J.affected_partitions(S.scan_base(spark, path), touched, "p")
    scan = next(line for line in plan(got).splitlines() if "FileScan orc" in line)
    assert re.search(r"PartitionFilters: \[.*p#\d+ >= 3000", scan), scan[:600]
    assert sorted({r["p"] for r in got.collect()}) == list(range(3000, 23000, 1000)) and got.count() == 40
    files = got.select(F.input_file_name()).distinct().count()
    assert files >= 20


def test_ranges_hold_all_values(spark):
    vals = spark.createDataFrame([(v,) for v in (5, 1, 9, 7, 3, None)], "__k0 int")
    assert J.value_ranges(vals, 6) == [(1, 1), (3, 3), (5, 5), (7, 7), (9, 9), (None, None)]
    old = J.PRUNE_RANGES
    J.PRUNE_RANGES = 2
    try:
        assert J.value_ranges(vals, 6) == [(1, 5), (7, 9), (None, None)]
    finally:
        J.PRUNE_RANGES = old
    df = spark.createDataFrame([(v,) for v in (1, 4, 6, 8, None)], "x int")
    assert [r[0] for r in df.where(J.in_ranges(F.col("x"), [(1, 5), (7, 9)])).collect()] == [1, 4, 8]
    assert df.where(J.in_ranges(F.col("x"), [(None, None)])).count() == 1
    assert df.where(J.in_ranges(F.col("x"), [])).count() == 0


def test_plain_upsert_of_a_partitioned_table_keeps_untouched_files(spark):
    name = scratch_table_name("by_part")
    rows = [(k, k % 10, float(k)) for k in range(100)]
    S.write_table(spark.createDataFrame(rows, "k bigint, v double, p int".replace("v double, p int", "p int, v double")).select("k", "v", "p"),
                  name, partition_by=["p"])

    def files():
        return {f.rsplit("/p=", 1)[1].split("/")[0]: f for f in spark.table(name).inputFiles()}

    before = files()
    stage = spark.createDataFrame([(13, -1.0, 4)], "k bigint, v double, p int")  # moves from partition 3 to 4
    run_load(name, stage, {"pattern": "upsert", "keys": ["k"]})
    after = files()
    assert {p for p in after if after[p] != before.get(p)} == {"3", "4"}
    got = {r["k"]: (r["v"], r["p"]) for r in spark.table(name).collect()}
    assert len(got) == 100 and spark.table(name).count() == 100 and got[13] == (-1.0, 4) and got[23] == (23.0, 3)
    # the documented scope can still be asked for: the old copy stays in its partition
    run_load(name, spark.createDataFrame([(23, -2.0, 5)], "k bigint, v double, p int"), {"pattern": "upsert", "keys": ["k"], "scope": "partition"})
    assert sorted((r["v"], r["p"]) for r in spark.table(name).where("k = 23").collect()) == [(-2.0, 5), (23.0, 3)]


def test_not_in_one_pass_is_three_valued_and_moves_the_base_once(spark):
    base = [(1, "x"), (1, None), (1, "y"), (2, "x"), (2, None), (None, "x"), (None, None), (4, "q")] + [(5, str(i)) for i in range(100)]
    delta = [(1, "x"), (1, "x"), (2, None), (2, "z"), (None, "x"), (5, "7"), (5, "x")]
    b = spark.createDataFrame(base, "g bigint, c string")
    d = spark.createDataFrame(delta, "h bigint, e string")

    def kept(g, c):
        found = [e for h, e in delta if h is not None and h == g]
        return not found or (c is not None and None not in found and c not in found)

    want = sorted([r for r in base if kept(*r)], key=str)
    for one_pass in (True, False):
        assert sorted_rows(J.not_in_null_aware(b, d, "c", {"g": "h"}, "e", one_pass=one_pass)) == want
    spark.conf.set(MIN_ROWS_CONF, "0")
    spark.conf.set(ROWS_PER_TASK_CONF, "10")
    try:
        assert sorted_rows(J.not_in_null_aware(b, d, "c", {"g": "h"}, "e", one_pass=True)) == want
    finally:
        spark.conf.unset(MIN_ROWS_CONF)
        spark.conf.unset(ROWS_PER_TASK_CONF)
    path = scratch_path(spark, "not-in")
    S.write_table(b, path)
    text = plan(J.not_in_null_aware(S.scan_base(spark, path), d, "c", {"g": "h"}, "e", skew=None, one_pass=True))
    assert text.count("FileScan orc") == 1 and "Join" not in text
    # one exchange for the stacked rows, one for the delta's distinct pairs
    assert text.count("Exchange hashpartitioning") == 2, text


def test_update_and_delete_map_equal_counts_only(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k bigint, v double")
    st = spark.createDataFrame([(2, 5)], "a bigint, b int")
    from loadwright.plans.apply import apply_load

    spec = {"pattern": "delete", "on": {"k": "x"}, "columns": ["x"], "exprs": ["a"]}
    assert sorted_rows(apply_load(base, st, spec)) == [(1, 1.0)]
    for columns, exprs in ((["x"], ["a", "b"]), (["x", "y"], ["a"])):
        with pytest.raises(ValueError, match="expressions"):
            apply_load(base, st, {**spec, "columns": columns, "exprs": exprs})
    with pytest.raises(ValueError, match="together"):
        apply_load(base, st, {"pattern": "update", "on": ["k"], "sets": {"v": 0.0}, "columns": ["k"]})


def test_partition_overwrites_at_once_leave_the_session_alone(spark):
    from concurrent.futures import ThreadPoolExecutor

    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    names = [scratch_table_name(f"at_once{i}") for i in range(3)]
    for name in names:
        S.write_table(spark.range(50).select("id", (F.col("id") % 5).alias("p")), name, partition_by=["p"])

    def load(name):
        S.overwrite_partitions(spark.table(name).where("p = 2").withColumn("id", F.col("id") + 1000), name, "p")
        return spark.conf.get(key)

    with ThreadPoolExecutor(3) as pool:
        assert set(pool.map(load, names)) == {before}
    for name in names:
        got = spark.table(name)
        assert got.count() == 50 and got.where("id >= 1000").count() == 10
    assert spark.conf.get(key) == before
