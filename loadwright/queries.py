"""Registered queries: every operator run on the test tables, with the
equivalent DuckDB SQL.

Base and staged sets are carved out of the tables by business attributes
(order date, ship date, event time, status), never by id ranges, so every
query covers the whole table and grows with it:

* orders: base = orders placed before 2000, stage = orders placed from 1999
  on with the total price raised by 100 (1999 keys are updates, 2000-2001
  keys are new);
* lineitem: base = lines shipped before 2000, stage = lines shipped from
  1999 on, quantity + 1; (l_orderkey, l_linenumber) repeats, so the stage
  needs de-duplication;
* events: base = events before 2024-01-20, stage = events from 2024-01-15.

Queries that exercise a sink write to a fresh folder under the session's
checkpoint folder and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.functions import columns as C
from loadwright.functions import dates as D
from loadwright.functions import types as TY
from loadwright.operators import dedup as A
from loadwright.operators import filters as FL
from loadwright.operators import joins as J
from loadwright.operators.setops import stack
from loadwright.operators.skew import MIN_ROWS_CONF, ROWS_PER_TASK_CONF
from loadwright.plans import loads as L
from loadwright.plans.apply import apply_load
from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import stage as ST
from loadwright.sources import tables as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# ------------------------------------------------------------------ inputs

ORDER_KEYS = ["o_orderkey"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def orders_base(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderdate") < _ts("2000-01-01"))


def orders_stage(spark, sf):
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderdate") >= _ts("1999-01-01"))
        .withColumn("o_totalprice", F.col("o_totalprice") + 100)
    )


def lines_base(spark, sf):
    return table(spark, sf, "lineitem").where(F.col("l_shipdate") < _ts("2000-01-01"))


def lines_stage(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .where(F.col("l_shipdate") >= _ts("1999-01-01"))
        .withColumn("l_quantity", F.col("l_quantity") + 1)
    )


# One key holds a third of all rows: every line with return flag 'A' shares
# hot_key = -1; the other lines keep their order key.
HOT_KEYS = ["hot_key"]
HOT_ORDER = LINE_ORDER + ["l_orderkey", "l_linenumber"]


def _with_hot_key(df):
    return df.withColumn(
        "hot_key", F.when(F.col("l_returnflag") == "A", F.lit(-1).cast("bigint")).otherwise(F.col("l_orderkey"))
    )


def hot_base(spark, sf):
    return _with_hot_key(lines_base(spark, sf))


def hot_stage(spark, sf):
    return _with_hot_key(lines_stage(spark, sf))


def orders_by_year(spark, sf):
    df = table(spark, sf, "orders")
    return df.withColumn("o_year", F.year("o_orderdate").cast("int"))


def partition_stage(spark, sf, move_to: int | None = None):
    """Open orders of 1996-1997 re-priced to 1.0, optionally re-filed under ``move_to``."""
    st = (
        orders_by_year(spark, sf)
        .where((F.col("o_year").isin(1996, 1997)) & (F.col("o_orderstatus") == "O"))
        .withColumn("o_totalprice", F.lit(1.0))
    )
    if move_to is not None:
        st = st.withColumn("o_year", F.lit(move_to))
    return st


def _write_partitioned_orders(spark, sf) -> str:
    path = scratch_path(spark, "orders_by_year")
    S.write_table(orders_by_year(spark, sf), path, partition_by=["o_year"])
    return path


# ------------------------------------------------------------------ dedup, windows


def q_latest_per_key(spark, sf):
    li = table(spark, sf, "lineitem")
    return A.latest_per_key(li, LINE_KEYS, LINE_ORDER)


def q_with_sequence(spark, sf):
    li = table(spark, sf, "lineitem")
    return A.with_sequence(li, LINE_KEYS, LINE_ORDER)


def q_with_sequence_hot_key(spark, sf):
    li = _with_hot_key(table(spark, sf, "lineitem"))
    return A.with_sequence(li, HOT_KEYS, HOT_ORDER)


@contextmanager
def _salting(spark):
    """Hot-key handling as on a huge table: every key counts as hot."""
    own = {MIN_ROWS_CONF: "1", ROWS_PER_TASK_CONF: "100"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def q_global_sequence(spark, sf):
    """Numbers in the order of one column; the others are payload."""
    return A.global_sequence(table(spark, sf, "orders"), ["o_orderkey"])


def q_with_sequence_hot_key_salted(spark, sf):
    with _salting(spark):
        return A.with_sequence(table(spark, sf, "orders"), ["o_orderpriority"], ["o_orderkey"])


def _half_null(df):
    """Finished orders lose their key."""
    return df.withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")))


def q_unaffected_null_keys(spark, sf):
    with _salting(spark):
        return J.unaffected(_half_null(orders_base(spark, sf)), orders_stage(spark, sf), ORDER_KEYS)


def q_update_from_null_keys(spark, sf):
    with _salting(spark):
        return L.update_from(_half_null(orders_base(spark, sf)), orders_stage(spark, sf), ORDER_KEYS, {"o_totalprice": 0.0})


def q_select_distinct(spark, sf):
    li = table(spark, sf, "lineitem")
    return A.select_distinct(
        li, ["l_returnflag", "l_linestatus", F.year("l_shipdate").cast("int").alias("ship_year")]
    )


def q_distinct_table(spark, sf):
    ev = table(spark, sf, "events")
    return A.distinct_table(
        stack(ev.where(F.col("ts") < _ts("2024-01-20")), ev.where(F.col("ts") >= _ts("2024-01-15")))
    )


def q_distinct_keys(spark, sf):
    return A.distinct_keys(table(spark, sf, "orders"), ["o_custkey"])


# ------------------------------------------------------------------ joins


def q_unaffected(spark, sf):
    return J.unaffected(orders_base(spark, sf), orders_stage(spark, sf), ORDER_KEYS)


def q_new_rows(spark, sf):
    return J.new_rows(orders_stage(spark, sf), orders_base(spark, sf), ORDER_KEYS)


def q_matched_rows(spark, sf):
    return J.matched_rows(orders_stage(spark, sf), orders_base(spark, sf), ORDER_KEYS)


def q_pair(spark, sf):
    j = J.pair(orders_stage(spark, sf), orders_base(spark, sf), ORDER_KEYS)
    return j.select(
        F.col("m.o_orderkey").alias("o_orderkey"),
        F.col("a.o_totalprice").alias("old_price"),
        F.col("m.o_totalprice").alias("new_price"),
    )


def q_affected_partitions(spark, sf):
    return J.affected_partitions(orders_by_year(spark, sf), partition_stage(spark, sf), "o_year")


def q_unaffected_in_partitions(spark, sf):
    return J.unaffected_in_partitions(
        orders_by_year(spark, sf), partition_stage(spark, sf), ORDER_KEYS, "o_year"
    )


def _finished_orders(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")


def q_matching(spark, sf):
    return J.matching(table(spark, sf, "lineitem"), _finished_orders(spark, sf), {"l_orderkey": "o_orderkey"})


def _nin_inputs(spark, sf):
    cust = table(spark, sf, "customer").withColumn("c_nationkey", F.expr("nullif(c_nationkey, 3)"))
    supp = table(spark, sf, "supplier").select(
        F.expr("nullif(s_nationkey, 5)").alias("s_nationkey"),
        F.expr(
            "case when s_nationkey < 10 then 'HOUSEHOLD' when s_nationkey < 20 "
            "then 'MACHINERY' else 'BUILDING' end"
        ).alias("s_segment"),
    )
    return cust, supp


def q_not_in_null_aware(spark, sf):
    cust, supp = _nin_inputs(spark, sf)
    return J.not_in_null_aware(cust, supp, "c_nationkey", {"c_mktsegment": "s_segment"}, "s_nationkey")


# ------------------------------------------------------------------ filters


def q_where_all(spark, sf):
    return FL.where_all(table(spark, sf, "lineitem"), [("l_returnflag", "=", "R"), ("l_linestatus", "<>", "F")])


def q_where_range(spark, sf):
    return FL.where_all(table(spark, sf, "lineitem"), [("l_returnflag", "=", "A"), ("l_quantity", "<", 10)])


def q_exclude(spark, sf):
    cust = table(spark, sf, "customer").withColumn("c_nationkey", F.expr("nullif(c_nationkey, 3)"))
    return FL.exclude(cust, [("c_nationkey", "<", 10)])


# ------------------------------------------------------------------ projections and scalar functions


def q_conform(spark, sf):
    cust = table(spark, sf, "customer")
    text = cust.select(*[F.col(c).cast("string").alias(c) for c in cust.columns], F.col("c_name").alias("name_as_int"))
    return TY.conform(
        text,
        {
            "c_custkey": "BIGINT",
            "c_name": "VARCHAR(25)",
            "c_nationkey": "BYTEINT",
            "c_acctbal": "DECIMAL(7,2)",
            "c_mktsegment": "CHAR(10)",
            "name_as_int": "INTEGER",
        },
    )


def q_conform_picture(spark, sf):
    part = table(spark, sf, "part")
    text = part.select(
        F.col("p_partkey"),
        F.col("p_retailprice").cast("string").alias("price_7_2"),
        F.col("p_retailprice").cast("string").alias("price_5_2"),
        F.col("p_size").cast("string").alias("size_int"),
        F.col("p_name").alias("name_x"),
    )
    return TY.conform_picture(
        text,
        {"price_7_2": "PIC S9(5)V99 COMP-3.", "price_5_2": "S9(3)V99", "size_int": "S9(4) COMP", "name_x": "X(20)"},
    )


def q_rename(spark, sf):
    part = table(spark, sf, "part").withColumnRenamed("p_partkey", "item_nbr")
    return C.rename(part)


def q_lower_names(spark, sf):
    part = table(spark, sf, "part")
    return C.lower_names(part.toDF(*[c.upper() for c in part.columns]))


def q_map_columns(spark, sf):
    cust = table(spark, sf, "customer")
    return C.map_columns(
        cust,
        ["cust_id", "cust_name", "nation", "balance"],
        ["c_custkey", "upper(c_name)", "c_nationkey", "c_acctbal * 2", "c_mktsegment"],
    )


def q_concat_cols(spark, sf):
    cust = table(spark, sf, "customer")
    return cust.select("c_custkey", C.concat_cols("c_mktsegment", F.lit("-"), "c_name").alias("seg_name"))


def q_substr_col(spark, sf):
    cust = table(spark, sf, "customer")
    return cust.select("c_custkey", C.substr_col("c_name", 10, 9).alias("name_no"))


def q_parse_date(spark, sf):
    orders = table(spark, sf, "orders")
    out = [F.col("o_orderkey")]
    for fmt, name in [
        ("yyyymmdd", "d_yyyymmdd"),
        ("yymmdd", "d_yymmdd"),
        ("yyyy-mm-dd", "d_iso"),
        ("yyyyddd", "d_yyyyddd"),
        ("mm/dd/yyyy", "d_us"),
        ("mm-dd-yyyy", "d_us_dash"),
    ]:
        text = F.date_format("o_orderdate", D.spark_date_pattern(fmt))
        out.append(D.parse_date(text, fmt).alias(name))
    return orders.select(*out)


def q_sentinel_date(spark, sf):
    orders = table(spark, sf, "orders")
    code = F.when(F.col("o_orderstatus") == "O", F.lit(D.END_OF_TIME_CODE)).otherwise(D.td_date_code("o_orderdate"))
    return orders.select("o_orderkey", D.sentinel_date(code).alias("end_dt"))


def q_set_literal(spark, sf):
    return C.set_literal(table(spark, sf, "customer"), "c_acctbal", 0)


def q_accumulate(spark, sf):
    j = J.pair(orders_stage(spark, sf), orders_base(spark, sf), ORDER_KEYS)
    return j.select(*C.accumulate_exprs(
        orders_base(spark, sf).columns, {"o_totalprice": "a.o_totalprice + m.o_totalprice"}
    ))


def q_fill_from_base(spark, sf):
    st = orders_stage(spark, sf).select("o_orderkey", "o_totalprice")
    return L.fill_from_base(st, orders_base(spark, sf), ORDER_KEYS)


# ------------------------------------------------------------------ load patterns


def q_upsert(spark, sf):
    return L.upsert(orders_base(spark, sf), orders_stage(spark, sf), ORDER_KEYS, ["o_orderdate"])


def q_upsert_dedup(spark, sf):
    return L.upsert(lines_base(spark, sf), lines_stage(spark, sf), LINE_KEYS, LINE_ORDER)


def q_latest_per_hot_key(spark, sf):
    return A.latest_per_key(_with_hot_key(table(spark, sf, "lineitem")), HOT_KEYS, HOT_ORDER)


def q_upsert_hot_key(spark, sf):
    return L.upsert(hot_base(spark, sf), hot_stage(spark, sf), HOT_KEYS, HOT_ORDER)


def q_upsert_accumulate_hot_key(spark, sf):
    return L.upsert_accumulate(
        hot_base(spark, sf), hot_stage(spark, sf), HOT_KEYS,
        {"l_quantity": "a.l_quantity + m.l_quantity"}, HOT_ORDER,
    )


def q_upsert_accumulate(spark, sf):
    return L.upsert_accumulate(
        orders_base(spark, sf), orders_stage(spark, sf), ORDER_KEYS,
        {"o_totalprice": "a.o_totalprice + m.o_totalprice"}, ["o_orderdate"],
    )


def q_upsert_partial(spark, sf):
    st = orders_stage(spark, sf).select("o_orderkey", "o_totalprice", "o_orderdate")
    return L.upsert_partial(orders_base(spark, sf), st, ORDER_KEYS, ["o_totalprice"], ["o_orderdate"])


def _partitioned_load(spark, sf, move_to, scope):
    path = _write_partitioned_orders(spark, sf)
    base = S.scan_base(spark, path)
    rebuilt = L.upsert_partitioned(base, partition_stage(spark, sf, move_to), ORDER_KEYS, "o_year", scope=scope)
    S.overwrite_partitions(rebuilt, path, "o_year")
    return S.scan_base(spark, path)


def q_upsert_partitioned(spark, sf):
    return _partitioned_load(spark, sf, None, "partition")


def q_upsert_partition_move(spark, sf):
    return _partitioned_load(spark, sf, 1999, "partition")


def q_upsert_partitioned_table(spark, sf):
    return _partitioned_load(spark, sf, 1999, "table")


def q_update_where(spark, sf):
    return L.update_where(
        table(spark, sf, "lineitem"), [("l_returnflag", "=", "R"), ("l_linestatus", "<>", "F")], {"l_discount": 0}
    )


def q_update_from(spark, sf):
    return L.update_from(table(spark, sf, "lineitem"), _finished_orders(spark, sf), {"l_orderkey": "o_orderkey"}, {"l_tax": 0})


def q_delete_where(spark, sf):
    return L.delete_where(table(spark, sf, "lineitem"), [("l_returnflag", "=", "A"), ("l_quantity", "<", 10)])


def q_delete_from(spark, sf):
    return L.delete_from(table(spark, sf, "lineitem"), _finished_orders(spark, sf), {"l_orderkey": "o_orderkey"})


def q_append_distinct(spark, sf):
    ev = table(spark, sf, "events")
    return L.append_distinct(ev.where(F.col("ts") < _ts("2024-01-20")), ev.where(F.col("ts") >= _ts("2024-01-15")))


def q_append_distinct_incremental(spark, sf):
    """L4 into a distinct base: only new distinct rows are appended."""
    from loadwright.plans.apply import run_load

    ev = table(spark, sf, "events")
    path = scratch_path(spark, "events_base")
    S.write_table(ev.where(F.col("ts") < _ts("2024-01-20")).distinct(), path)
    run_load(path, ev.where(F.col("ts") >= _ts("2024-01-15")), {"pattern": "distinct", "base_distinct": True})
    return S.scan_base(spark, path)


def _refresh_exprs():
    return [
        F.col("c_mktsegment"),
        C.substr_col("c_name", 1, 8).alias("name8"),
        C.concat_cols("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("seg_nation"),
        D.sentinel_date(F.when(F.col("c_nationkey") == 3, F.lit(D.END_OF_TIME_CODE))).alias("end_dt"),
    ]


def q_full_refresh(spark, sf):
    return L.full_refresh(table(spark, sf, "customer"), _refresh_exprs())


def q_insert_select(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return L.insert_select(base, table(spark, sf, "supplier"), ["s_suppkey", "s_name"])


def q_stack(spark, sf):
    b, s = orders_base(spark, sf), orders_stage(spark, sf)
    return stack(J.unaffected(b, s, ORDER_KEYS), J.new_rows(s, b, ORDER_KEYS), J.matched_rows(s, b, ORDER_KEYS))


def q_apply_load(spark, sf):
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "order_by": ["o_orderdate"]}
    return apply_load(orders_base(spark, sf), orders_stage(spark, sf), spec)


def q_run_load_upsert(spark, sf):
    """L14 end to end: the upsert is applied to a catalog table and swapped in."""
    from loadwright.plans.apply import run_load

    name = scratch_table_name("orders_load")
    S.write_table(orders_base(spark, sf), name, location=scratch_path(spark, name))
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "order_by": ["o_orderdate"],
            "location": scratch_path(spark, name + "_v2")}
    run_load(name, orders_stage(spark, sf), spec)
    return spark.table(name)


def q_upsert_accumulate_one_pass(spark, sf):
    """L8 by one pass over base and stage, as for a stage too large to broadcast."""
    return L.upsert_accumulate(
        hot_base(spark, sf), hot_stage(spark, sf), HOT_KEYS,
        {"l_quantity": "a.l_quantity + m.l_quantity"}, HOT_ORDER, one_pass=True,
    )


def q_upsert_partial_one_pass(spark, sf):
    st = orders_stage(spark, sf).select("o_orderkey", "o_totalprice", "o_orderdate")
    return L.upsert_partial(orders_base(spark, sf), st, ORDER_KEYS, ["o_totalprice"], ["o_orderdate"], one_pass=True)


def q_not_in_one_pass(spark, sf):
    """J7 in one pass, as for a stage too large to broadcast."""
    cust, supp = _nin_inputs(spark, sf)
    return J.not_in_null_aware(cust, supp, "c_nationkey", {"c_mktsegment": "s_segment"}, "s_nationkey", one_pass=True)


def q_upsert_not_in(spark, sf):
    """L6 with the null-aware test (J7): base rows of a staged order stay only
    if their status is known and differs from the staged one."""
    base = orders_base(spark, sf).withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "order_by": ["o_orderdate"], "not_in": "o_orderstatus"}
    return apply_load(base, orders_stage(spark, sf).withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'F')")), spec)


def q_update_from_mapped(spark, sf):
    """L11 with P5: the stage's columns are mapped one to one first."""
    stage = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    spec = {"pattern": "update", "columns": ["k", "big"], "exprs": ["o_orderkey", "o_totalprice > 100000"],
            "on": {"l_orderkey": "k"}, "sets": {"l_discount": 0.0}}
    return apply_load(table(spark, sf, "lineitem"), stage, spec)


def q_swap_recovered(spark, sf):
    """S7 after a cut: a swap stops between its renames, then the load is run
    again.  It first gives the old rows their name back, then applies once."""
    from loadwright.plans.apply import run_load

    name = scratch_table_name("orders_cut")
    S.write_table(orders_base(spark, sf), name, location=scratch_path(spark, name))
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "sets": {"o_totalprice": "a.o_totalprice + m.o_totalprice"},
            "order_by": ["o_orderdate"]}
    stage = orders_stage(spark, sf)
    S.begin_swap(apply_load(spark.table(name), stage, spec), name).set_aside()
    return run_load(name, stage, spec)


def q_swap_recovered_folder(spark, sf):
    """S5 after a cut between the two renames of a folder, then run again."""
    path = scratch_path(spark, "orders_cut_folder")
    S.write_table(table(spark, sf, "orders"), path)
    kept = table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    S.begin_folder_swap(kept, path).set_aside()
    S.recover(spark, path)
    S.overwrite(S.scan_base(spark, path).where(F.col("o_orderstatus") == "O"), path)
    return S.scan_base(spark, path)


def q_run_load_upsert_detects_partition(spark, sf):
    """A plain upsert of a partitioned table, its spec without ``partition``:
    only the partitions it touches are rewritten, every key stays unique."""
    from loadwright.plans.apply import run_load

    name = _years_table(spark, sf)
    return run_load(name, partition_stage(spark, sf, 1999), {"pattern": "upsert", "keys": ORDER_KEYS})


def _orders_files(spark, rows) -> str:
    """A catalog table of orders, its files cut by order key."""
    name = scratch_table_name("orders_files")
    S.write_table(rows.repartitionByRange(16, "o_orderkey"), name, location=scratch_path(spark, name))
    return name


def q_upsert_touched_files(spark, sf):
    """L8 that rewrites only the files holding a staged key."""
    from loadwright.plans.apply import run_load

    name = _orders_files(spark, orders_base(spark, sf))
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "sets": {"o_totalprice": "a.o_totalprice + m.o_totalprice"},
            "order_by": ["o_orderdate"], "rewrite": "files"}
    return run_load(name, orders_stage(spark, sf), spec)


def q_delete_touched_files(spark, sf):
    """L12 that rewrites only the files holding a deleted row."""
    from loadwright.plans.apply import run_load

    name = _orders_files(spark, table(spark, sf, "orders"))
    return run_load(name, None, {"pattern": "delete", "where": "o_orderkey < 1000 AND o_orderstatus <> 'O'", "rewrite": "files"})


def q_append_replayed(spark, sf):
    """S3 of a batch that is cut once its rows are written aside, then run
    again after another writer's append: every row is there once."""
    from loadwright.plans.apply import Batch, run_load

    name = scratch_table_name("customer_replay")
    cust, supp = (table(spark, sf, t) for t in ("customer", "supplier"))
    base = cust.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    S.write_table(base, name, location=scratch_path(spark, name))
    batch = Batch("replay", 0, scratch_path(spark, "replay_marks"))
    S.write_aside(L.selected_rows(base, supp, ["s_suppkey", "s_name"]), name, batch.mark)
    S.append(base, name)
    return run_load(name, supp, {"pattern": "insert", "cols": ["s_suppkey", "s_name"]}, batch=batch)


def q_affected_partitions_wide(spark, sf):
    """J5 with more touched values than a literal list may hold (here 20, so
    that months are enough): the scan is pruned by ranges of them."""
    path = scratch_path(spark, "orders_by_month")
    orders = table(spark, sf, "orders").withColumn("o_month", F.year("o_orderdate") * 100 + F.month("o_orderdate"))
    S.write_table(orders, path, partition_by=["o_month"])
    touched = orders.where(F.month("o_orderdate") % 2 == 1)
    return J.affected_partitions(S.scan_base(spark, path), touched, "o_month", max_listed=20)


def _years_table(spark, sf) -> str:
    name = scratch_table_name("orders_years")
    S.write_table(orders_by_year(spark, sf), name, partition_by=["o_year"], location=scratch_path(spark, name))
    return name


def q_update_partitioned(spark, sf):
    """L10 on a table partitioned by year: only 1997 is rewritten."""
    from loadwright.plans.apply import run_load

    name = _years_table(spark, sf)
    run_load(name, None, {"pattern": "update", "where": [("o_orderstatus", "=", "P"), ("o_year", "=", 1997)],
                          "sets": {"o_totalprice": 0.0}})
    return spark.table(name)


def q_delete_partitioned(spark, sf):
    """L12 on a table partitioned by year: 1995 empties and is dropped."""
    from loadwright.plans.apply import run_load

    name = _years_table(spark, sf)
    run_load(name, None, {"pattern": "delete", "where": "o_orderdate < TIMESTAMP_NTZ'1996-01-01' "
                                                       "OR (o_year = 1996 AND o_orderstatus = 'F')"})
    return spark.table(name)


def q_upsert_bucketed(spark, sf):
    """Upsert into a base stored bucketed on its key: the base is read without
    a shuffle, only staged rows move, and the swap keeps the bucketing."""
    from loadwright.plans.apply import run_load

    name = scratch_table_name("orders_bucketed")
    S.write_table(orders_base(spark, sf), name, location=scratch_path(spark, name),
                  buckets=8, bucket_by=ORDER_KEYS, sort_by=ORDER_KEYS)
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "order_by": ["o_orderdate"], "skew": None,
            "location": scratch_path(spark, name + "_v2")}
    run_load(name, orders_stage(spark, sf), spec)
    return spark.table(name)


def q_run_load_partitioned(spark, sf):
    """L14 end to end: partitioned upsert into a catalog table by year."""
    from loadwright.plans.apply import run_load

    name = scratch_table_name("orders_years")
    S.write_table(orders_by_year(spark, sf), name, partition_by=["o_year"], location=scratch_path(spark, name))
    run_load(name, partition_stage(spark, sf), {"pattern": "upsert", "keys": ORDER_KEYS, "partition": "o_year"})
    return spark.table(name)


def q_upsert_accumulate_partitioned(spark, sf):
    """Prices of open orders added up inside the partitions they touch."""
    spec = {"pattern": "summarize", "keys": ORDER_KEYS, "partition": "o_year", "scope": "table",
            "sets": {"o_totalprice": "a.o_totalprice + m.o_totalprice"}}
    return apply_load(orders_by_year(spark, sf), partition_stage(spark, sf, 1999), spec)


def q_upsert_partial_partitioned(spark, sf):
    """Only price and year are staged; the other columns keep their values."""
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "partition": "o_year", "scope": "partition",
            "columns": ["o_totalprice", "o_year"]}
    stage = partition_stage(spark, sf).select("o_orderkey", "o_totalprice", "o_year")
    return apply_load(orders_by_year(spark, sf), stage, spec)


def q_upsert_type_kept(spark, sf):
    """An INT base column stays INT when the stage brings BIGINT."""
    base = orders_base(spark, sf).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    out = L.upsert(base, orders_stage(spark, sf), ORDER_KEYS, ["o_orderdate"])
    return out.withColumn("type", F.typeof("o_custkey"))


def q_insert_select_partitioned(spark, sf):
    """An insert into a partitioned folder goes to its partitions."""
    from loadwright.plans.apply import run_load

    path = _write_partitioned_orders(spark, sf)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "o_year"]
    return run_load(path, partition_stage(spark, sf, 1999), {"pattern": "insert", "cols": cols})


def q_stream_history(spark, sf):
    """Several landed files make the new table together."""
    from loadwright.streaming.stage_files import start_stage_load

    name, drops = scratch_table_name("orders_history"), scratch_path(spark, "history_drops")
    ST.write_stage(orders_base(spark, sf), drops)
    ST.write_stage(orders_stage(spark, sf), drops, mode="append")
    spec = {"pattern": "history", "location": scratch_path(spark, name)}
    q = start_stage_load(spark, drops, TY.ddl_schema(ORDERS_DDL), name, spec)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stage stream failed: {q.exception()}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def q_apply_load_delete(spark, sf):
    spec = {"pattern": "delete", "where": [("l_returnflag", "=", "A"), ("l_quantity", "<", 10)]}
    return apply_load(table(spark, sf, "lineitem"), None, spec)


# ------------------------------------------------------------------ sources and sinks

ORDERS_DDL = {
    "o_orderkey": "BIGINT",
    "o_custkey": "BIGINT",
    "o_orderstatus": "CHAR(1)",
    "o_totalprice": "FLOAT",
    "o_orderdate": "TIMESTAMP(0)",
    "o_orderpriority": "VARCHAR(15)",
}


def q_stream_upsert(spark, sf):
    """Staged orders land as a text file; the stage-folder stream upserts them."""
    from loadwright.streaming.stage_files import start_stage_load

    name = scratch_table_name("orders_stream")
    S.write_table(orders_base(spark, sf), name, location=scratch_path(spark, name))
    drops = scratch_path(spark, "orders_drops")
    ST.write_stage(orders_stage(spark, sf), drops)
    spec = {"pattern": "upsert", "keys": ORDER_KEYS, "order_by": ["o_orderdate"],
            "location": scratch_path(spark, name + "_v2")}
    q = start_stage_load(spark, drops, TY.ddl_schema(ORDERS_DDL), name, spec)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stage stream failed: {q.exception()}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


CUSTOMER_DDL = {
    "C_CUSTKEY": "BIGINT",
    "C_NAME": "VARCHAR(25)",
    "C_NATIONKEY": "INTEGER",
    "C_ACCTBAL": "FLOAT",
    "C_MKTSEGMENT": "CHAR(10)",
}


def _customer_stage(spark, sf) -> str:
    path = scratch_path(spark, "customer_stage")
    ST.write_stage(table(spark, sf, "customer"), path)
    return path


def q_scan_stage(spark, sf):
    return ST.scan_stage(spark, _customer_stage(spark, sf), TY.ddl_schema(CUSTOMER_DDL))


def q_history_load(spark, sf):
    raw = ST.scan_stage(spark, _customer_stage(spark, sf), TY.ddl_schema({k: "VARCHAR(64)" for k in CUSTOMER_DDL}))
    out = scratch_path(spark, "customer_hist")
    S.overwrite(L.history_load(raw, CUSTOMER_DDL), out)
    return S.scan_base(spark, out)


def q_history_load_partitioned(spark, sf):
    raw = ST.scan_stage(spark, _customer_stage(spark, sf), TY.ddl_schema(CUSTOMER_DDL))
    out = scratch_path(spark, "customer_hist_p")
    S.append_partitioned(L.history_load(raw, None, "c_mktsegment"), out, "c_mktsegment")
    return S.scan_base(spark, out)


def q_append(spark, sf):
    out = scratch_path(spark, "customer_append")
    S.append(table(spark, sf, "customer"), out)
    supp = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", F.lit("SUPPLIER"))
    S.append(supp, out)
    return S.scan_base(spark, out)


def q_append_partitioned(spark, sf):
    out = scratch_path(spark, "orders_append_p")
    ob = orders_by_year(spark, sf)
    S.append_partitioned(ob.where(F.col("o_year") < 1998), out, "o_year")
    S.append_partitioned(ob.where(F.col("o_year") >= 1998), out, "o_year")
    return S.scan_base(spark, out)


def q_overwrite_partitions(spark, sf):
    path = _write_partitioned_orders(spark, sf)
    base = S.scan_base(spark, path)
    repl = base.where(F.col("o_year").isin(1996, 1997) & (F.col("o_orderstatus") == "F"))
    S.overwrite_partitions(repl, path, "o_year")
    return S.scan_base(spark, path)


def _orders_table(spark, sf) -> str:
    name = scratch_table_name("orders_base")
    S.write_table(table(spark, sf, "orders"), name, location=scratch_path(spark, name))
    return name


def q_scan_base(spark, sf):
    return S.scan_base(spark, _orders_table(spark, sf))


def q_swap_in(spark, sf):
    name = _orders_table(spark, sf)
    new = S.scan_base(spark, name).where(F.col("o_orderstatus") == "O")
    S.swap_in(new, name, location=scratch_path(spark, name + "_v2"))
    return spark.table(name)


def q_overwrite(spark, sf):
    name = _orders_table(spark, sf)
    new = L.update_where(S.scan_base(spark, name), [("o_orderstatus", "=", "P")], {"o_orderstatus": "F"})
    S.overwrite(new, name, location=scratch_path(spark, name + "_v2"))
    return spark.table(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # dedup / windows
    "latest_per_key": q_latest_per_key,
    "with_sequence": q_with_sequence,
    "with_sequence_hot_key": q_with_sequence_hot_key,
    "select_distinct": q_select_distinct,
    "distinct_table": q_distinct_table,
    "distinct_keys": q_distinct_keys,
    # joins
    "unaffected": q_unaffected,
    "new_rows": q_new_rows,
    "matched_rows": q_matched_rows,
    "pair": q_pair,
    "affected_partitions": q_affected_partitions,
    "unaffected_in_partitions": q_unaffected_in_partitions,
    "matching": q_matching,
    "not_in_null_aware": q_not_in_null_aware,
    # filters
    "where_all": q_where_all,
    "where_range": q_where_range,
    "exclude": q_exclude,
    # projections / scalar
    "conform": q_conform,
    "conform_picture": q_conform_picture,
    "rename": q_rename,
    "lower_names": q_lower_names,
    "map_columns": q_map_columns,
    "concat_cols": q_concat_cols,
    "substr_col": q_substr_col,
    "parse_date": q_parse_date,
    "sentinel_date": q_sentinel_date,
    "set_literal": q_set_literal,
    "accumulate": q_accumulate,
    "fill_from_base": q_fill_from_base,
    # load patterns
    "upsert": q_upsert,
    "upsert_dedup": q_upsert_dedup,
    "upsert_accumulate": q_upsert_accumulate,
    "latest_per_hot_key": q_latest_per_hot_key,
    "upsert_hot_key": q_upsert_hot_key,
    "upsert_accumulate_hot_key": q_upsert_accumulate_hot_key,
    "upsert_partial": q_upsert_partial,
    "upsert_partitioned": q_upsert_partitioned,
    "upsert_partition_move": q_upsert_partition_move,
    "upsert_partitioned_table": q_upsert_partitioned_table,
    "update_where": q_update_where,
    "update_from": q_update_from,
    "delete_where": q_delete_where,
    "delete_from": q_delete_from,
    "append_distinct": q_append_distinct,
    "append_distinct_incremental": q_append_distinct_incremental,
    "full_refresh": q_full_refresh,
    "insert_select": q_insert_select,
    "stack": q_stack,
    "apply_load": q_apply_load,
    "apply_load_delete": q_apply_load_delete,
    "run_load_upsert": q_run_load_upsert,
    "run_load_upsert_detects_partition": q_run_load_upsert_detects_partition,
    "upsert_accumulate_one_pass": q_upsert_accumulate_one_pass,
    "upsert_partial_one_pass": q_upsert_partial_one_pass,
    "not_in_one_pass": q_not_in_one_pass,
    "upsert_not_in": q_upsert_not_in,
    "update_from_mapped": q_update_from_mapped,
    "swap_recovered": q_swap_recovered,
    "swap_recovered_folder": q_swap_recovered_folder,
    "upsert_touched_files": q_upsert_touched_files,
    "delete_touched_files": q_delete_touched_files,
    "append_replayed": q_append_replayed,
    "affected_partitions_wide": q_affected_partitions_wide,
    "run_load_partitioned": q_run_load_partitioned,
    "upsert_bucketed": q_upsert_bucketed,
    "update_partitioned": q_update_partitioned,
    "delete_partitioned": q_delete_partitioned,
    # sources / sinks
    "scan_stage": q_scan_stage,
    "history_load": q_history_load,
    "history_load_partitioned": q_history_load_partitioned,
    "append": q_append,
    "append_partitioned": q_append_partitioned,
    "overwrite_partitions": q_overwrite_partitions,
    "scan_base": q_scan_base,
    "swap_in": q_swap_in,
    "overwrite": q_overwrite,
    "stream_upsert": q_stream_upsert,
    "global_sequence": q_global_sequence,
    "with_sequence_hot_key_salted": q_with_sequence_hot_key_salted,
    "unaffected_null_keys": q_unaffected_null_keys,
    "update_from_null_keys": q_update_from_null_keys,
    "upsert_accumulate_partitioned": q_upsert_accumulate_partitioned,
    "upsert_partial_partitioned": q_upsert_partial_partitioned,
    "upsert_type_kept": q_upsert_type_kept,
    "insert_select_partitioned": q_insert_select_partitioned,
    "stream_history": q_stream_history,
}
