"""Salted joins: same rows as the oracle when hot keys are salted."""

import duckdb
import pytest

import __spark_entry__ as E
from loadwright import queries as Q
from loadwright.operators.skew import MIN_ROWS_CONF, ROWS_PER_TASK_CONF, hot_keys, key_join
from tests.test_oracle import SF, TABLES, _norm

SALTED_QUERIES = [
    "with_sequence",
    "with_sequence_hot_key",
    "upsert_hot_key",
    "upsert_accumulate_hot_key",
    "upsert",
    "upsert_dedup",
    "upsert_partial",
    "upsert_accumulate",
    "upsert_partitioned_table",
    "update_from",
    "delete_from",
    "matching",
    "not_in_null_aware",
    "pair",
    "unaffected",
    "new_rows",
    "matched_rows",
    "fill_from_base",
    "accumulate",
]


@pytest.fixture(params=["50", "1"])
def salted(spark, request):
    spark.conf.set(MIN_ROWS_CONF, "0")
    spark.conf.set(ROWS_PER_TASK_CONF, request.param)
    yield request.param
    spark.conf.unset(MIN_ROWS_CONF)
    spark.conf.unset(ROWS_PER_TASK_CONF)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_hot_key_found_and_salted(spark, salted):
    base = Q.hot_base(spark, SF)
    hot = hot_keys(base, ["hot_key"])
    assert hot is not None
    got = {r["__h0"]: r["__n"] for r in hot.collect()}
    assert -1 in got
    if salted == "50":
        assert set(got) == {-1} and got[-1] > 10
    joined = key_join(base, Q.hot_stage(spark, SF).select("hot_key").distinct(),
                      [("hot_key", "hot_key")], "left_anti", hot)
    assert "__salt" in joined.columns


def test_small_tables_are_not_sampled(spark):
    assert hot_keys(Q.hot_base(spark, SF), ["hot_key"]) is None


def test_salting_refuses_outer_joins(spark, salted):
    base = Q.hot_base(spark, SF)
    with pytest.raises(ValueError):
        key_join(base, base, [("hot_key", "hot_key")], "right", hot_keys(base, ["hot_key"]))


@pytest.mark.parametrize("name", SALTED_QUERIES)
def test_salted_query_matches_oracle(spark, con, salted, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    recs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert got == sorted(tuple(_norm(r[c]) for c in cols) for r in recs)


def test_hot_threshold_rises_with_table_size(spark, monkeypatch):
    # With room for only 10 hot keys, a key needs rows / 10 rows to be hot,
    # whatever the per-task target: only the shared key of a third of the
    # rows qualifies.
    import loadwright.operators.skew as SK

    spark.conf.set(MIN_ROWS_CONF, "0")
    spark.conf.set(ROWS_PER_TASK_CONF, "1")
    monkeypatch.setattr(SK, "MAX_HOT_KEYS", 10)
    try:
        hot = hot_keys(Q.hot_base(spark, SF), ["hot_key"])
        assert {r["__h0"] for r in hot.collect()} == {-1}
    finally:
        spark.conf.unset(MIN_ROWS_CONF)
        spark.conf.unset(ROWS_PER_TASK_CONF)



def test_sequence_spreads_a_group_of_exact_copies(spark):
    # 4,000 identical rows: one key, tied on the order column.  The numbering
    # stays dense 1..n and the rows are split over the range partitions
    # instead of landing in one task.
    from pyspark.sql import functions as F

    from loadwright.operators.dedup import global_sequence, with_sequence

    df = spark.range(4000, numPartitions=4).select(F.lit(1).alias("k"), F.lit(0).alias("o"))
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, "8")
    try:
        out = global_sequence(df, ["k", "o"]).withColumn("p", F.spark_partition_id())
        got = out.agg(F.min("row_num"), F.max("row_num"), F.countDistinct("row_num")).first()
        assert tuple(got) == (1, 4000, 4000)
        # range bounds are sampled, so partitions differ; none holds half of the copies
        assert out.groupBy("p").count().agg(F.max("count")).first()[0] < 2000
    finally:
        spark.conf.set(key, before)

    spark.conf.set(MIN_ROWS_CONF, "0")
    spark.conf.set(ROWS_PER_TASK_CONF, "100")
    try:
        seq = with_sequence(df, ["k"], ["o"])
        got = seq.agg(F.min("row_num"), F.max("row_num"), F.countDistinct("row_num")).first()
        assert tuple(got) == (1, 4000, 4000)
    finally:
        spark.conf.unset(MIN_ROWS_CONF)
        spark.conf.unset(ROWS_PER_TASK_CONF)


def test_salt_and_sequence_are_stable_when_recomputed(spark, salted):
    # A lost task is recomputed from its input split; the recomputation must
    # put every row in the same salt bucket and give it the same number, or
    # it would miss its partners.  Two independent evaluations must agree.
    from pyspark.sql import functions as F

    from loadwright.operators.dedup import with_sequence

    base = Q.hot_base(spark, SF)
    keys = Q.hot_stage(spark, SF).select("hot_key").distinct()

    def salts():
        j = key_join(base, keys, [("hot_key", "hot_key")], "left_semi", hot_keys(base, ["hot_key"]))
        return sorted(
            tuple(r) for r in j.select(
                F.col("a.l_orderkey"), F.col("a.l_linenumber"), F.col("a.l_shipdate"), F.col("a.__salt")
            ).collect()
        )

    first, second = salts(), salts()
    assert first == second and len({r[-1] for r in first}) > 1

    def numbers():
        seq = with_sequence(base, ["hot_key"], Q.HOT_ORDER)
        return sorted(tuple(r) for r in seq.select("l_orderkey", "l_linenumber", "l_shipdate", "row_num").collect())

    assert numbers() == numbers()


def test_no_task_gets_a_hot_key_of_a_sequence(spark):
    # Without adaptive joins: the numbered rows of one key stay dealt over the tasks.
    from pyspark.sql import functions as F

    from loadwright.operators.dedup import with_sequence

    own = {MIN_ROWS_CONF: "0", ROWS_PER_TASK_CONF: "100", "spark.sql.adaptive.enabled": "false",
           "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(4000, numPartitions=4).select(
            F.when(F.col("id") % 8 == 0, F.lit(None)).when(F.col("id") % 8 < 6, F.lit(1)).otherwise(F.lit(2)).alias("k"),
            (F.lit(4000) - F.col("id")).alias("o"),
        )
        out = with_sequence(rows, ["k"], ["o"]).withColumn("p", F.spark_partition_id())
        got = out.select("k", "o", "row_num", "p").collect()
        assert max(sum(r["p"] == p for r in got) for p in {r["p"] for r in got}) < 1500
        for key, n in ((None, 500), (1, 2500), (2, 1000)):
            assert [r["row_num"] for r in sorted((r for r in got if r["k"] == key), key=lambda r: r["o"])] == list(range(1, n + 1))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_bucket_is_no_larger_than_a_shuffle_partition(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    own = {MIN_ROWS_CONF: "0", ROWS_PER_TASK_CONF: "1000", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        assert [tuple(r) for r in hot_keys(df, ["k"]).collect()] == [(-1, 4)]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
