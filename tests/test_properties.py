"""Load patterns against brute-force definitions on random small frames.

Rows draw keys from {NULL, 1, 2, 3} and values from {NULL, 0..5}, so NULL
keys, repeated keys in base and stage, and NULL values all occur.  The stage's
arrival order is its row position.  Half of the examples force salting on
(every key hot, one bucket per row), so the salted joins are checked too.
"""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loadwright.operators.joins import not_in_null_aware
from loadwright.operators.skew import MIN_ROWS_CONF, ROWS_PER_TASK_CONF
from loadwright.plans import loads as L

KEY = st.one_of(st.none(), st.integers(1, 3))
VAL = st.one_of(st.none(), st.integers(0, 5))
ROWS = st.lists(st.tuples(KEY, VAL, VAL), max_size=8)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

BASE_SCHEMA = "k bigint, v bigint, w bigint"
STAGE_SCHEMA = "k bigint, v bigint, w bigint, o bigint"


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is not None, x) for x in t))


def _frames(spark, base, stage):
    b = spark.createDataFrame(base, BASE_SCHEMA)
    s = spark.createDataFrame([(*r, i) for i, r in enumerate(stage)], STAGE_SCHEMA)
    return b, s


def _run(spark, salted, build):
    if salted:
        spark.conf.set(MIN_ROWS_CONF, "0")
        spark.conf.set(ROWS_PER_TASK_CONF, "1")
    try:
        return _sorted(tuple(r) for r in build().collect())
    finally:
        spark.conf.unset(MIN_ROWS_CONF)
        spark.conf.unset(ROWS_PER_TASK_CONF)


def _latest(stage):
    """Latest staged row per key (NULL keys form one group), as (k, v, w)."""
    best = {}
    for i, (k, v, w) in enumerate(stage):
        best[k] = (k, v, w, i)
    return [r[:3] for r in best.values()]


def _staged_keys(stage):
    return {r[0] for r in stage if r[0] is not None}


def _add(a, b):
    return None if a is None or b is None else a + b


@SETTINGS
@given(base=ROWS, stage=ROWS, salted=st.booleans())
def test_upsert(spark, base, stage, salted):
    b, s = _frames(spark, base, stage)
    got = _run(spark, salted, lambda: L.upsert(b, s, ["k"], ["o"]))
    keys = _staged_keys(stage)
    want = [r for r in base if r[0] is None or r[0] not in keys] + _latest(stage)
    assert got == _sorted(want)


@SETTINGS
@given(base=ROWS, stage=ROWS, salted=st.booleans())
def test_upsert_accumulate(spark, base, stage, salted):
    b, s = _frames(spark, base, stage)
    got = _run(spark, salted, lambda: L.upsert_accumulate(b, s, ["k"], {"v": "a.v + m.v"}, ["o"]))
    d = {r[0]: r for r in _latest(stage)}
    base_keys = {r[0] for r in base if r[0] is not None}
    want = []
    for k, v, w in base:
        m = d.get(k) if k is not None else None
        want.append((k, _add(v, m[1]), m[2]) if m else (k, v, w))
    want += [r for k, r in d.items() if k is None or k not in base_keys]
    assert got == _sorted(want)


@SETTINGS
@given(base=ROWS, stage=ROWS, salted=st.booleans())
def test_upsert_partial(spark, base, stage, salted):
    b, s = _frames(spark, base, stage)
    got = _run(spark, salted, lambda: L.upsert_partial(b, s.drop("w"), ["k"], ["v"], ["o"]))
    d = {r[0]: r for r in _latest(stage)}
    base_keys = {r[0] for r in base if r[0] is not None}
    want = []
    for k, v, w in base:
        m = d.get(k) if k is not None else None
        want.append((k, m[1], w) if m else (k, v, w))
    want += [(k, r[1], None) for k, r in d.items() if k is None or k not in base_keys]
    assert got == _sorted(want)


@SETTINGS
@given(base=ROWS, stage=ROWS, salted=st.booleans())
def test_update_and_delete_from(spark, base, stage, salted):
    b, s = _frames(spark, base, stage)
    keys = _staged_keys(stage)
    got = _run(spark, salted, lambda: L.update_from(b, s, ["k"], {"v": 0}))
    assert got == _sorted((k, 0 if k in keys else v, w) for k, v, w in base)
    got = _run(spark, salted, lambda: L.delete_from(b, s, ["k"]))
    assert got == _sorted(r for r in base if r[0] not in keys)


@SETTINGS
@given(base=ROWS, stage=ROWS, salted=st.booleans())
def test_not_in_null_aware(spark, base, stage, salted):
    # base.v NOT IN (SELECT s.v FROM stage s WHERE s.k = base.k)
    b, s = _frames(spark, base, stage)
    got = _run(spark, salted, lambda: not_in_null_aware(b, s, "v", ["k"]))
    want = []
    for k, v, w in base:
        vals = [sv for sk, sv, _ in stage if k is not None and sk == k]
        if not vals or (v is not None and None not in vals and v not in vals):
            want.append((k, v, w))
    assert got == _sorted(want)


@SETTINGS
@given(base=ROWS, stage=ROWS)
def test_append_distinct(spark, base, stage):
    b, s = _frames(spark, base, stage)
    got = _run(spark, False, lambda: L.append_distinct(b, s.drop("o")))
    assert got == _sorted(set(base) | set(stage))
    distinct_base = list(dict.fromkeys(base))
    b2 = spark.createDataFrame(distinct_base, BASE_SCHEMA)
    got = _run(spark, False, lambda: L.append_distinct(b2, s.drop("o"), base_is_distinct=True))
    assert got == _sorted(set(base) | set(stage))


PART = st.one_of(st.none(), st.integers(1995, 1997))
PROWS = st.lists(st.tuples(KEY, VAL, PART), max_size=8)


@SETTINGS
@given(base=PROWS, stage=PROWS, salted=st.booleans(), scope=st.sampled_from(["partition", "table"]))
def test_upsert_partitioned(spark, base, stage, salted, scope):
    # base (k, v, p), rebuilt partitions only; NULL is a partition value too
    b = spark.createDataFrame(base, "k bigint, v bigint, p int")
    s = spark.createDataFrame([(*r, i) for i, r in enumerate(stage)], "k bigint, v bigint, p int, o bigint")
    got = _run(spark, salted, lambda: L.upsert_partitioned(b, s, ["k"], "p", ["o"], scope=scope))
    d = _latest(stage)
    keys = _staged_keys(stage)
    touched = {r[2] for r in d}
    if scope == "table":
        touched |= {p for k, _, p in base if k in keys}
    want = [r for r in base if r[2] in touched and r[0] not in keys] + d
    assert got == _sorted(want)


@SETTINGS
@given(rows=st.lists(st.tuples(KEY, VAL), max_size=12), salted=st.booleans())
def test_with_sequence(spark, rows, salted):
    from loadwright.operators.dedup import with_sequence

    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k bigint, v bigint, o bigint")
    got = _run(spark, salted, lambda: with_sequence(df, ["k"], ["o"]))
    seen: dict = {}
    want = []
    for i, (k, v) in enumerate(rows):
        seen[k] = seen.get(k, 0) + 1
        want.append((k, v, i, seen[k]))
    assert got == _sorted(want)


def test_append_distinct_across_types(spark):
    # staged ints against a bigint/double base: equal values are found
    base = spark.createDataFrame([(1, 0.0), (2, None)], "k bigint, v double")
    st = spark.createDataFrame([(1, -0.0), (2, None), (3, 1.5)], "k int, v float")
    got = _run(spark, False, lambda: L.distinct_new_rows(base, st))
    assert got == [(3, 1.5)]


@SETTINGS
@given(base=ROWS, a=st.integers(0, 5), b=st.integers(0, 5))
def test_update_and_delete_where(spark, base, a, b):
    # WHERE v = a AND w <> b: a NULL comparison is not true, so such rows are
    # neither updated nor deleted
    b_df = spark.createDataFrame(base, BASE_SCHEMA)
    preds = [("v", "=", a), ("w", "<>", b)]

    def hit(v, w):
        return v is not None and w is not None and v == a and w != b

    got = _run(spark, False, lambda: L.update_where(b_df, preds, {"w": -1}))
    assert got == _sorted((k, v, -1 if hit(v, w) else w) for k, v, w in base)
    got = _run(spark, False, lambda: L.delete_where(b_df, preds))
    assert got == _sorted(r for r in base if not hit(r[1], r[2]))
