"""The threshold algorithm against scores of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadwright.llm.op12_topk import Lists, _exact, quantised, top_k


def best(rows, ids, query, own, k):
    scores = rows @ query
    order = sorted((i for i in range(len(rows)) if i != own), key=lambda i: (-scores[i], ids[i]))
    return [(int(ids[i]), int(scores[i])) for i in order[:k]]


@pytest.mark.parametrize("n, d, high", [(400, 8, 100), (400, 3, 4), (7, 5, 9), (3, 2, 2), (300, 6, 1 << 30), (60, 4, 1 << 45)])
def test_lists_give_the_best_rows(n, d, high):
    rng = np.random.default_rng(n + d)
    rows = rng.integers(-high, high, (n, d), endpoint=True)
    ids = rng.permutation(n) * 3
    rows, queries = _exact(rows, rows)
    lists = Lists(rows, ids, np.arange(n))
    for q in range(min(n, 60)):
        got = [(int(lists.ids[i]), int(lists.rows[i] @ queries[q])) for i in lists.top(queries[q], q, 5)]
        assert got == best(rows, ids, queries[q], q, 5)


def test_search_stops_at_the_threshold():
    rng = np.random.default_rng(5)
    rows = rng.integers(-20, 20, (8000, 6))
    rows[:, 0] = rng.permutation(8000) * 10  # one dimension decides
    rows, queries = _exact(rows, np.array([[100, 1, -1, 0, 2, 1], [0, 0, 0, 0, 0, 0]]))
    lists = Lists(rows, np.arange(8000), np.arange(8000))
    got = lists.top(queries[0], -1, 5)
    assert [int(lists.ids[i]) for i in got] == [i for i, _ in best(rows, np.arange(8000), queries[0], -1, 5)]
    assert lists.accesses < 400
    assert [int(lists.ids[i]) for i in lists.top(queries[1], 2, 5)] == [0, 1, 3, 4, 5]


def test_blocks_and_groups_do_not_change_the_result(spark):
    rng = np.random.default_rng(9)
    data = [(int(i), [float(x) for x in rng.normal(size=5)]) for i in range(500)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    v = quantised(df, "vec_id", "embedding")
    whole = sorted(map(tuple, top_k(v, F.col("id") % 10 == 0).collect()))
    cut = sorted(map(tuple, top_k(v, F.col("id") % 10 == 0, block=64, group=7).collect()))
    assert whole == cut and len(whole) == 250
    rows = np.floor(np.array([x for _, x in data]) * 256).astype(np.int64)
    for q in range(0, 500, 10):
        assert [(r[2], r[3]) for r in whole if r[0] == q] == best(rows, np.arange(500), rows[q], q, 5)


def test_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [float("nan")])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, top_k(quantised(df, "vec_id", "embedding"), F.col("id") % 50 == 0).collect()))
    assert got == [(0, 1, 1, 512 * 256)]
