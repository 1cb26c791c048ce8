"""The concentration steps against numpy, and the plan has no Python."""

import numpy as np
from pyspark.sql import functions as F

from loadwright.llm import op2_outliers as o


def test_estimate_matches_numpy_concentration(spark):
    rng = np.random.default_rng(1)
    clean = rng.multivariate_normal([5000, 100, 300, 400], np.diag([500.0, 90, 90, 90]) ** 2, 400)
    far = rng.multivariate_normal([9000, 900, 900, 900], np.eye(4) * 100, 60)
    x = np.rint(np.vstack([clean, far])).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], "grp string, x0 long, x1 long, x2 long, x3 long")
    got = o.minimum_covariance(rows).first()

    floor = np.diag([(f * o.UNIT) ** 2 for f in o.FLOOR])
    m = np.median(x, axis=0)
    c = np.diag((1.4826 * np.median(np.abs(x - m), axis=0)) ** 2) + floor
    for step in range(o.STEPS + 1):
        d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        if step < o.STEPS:
            bins = np.floor(np.minimum(d2 * o.BIN_UNIT, o.BINS))
            chosen, factor = x[bins <= np.sort(bins)[int(np.ceil(o.SUPPORT * len(x))) - 1]], o.FACTOR_SUPPORT
        else:
            chosen, factor = x[d2 <= o.CUT_WEIGHTED], o.FACTOR_WEIGHTED
        m, c = chosen.mean(axis=0), factor * np.cov(chosen.T, bias=True) + floor
    assert np.allclose([got[f"m{i}"] for i in range(4)], m)
    low = np.linalg.cholesky(c)
    assert np.allclose([got[f"l{i}{j}"] for i, j in o.PAIRS], [low[i, j] for i, j in o.PAIRS])
    assert abs(m[0] - 5000) < 150  # the far group does not pull the centre


def test_chi_square():
    assert abs(o.chi2_quantile(4, 0.975) - 11.1433) < 1e-3
    assert abs(1 - o.chi2_tail(6, o.chi2_quantile(6, 0.3)) - 0.3) < 1e-9


def test_repeated_words_against_brute_force(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a", "a b c d", "x y z x y z x y z x", "p q r s t u p q r s t v p q r s t", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in o.base_statistics(df).collect():
        w = (r["text"] or "").split()
        wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        hit = {p for i, x in enumerate(wins) if wins.count(x) > 1 for p in range(i, i + 5)}
        assert (r["n_words"], r["n_repeat_words"]) == (len(w), len(hit)), r["text"]


def test_plan_is_native(spark):
    df = o.base_statistics(spark.createDataFrame([("a b",)], "text string")).withColumn("f", F.expr(o.BASE_FAILED))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
