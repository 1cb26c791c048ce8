"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

Every document that passes the base rules gives a vector of transformed
statistics (mean word length; square roots of the shares of symbols, capital
letters and punctuation), each drawn towards plain text by a few pseudo-counts
so that short texts do not stray, in fixed point.  Per language and source the
minimum-covariance-determinant estimate of centre and scatter is found by
concentration steps: from medians and absolute deviations, again and again
take the ``SUPPORT`` share of documents nearest by Mahalanobis distance and
estimate anew.  A reweighted step follows, and documents beyond the
chi-square quantile of the final distances are rejected.

Everything is DataFrame expressions.  Distances are cut into bins, so the
nearest share is found from counts per group and bin; sums are of integers
(decimals), so results do not depend on how rows are spread.  A group's rows
never meet in one task: only its sums, counts and bins (at most ``BINS``) do.

Groups with fewer than ``MIN_ROWS`` documents are estimated together per
language, and languages with fewer together.  ``FLOOR`` (squared, in units of
each statistic) is added to the variances, so that a statistic that hardly
varies does not reject by itself.

Cases: null and empty texts have no words and fail the base rules; null
languages and sources are groups of their own; repeated rows count each;
an empty table gives an empty result; other columns pass through in a struct.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

SUPPORT = 0.75
STEPS = 6
MIN_ROWS = 50
BINS = 65536
BIN_UNIT = 16  # bins a unit of squared distance
ALPHA = 1e-4  # share of clean documents beyond the cut, were they normal
UNIT = 1024  # fixed point
FLOOR = (0.4, 0.06, 0.06, 0.06)
DIM = 4
NAMES = ("mean_word", "symbols", "capitals", "marks")

# ---- base rules -------------------------------------------------------------


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` plus the base statistics, from whole texts, row by row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    out = docs.withColumns({"__w": words, "__lines": lines})
    window = F.transform(
        F.when(F.size("__w") >= 5, F.sequence(F.lit(0), F.size("__w") - 5)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get(F.col("__w"), i + k) for k in range(5)]),
    )
    out = out.withColumns({"__h": window, "__joined": F.array_join("__w", "")})
    # Texts that repeat a window: sort (hash, place), mark equal neighbours.
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    placed = F.when(repeats, F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    out = out.withColumn("__s", placed)
    near = F.filter(
        "__s",
        lambda e, i: (e["h"] == F.get(F.col("__s"), i + 1)["h"]) | ((i > 0) & (e["h"] == F.get(F.col("__s"), i - 1)["h"])),
    )
    out = out.withColumn("__p", F.sort_array(F.transform(near, lambda e: e["i"])))
    covered = F.transform("__p", lambda p, i: F.when(i == 0, 5).otherwise(F.least(F.lit(5), p - F.get(F.col("__p"), i - 1))))
    joined = F.col("__joined")
    return out.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(joined).cast("long"),
        "n_symbols": F.regexp_count(joined, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(
            F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long")
        ),
        "n_capitals": F.regexp_count(joined, F.lit("[A-ZÀ-ÖØ-Þ]")).cast("long"),
        "n_marks": F.regexp_count(joined, F.lit("[.,!?;:]")).cast("long"),
    }).drop("__w", "__lines", "__h", "__joined", "__s", "__p")


BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
# The statistic vector in fixed point; the same SQL runs on both engines.
VECTOR = (
    f"CAST(floor((word_chars + 50) / CAST(n_words + 10 AS DOUBLE) * {UNIT} + 0.5) AS BIGINT)",
    *[
        f"CAST(floor(sqrt(({n} + {extra}) / CAST(word_chars + 50 AS DOUBLE)) * {UNIT} + 0.5) AS BIGINT)"
        for n, extra in (("n_symbols", 0), ("n_capitals", 1), ("n_marks", 1))
    ],
)

# ---- estimates --------------------------------------------------------------


def chi2_tail(dof: int, x: float) -> float:
    """P(chi-square > x) for an even number of degrees of freedom."""
    return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))


def chi2_quantile(dof: int, p: float) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - chi2_tail(dof, mid) < p else (lo, mid)
    return lo


def consistency(share: float) -> float:
    """Factor that makes the scatter of the nearest share right for normal data."""
    return share / (1 - chi2_tail(DIM + 2, chi2_quantile(DIM, share)))


CUT = chi2_quantile(DIM, 1 - ALPHA)
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]
FACTOR_SUPPORT = consistency(SUPPORT)
FACTOR_WEIGHTED = consistency(0.975)
CUT_WEIGHTED = chi2_quantile(DIM, 0.975)

SUMS = {"n": "COUNT(*)"} | {f"s{i}": f"SUM(x{i})" for i in range(DIM)} | {
    f"q{i}{j}": f"SUM(CAST(x{i} * x{j} AS DECIMAL(18, 0)))" for i, j in PAIRS
}


def scatter_sql(factor: float) -> list[tuple[str, str]]:
    """Steps from a group's sums to its centre m and Cholesky factor l."""
    steps = [(f"m{i}", f"CAST(s{i} AS DOUBLE) / n") for i in range(DIM)]
    steps += [
        (f"c{i}{j}", f"{factor!r}e0 * (CAST(q{i}{j} AS DOUBLE) / n - m{i} * m{j})" + (f" + {(FLOOR[i] * UNIT) ** 2!r}e0" if i == j else ""))
        for i, j in PAIRS
    ]
    return steps + cholesky_sql()


def cholesky_sql() -> list[tuple[str, str]]:
    out = []
    for i, j in PAIRS:
        inner = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        out.append((f"l{i}{j}", f"sqrt(c{i}{j}{inner})" if i == j else f"(c{i}{j}{inner}) / l{j}{j}"))
    return out


def distance_sql() -> list[tuple[str, str]]:
    """Steps from x, m and l to the squared distance d2."""
    out = [
        (f"y{i}", f"(x{i} - m{i}{''.join(f' - l{i}{k} * y{k}' for k in range(i))}) / l{i}{i}") for i in range(DIM)
    ]
    return [*out, ("d2", " + ".join(f"y{i} * y{i}" for i in range(DIM)))]


ESTIMATE = ["grp", *[f"m{i}" for i in range(DIM)], *[f"l{i}{j}" for i, j in PAIRS]]
BIN = f"CAST(least(floor(d2 * {BIN_UNIT}), {BINS}) AS BIGINT)"


def with_steps(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    for name, expr in steps:
        df = df.withColumn(name, F.expr(expr))
    return df


def first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and median absolute deviations as a diagonal scatter."""
    med = materialise(rows.groupBy("grp").agg(*[F.expr(f"percentile(x{i}, 0.5)").alias(f"m{i}") for i in range(DIM)]), "medians")
    dev = rows.join(med, "grp").groupBy("grp").agg(
        *[F.expr(f"percentile(abs(x{i} - m{i}), 0.5)").alias(f"a{i}") for i in range(DIM)]
    )
    both = med.join(dev, "grp")
    steps = [
        (f"c{i}{j}", f"(1.4826e0 * a{i}) * (1.4826e0 * a{i}) + {(FLOOR[i] * UNIT) ** 2!r}e0" if i == j else "0e0") for i, j in PAIRS
    ]
    return materialise(with_steps(both, steps + cholesky_sql()).select(*ESTIMATE), "first")


def measured(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    return with_steps(rows.join(estimate, "grp"), distance_sql())


def estimate_of(chosen: DataFrame, factor: float) -> DataFrame:
    sums = chosen.groupBy("grp").agg(*[F.expr(e).alias(n) for n, e in SUMS.items()])
    return materialise(with_steps(sums, scatter_sql(factor)).select(*ESTIMATE), "estimate")


def minimum_covariance(rows: DataFrame) -> DataFrame:
    """Centre and Cholesky factor of each ``grp`` of rows (grp, x0..x3)."""
    estimate = first_estimate(rows)
    for _ in range(STEPS):
        seen = measured(rows, estimate).withColumn("bin", F.expr(BIN))
        counts = seen.groupBy("grp", "bin").agg(F.count("*").alias("k"))
        counts = counts.withColumns({
            "upto": F.expr("SUM(k) OVER (PARTITION BY grp ORDER BY bin)"),
            "total": F.expr("SUM(k) OVER (PARTITION BY grp)"),
        })
        limit = counts.where(f"upto * 1000 >= total * {round(SUPPORT * 1000)}").groupBy("grp").agg(F.min("bin").alias("last"))
        nearest = seen.join(materialise(limit, "limit"), "grp").where("bin <= last")
        estimate = estimate_of(nearest, FACTOR_SUPPORT)
    inner = measured(rows, estimate).where(f"d2 <= {CUT_WEIGHTED!r}e0")
    return estimate_of(inner, FACTOR_WEIGHTED)


def estimation_groups(rows: DataFrame) -> DataFrame:
    """(lang, source, grp) of each pair; small groups share one."""
    counts = materialise(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "counts")
    small = counts.where(f"n < {MIN_ROWS}").groupBy("lang").agg(F.sum("n").alias("rest"))
    small = small.select(F.col("lang").alias("s_lang"), "rest")
    name = F.when(F.col("n") >= MIN_ROWS, F.concat(F.lit("g\t"), quoted("lang"), F.lit("\t"), quoted("source"))).when(
        F.col("rest") >= MIN_ROWS, F.concat(F.lit("l\t"), quoted("lang"))
    ).otherwise(F.lit("all"))
    return materialise(
        counts.join(small, F.col("lang").eqNullSafe(F.col("s_lang")), "left").select(
            F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), name.alias("grp")
        ),
        "groups",
    )


def quoted(name: str):
    return F.coalesce(F.concat(F.lit("'"), F.col(name)), F.lit("null"))


def reject_outliers(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc (a struct of its columns but text), the base
    statistics, base_failed, distance (squared, of base passes) and kept."""
    rest = [c for c in docs.columns if c != "text"]
    stats = base_statistics(docs.select(F.struct(*rest).alias("doc"), "text", "lang", "source")).drop("text")
    stats = stats.withColumn("base_failed", F.expr(BASE_FAILED))
    stats = materialise(stats.withColumns({f"x{i}": F.expr(v) for i, v in enumerate(VECTOR)}), "statistics")
    passed = stats.where("NOT base_failed").select("lang", "source", *[f"x{i}" for i in range(DIM)])
    groups = estimation_groups(passed)
    on = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    rows = materialise(passed.join(groups, on).select("grp", *[f"x{i}" for i in range(DIM)]), "vectors")
    estimate = minimum_covariance(rows)
    final = stats.join(groups, on, "left").join(estimate, "grp", "left")
    final = with_steps(final, distance_sql())
    return final.select(
        "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(~F.col("base_failed"), F.col("d2")).alias("distance"),
        (~F.col("base_failed") & (F.col("d2") <= F.lit(CUT))).alias("kept"),
    )


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return reject_outliers(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.coalesce("kept", F.lit(False)).alias("kept"),
    )


# ---- the same in DuckDB SQL -------------------------------------------------


def nested_sql(source: str, steps: list[tuple[str, str]]) -> str:
    for name, expr in steps:
        source = f"(SELECT *, {expr} AS {name} FROM {source})"
    return source


def oracle() -> str:
    est = ", ".join(ESTIMATE)
    sums = ", ".join(f"{e.replace('DECIMAL(18, 0)', 'HUGEINT')} AS {n}" for n, e in SUMS.items())
    med = ", ".join(f"quantile_cont(x{i}, 0.5) AS m{i}" for i in range(DIM))
    dev = ", ".join(f"quantile_cont(abs(x{i} - m{i}), 0.5) AS a{i}" for i in range(DIM))
    diag = [(f"c{i}{j}", f"(1.4826e0 * a{i}) * (1.4826e0 * a{i}) + {(FLOOR[i] * UNIT) ** 2!r}e0" if i == j else "0e0") for i, j in PAIRS]
    vector = ", ".join(f"{v} AS x{i}" for i, v in enumerate(VECTOR))
    parts = [
        r"""w AS (SELECT row_number() OVER () AS r, doc_id, lang, source,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM documents)""",
        """win AS (SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5))""",
        """rep AS (SELECT r, count(DISTINCT p) AS n FROM (
  SELECT win.r, unnest(generate_series(i, i + 4)) AS p FROM win
  JOIN (SELECT r, s FROM win GROUP BY 1, 2 HAVING count(*) > 1) d ON d.r = win.r AND d.s = win.s) GROUP BY 1)""",
        """b AS (SELECT w.r, doc_id, lang, source, len(w)::BIGINT AS n_words, array_to_string(w, '') AS j,
  (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.r = w.r)""",
        r"""st AS (SELECT * EXCLUDE (j), length(j)::BIGINT AS word_chars,
  (length(j) - length(regexp_replace(j, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (length(j) - length(regexp_replace(j, '[A-ZÀ-ÖØ-Þ]', '', 'g')))::BIGINT AS n_capitals,
  (length(j) - length(regexp_replace(j, '[.,!?;:]', '', 'g')))::BIGINT AS n_marks FROM b)""",
        f"v AS (SELECT *, ({BASE_FAILED}) AS base_failed, {vector} FROM st)",
        "cnt AS (SELECT lang, source, count(*) AS n FROM v WHERE NOT base_failed GROUP BY 1, 2)",
        f"sml AS (SELECT lang, sum(n) AS rest FROM cnt WHERE n < {MIN_ROWS} GROUP BY 1)",
        f"""grps AS (SELECT cnt.lang, cnt.source, CASE WHEN n >= {MIN_ROWS}
    THEN 'g' || chr(9) || coalesce('''' || cnt.lang, 'null') || chr(9) || coalesce('''' || cnt.source, 'null')
    WHEN rest >= {MIN_ROWS} THEN 'l' || chr(9) || coalesce('''' || cnt.lang, 'null') ELSE 'all' END AS grp
  FROM cnt LEFT JOIN sml ON cnt.lang IS NOT DISTINCT FROM sml.lang)""",
        """vg AS (SELECT v.*, grp FROM v LEFT JOIN grps
  ON v.lang IS NOT DISTINCT FROM grps.lang AND v.source IS NOT DISTINCT FROM grps.source)""",
        "x AS (SELECT grp, x0, x1, x2, x3 FROM vg WHERE NOT base_failed)",
        f"med AS (SELECT grp, {med} FROM x GROUP BY 1)",
        f"mad AS (SELECT x.grp, {dev} FROM x JOIN med ON x.grp = med.grp GROUP BY 1)",
        f"e0 AS (SELECT {est} FROM {nested_sql('(SELECT med.*, a0, a1, a2, a3 FROM med JOIN mad ON med.grp = mad.grp)', diag + cholesky_sql())})",
    ]

    def seen(e: str, rows: str = "x") -> str:
        return nested_sql(f"(SELECT {rows}.*, {e}.* EXCLUDE (grp) FROM {rows} LEFT JOIN {e} ON {rows}.grp = {e}.grp)", distance_sql())

    for k in range(STEPS):
        parts += [
            f"d{k} AS MATERIALIZED (SELECT grp, x0, x1, x2, x3, {BIN} AS bin FROM {seen(f'e{k}')})",
            f"h{k} AS (SELECT grp, bin, sum(count(*)) OVER (PARTITION BY grp ORDER BY bin) AS upto, "
            f"sum(count(*)) OVER (PARTITION BY grp) AS total FROM d{k} GROUP BY grp, bin)",
            f"t{k} AS (SELECT grp, min(bin) AS last FROM h{k} WHERE upto * 1000 >= total * {round(SUPPORT * 1000)} GROUP BY 1)",
            f"s{k} AS (SELECT d{k}.grp, {sums} FROM d{k} JOIN t{k} ON d{k}.grp = t{k}.grp WHERE bin <= last GROUP BY 1)",
            f"e{k + 1} AS MATERIALIZED (SELECT {est} FROM {nested_sql(f's{k}', scatter_sql(FACTOR_SUPPORT))})",
        ]
    parts += [
        f"sw AS (SELECT grp, {sums} FROM {seen(f'e{STEPS}')} WHERE d2 <= {CUT_WEIGHTED!r}e0 GROUP BY 1)",
        f"ew AS MATERIALIZED (SELECT {est} FROM {nested_sql('sw', scatter_sql(FACTOR_WEIGHTED))})",
    ]
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
        f"coalesce(NOT base_failed AND d2 <= {CUT!r}e0, false) AS kept FROM {seen('ew', 'vg')}"
    )


QUERIES = {"op2_robust_outliers": op2_robust_outliers}
ORACLES = {"op2_robust_outliers": oracle()}
