"""Exact top-k inner-product search by Fagin's threshold algorithm.

Vectors are quantised to integers.  Candidates are dealt to blocks by a hash
of their row, queries to groups; every (block, group) pair is one bounded unit
of work, so tasks number blocks times groups and none holds more than a block.

In a block each dimension has a sorted list.  A query reads its lists from the
end that its weight favours (a weight of 0 needs no list), in rounds of
doubling depth: rows seen for the first time are scored in full, and the
threshold is the score of a row that has the last value read in every list.
No unseen row can score more, so the query stops once the threshold is below
its k-th score (at an equal one an unseen row could still win the tie by a
smaller id).  Each block gives at most k rows a query, which are ranked over
all blocks at the end.

How deep a query reads depends on the vectors: few rows where some dimensions
dominate, close to the whole block for directions spread evenly over many
dimensions (then it costs what scoring every row costs).

Cases: vectors that are null or hold a null or non-finite component take no
part; a shorter vector counts as padded with zeros (an empty one scores 0); a
null id never is a query and loses every tie; rows that share an id or repeat
are separate candidates, a row only never meets itself; fewer candidates than
k give fewer rows; an empty table gives an empty result; sums are exact
integers (floats only where they are exact, below 2^53), a score beyond 64
bits fails the query; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

TOP = 5
BLOCK = 8192  # candidates of a block, on average
GROUP = 1024  # queries of a group, on average
FIRST_DEPTH = 32
SCALE = 256
EVERY = 50  # queries: ids divisible by it


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``id``, ``v`` (floor(scale * x) of every component) of the usable rows."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), dtype=np.int64)
    at = 0
    for chunk in lists.chunks:
        sizes = np.diff(chunk.offsets.to_numpy())
        flat = chunk.flatten().to_numpy(zero_copy_only=False)
        if len(sizes) and (sizes == width).all():
            out[at : at + len(sizes)] = flat.reshape(len(sizes), width)
        else:
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else []
            for i, (s, n) in enumerate(zip(starts, sizes)):
                out[at + i, :n] = flat[s : s + n]
        at += len(sizes)
    return out


def _width(lists: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max(initial=0)) for c in lists.chunks), default=0)


def _exact(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the cheapest type whose sums of products are exact."""

    def largest(m):
        return max(abs(int(m.min(initial=0))), abs(int(m.max(initial=0))))

    bound = largest(rows) * largest(queries) * max(rows.shape[1], 1)
    kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
    return rows.astype(kind), queries.astype(kind)


class Lists:
    """Sorted per-dimension lists of a block, and the search over them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, rids: np.ndarray):
        # Best id first among equal scores: a stable sort keeps this order.
        best = np.lexsort((rids, ids))
        self.rows, self.ids, self.rids = rows[best], ids[best], rids[best]
        self.rising = np.argsort(self.rows, axis=0, kind="stable")
        self.accesses = 0  # rows scored, over all queries

    def top(self, query: np.ndarray, own: int, k: int) -> list[int]:
        """Indices of the k best rows for ``query`` but the row ``own``."""
        n = len(self.rows)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = self.rids == own
        found, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=self.rows.dtype)
        start, depth = 0, min(FIRST_DEPTH, n)
        while True:
            new = np.zeros(n, dtype=bool)
            if len(up) or len(down):
                new[self.rising[n - depth : n - start, up]] = True
                new[self.rising[start:depth, down]] = True
            else:
                new[start:depth] = True  # every score is 0: ids decide, in order
            new &= ~seen
            seen |= new
            fresh = np.flatnonzero(new)
            self.accesses += len(fresh)
            found = np.concatenate((found, fresh))
            scores = np.concatenate((scores, self.rows[fresh] @ query))
            if len(found) > k:
                keep = np.lexsort((found, -scores))[:k]
                found, scores = found[keep], scores[keep]
            if depth == n:
                return found[np.lexsort((found, -scores))].tolist()
            if len(found) == k:
                last = np.zeros(len(query), dtype=self.rows.dtype)
                last[up] = self.rows[self.rising[n - depth, up], up]
                last[down] = self.rows[self.rising[depth - 1, down], down]
                if (last @ query if len(up) or len(down) else -1) < scores.min():
                    return found[np.lexsort((found, -scores))].tolist()
            start, depth = depth, min(2 * depth, n)


_LAST_ID = (1 << 63) - 1


def _search(k: int):
    schema = pa.schema([
        ("q_rid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("rid", pa.int64()), ("score", pa.int64()),
    ])

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(block) and len(queries):
            width = max(_width(block.column("v")), _width(queries.column("v")))
            rows, wanted = _exact(_matrix(block.column("v"), width), _matrix(queries.column("v"), width))
            ids = block.column("id")
            has_id = np.array(ids.is_valid())
            lists = Lists(rows, np.array(ids.fill_null(_LAST_ID)), np.array(block.column("rid")))
            null_rids = set(np.array(block.column("rid"))[~has_id].tolist())
            for q, q_rid, q_id in zip(wanted, queries.column("q_rid").to_pylist(), queries.column("q_id").to_pylist()):
                for i in lists.top(q, q_rid, k):
                    rid = int(lists.rids[i])
                    out.append((q_rid, q_id, None if rid in null_rids else int(lists.ids[i]), rid, int(lists.rows[i] @ q)))
        columns = list(zip(*out)) if out else [[] for _ in schema]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def top_k(vectors: DataFrame, is_query, k: int = TOP, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows for each query.

    ``vectors`` has ``id`` and ``v`` (long components); ``is_query`` is a
    condition on them.
    """
    rows = materialise(vectors.withColumn("rid", F.monotonically_increasing_id()).withColumn("asks", F.coalesce(is_query, F.lit(False))), "vectors")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, groups = max(1, -(-n // block)), max(1, -(-asked // group))
    place = F.xxhash64("rid")
    dealt = rows.select("id", "rid", "v", F.pmod(place, F.lit(blocks)).alias("block")).withColumn(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    asking = rows.where("asks").select(
        F.col("id").alias("q_id"), F.col("rid").alias("q_rid"), "v", F.pmod(place, F.lit(groups)).cast("int").alias("grp")
    ).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # One unit of work is seconds of CPU over a few MB: as many partitions as
    # units, not as many as their bytes ask for.
    parts = min(blocks * groups, 100_000)
    found = (
        dealt.repartition(parts, "block", "grp").groupBy("block", "grp")
        .cogroup(asking.repartition(parts, "block", "grp").groupBy("block", "grp"))
        .applyInArrow(_search(k), "q_rid long, query_id long, vec_id long, rid long, score long")
    )
    order = Window.partitionBy("q_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, F.col("id") % EVERY == 0)


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.rid AS q_rid, q.vec_id AS query_id, c.vec_id, c.rid,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.rid <> c.rid),
r AS (
  SELECT *, row_number() OVER (PARTITION BY q_rid ORDER BY score DESC, vec_id NULLS LAST, rid) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {TOP}
"""

QUERIES = {"op12_topk_search": op12_topk_search}
ORACLES = {"op12_topk_search": ORACLE}
