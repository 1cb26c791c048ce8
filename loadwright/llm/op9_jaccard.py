"""N-gram Jaccard join with Bayesian candidate pruning.

Links two documents whose sets of 5-word shingles have a Jaccard similarity
of ``THRESHOLD`` (0.8) or more.

1. Documents with the same word sequence collapse to one node with a count.
2. Each node gets ``HASHES`` MinHash values; nodes that agree on all ``ROWS``
   values of one of the bands share a bucket (a pair at 0.8 shares none with
   probability (1 - 0.8^4)^24 = 3e-6).
3. Inside a bucket, MinHash values are compared ``STEP`` at a time; a pair is
   dropped once the posterior probability (uniform prior) that its similarity
   reaches the threshold is below ``TOLERANCE``.  Only a spanning forest of
   the surviving pairs leaves the task: at most one edge per member.
4. The forests' components hold every surviving pair; inside each, pairs that
   survive the same pruning are verified exactly on their whole shingle sets.
   Each node's number of links and another spanning forest leave the task.
5. Components of the verified forest are the classes.

A bucket or component of any size is cut into blocks of about ``BLOCK`` nodes
(fewer when texts are long) and each pair of blocks is one unit of work, so no
task holds a whole group, no pair is skipped and no pair is written out.

Words are runs without the six ASCII white-space characters, as written.

Cases: a null text or one without words has no shingles: a class of its own
without links, even if there are several; a text of 1 to 4 words is one
shingle; texts with the same words (exact copies, or white space apart) are
linked; repeated rows count as copies; a class is named by its least doc_id,
null if it has none; empty input gives an empty result; other columns,
whatever their names, are carried in a struct and returned untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, materialise, small_batches, table
from .textnp import mix, shingles, word_hashes

THRESHOLD = 0.8
SHINGLE = 5
BANDS = 24
ROWS = 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 400
BLOCK_CHARS = 8 << 20

_A = (mix(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(1001, HASHES + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def minhash(s: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of multiply-add hashes over a set of shingle hashes."""
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 4096):
        h = _A[:, None] * x[None, i : i + 4096] + _B[:, None]
        # The high bits of a product depend on all bits; mix them downwards.
        h ^= h >> np.uint32(15)
        low = np.minimum(low, h.min(axis=1))
    return low


def band_hashes(sig: np.ndarray) -> np.ndarray:
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig.reshape(BANDS, ROWS)[:, r].astype(np.uint64))
    return h.view(np.int64)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After n = STEP, 2 STEP.. compared values, the fewest matches at which
    P(similarity >= threshold) is still at least the tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper
    tail at t is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out.append(m)
                break
    return out


def surviving_pairs(left: np.ndarray, right: np.ndarray, same: bool, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose MinHash values pass every step (``same``: i < j)."""
    matches = np.zeros((len(left), len(right)), dtype=np.uint8)
    for c in range(STEP):
        matches += left[:, c][:, None] == right[:, c][None, :]
    alive = matches >= least[0]
    if same:
        alive &= np.triu(np.ones(alive.shape, dtype=bool), 1)
    i, j = np.nonzero(alive)
    count = matches[i, j].astype(np.int32)
    for k, need in enumerate(least[1:], 1):
        if not len(i):
            break
        step = slice(k * STEP, (k + 1) * STEP)
        for p in range(0, len(i), 1 << 18):
            part = slice(p, p + (1 << 18))
            count[part] += (left[i[part], step] == right[j[part], step]).sum(axis=1)
        keep = count >= need
        i, j, count = i[keep], j[keep], count[keep]
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n items the least item of its component."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root, new.copy())
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def verified(i: np.ndarray, j: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], t: float) -> np.ndarray:
    """Which pairs of shingle sets (sorted, distinct) reach the similarity."""
    ok = np.zeros(len(i), dtype=bool)
    if not len(i):
        return ok
    if len(i) > 4 * (len(left) + len(right)):
        # Dense: all intersections by matrix product over slices of the vocabulary.
        vocab, at = np.unique(np.concatenate([*left, *right]), return_inverse=True)
        rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
        order = np.argsort(at, kind="stable")
        at, rows = at[order], rows[order]
        shared = np.zeros((len(left), len(right)), dtype=np.float64)
        for c in range(0, len(vocab), 4096):
            lo, hi = np.searchsorted(at, [c, c + 4096])
            grid = np.zeros((len(left) + len(right), min(4096, len(vocab) - c)), dtype=np.float32)
            grid[rows[lo:hi], at[lo:hi] - c] = 1
            shared += grid[: len(left)] @ grid[len(left) :].T
        inter = np.rint(shared[i, j]).astype(np.int64)
    else:
        inter = np.empty(len(i), dtype=np.int64)
        for p, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            x, y = left[a], right[b]
            if len(x) > len(y):
                x, y = y, x
            inter[p] = (y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()
    sizes = np.array([len(s) for s in left])[i] + np.array([len(s) for s in right])[j] - inter
    return inter >= t * sizes - 1e-9


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal keys, from sorted batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        k = batch[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        parts = np.split(np.arange(len(batch)), cuts)
        for p, part in enumerate(parts):
            rows = batch.iloc[part[0] : part[-1] + 1]
            if held and (p > 0 or (held[-1][keys].iloc[0].to_numpy() != k[0]).any()):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(rows)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def fingerprints(docs: DataFrame) -> DataFrame:
    """One stored row per document: rid, doc (all columns), key, sig, bands."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("key string, sig binary, bands array<long>")
    def prints(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            words = word_hashes(t)
            if not len(words):
                rows.append((None, None, None))
                continue
            sig = minhash(shingles(words, SHINGLE))
            rows.append((
                hashlib.md5(" ".join(split(t)).encode("utf-8", "surrogatepass")).hexdigest(),
                (sig & np.uint32(0xFFFF)).astype(np.uint16).tobytes(),
                band_hashes(sig),
            ))
        return pd.DataFrame(rows, columns=["key", "sig", "bands"])

    out = docs.select(F.struct("*").alias("doc"), prints(F.col("text")).alias("p"))
    return materialise(
        out.select(F.monotonically_increasing_id().alias("rid"), "doc", "p.key", "p.sig", "p.bands"), "prints"
    )


def split(text: str) -> list[str]:
    return [w for w in text.translate(_TO_SPACE).split(" ") if w]


_TO_SPACE = {c: " " for c in (9, 10, 11, 12, 13)}


def block_pairs(members: DataFrame, key: str, blocks: Column, node: str) -> DataFrame:
    """Each member of a group once for every pair of blocks it belongs to."""
    own = F.pmod(F.xxhash64(node, key), F.col("n_blocks"))
    return (
        members.withColumn("n_blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("bi", F.least("own", "other"))
        .withColumn("bj", F.greatest("own", "other"))
        .drop("other", "n_blocks")
    )


def candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """Spanning forests (a, b) of the pairs that survive in some bucket."""
    bands = nodes.select("node", F.explode("bands").alias("h"))
    shared = bands.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    members = block_pairs(bands.join(shared, "h"), "h", F.ceil(F.col("n") / BLOCK).cast("long"), "node").drop("n")
    work = members.join(nodes.select("node", "sig"), "node")
    work = work.repartition("h", "bi", "bj").sortWithinPartitions("h", "bi", "bj", "node")
    least = least_matches(threshold, TOLERANCE)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups(batches, ["h", "bi", "bj"]):
            if len(g) < 2:
                continue
            node = g["node"].to_numpy()
            sig = np.frombuffer(b"".join(g["sig"]), dtype=np.uint16).reshape(len(g), HASHES)
            i, j = split_pairs(g, sig, least)
            root = forest(len(g), i, j)
            out = np.flatnonzero(root != np.arange(len(g)))
            if len(out):
                yield pd.DataFrame({"a": node[out], "b": node[root[out]]})

    cols = ["h", "bi", "bj", "own", "node", "sig"]
    return work.select(*cols).mapInPandas(compare, "a long, b long")


def split_pairs(g: pd.DataFrame, sig: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Surviving pairs of one unit of work: within a block, or across two."""
    bi, bj = int(g["bi"].iloc[0]), int(g["bj"].iloc[0])
    if bi == bj:
        return surviving_pairs(sig, sig, True, least)
    own = g["own"].to_numpy()
    x, y = np.flatnonzero(own == bi), np.flatnonzero(own == bj)
    if not len(x) or not len(y):
        return x[:0], y[:0]
    i, j = surviving_pairs(sig[x], sig[y], False, least)
    return x[i], y[j]


def verified_links(clusters: DataFrame, prints: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Of each unit of work: (a, b, links): a node, its root, linked copies."""
    rows = (
        clusters.join(nodes.select("node", "copies", "sig"), "node")
        .join(prints.select(F.col("rid").alias("node"), F.col("doc.text").alias("text")), "node")
    )
    rows = materialise(rows, "clusters")
    sizes = rows.groupBy("comp").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("chars") / BLOCK_CHARS)).cast("long")
    work = block_pairs(rows.join(sizes, "comp"), "comp", blocks, "node").drop("n", "chars")
    work = work.repartition("comp", "bi", "bj").sortWithinPartitions("comp", "bi", "bj", "node")
    least = least_matches(threshold, TOLERANCE)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups(batches, ["comp", "bi", "bj"]):
            if len(g) < 2:
                continue
            node, copies = g["node"].to_numpy(), g["copies"].to_numpy()
            sig = np.frombuffer(b"".join(g["sig"]), dtype=np.uint16).reshape(len(g), HASHES)
            i, j = split_pairs(g, sig, least)
            used = np.unique(np.concatenate([i, j]))
            sets: list[np.ndarray] = [np.empty(0, dtype=np.uint64)] * len(g)
            for u in used.tolist():
                sets[u] = np.unique(shingles(word_hashes(g["text"].iloc[u]), SHINGLE))
            # Only the rows that take part, renumbered for either side.
            x, xi = np.unique(i, return_inverse=True)
            y, yj = np.unique(j, return_inverse=True)
            ok = verified(xi, yj, [sets[u] for u in x], [sets[u] for u in y], threshold)
            i, j = i[ok], j[ok]
            links = np.zeros(len(g), dtype=np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = forest(len(g), i, j)
            out = np.flatnonzero(links > 0)
            if len(out):
                yield pd.DataFrame({"a": node[out], "b": node[root[out]], "links": links[out]})

    cols = ["comp", "bi", "bj", "own", "node", "copies", "sig", "text"]
    return work.select(*cols).mapInPandas(verify, "a long, b long, links long")


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: rid, doc (a struct of its columns), class_id (the least
    doc_id of the class), first (whether the row stands for its class: least
    doc_id, then first row), n_copies (rows with the same words), n_links
    (other rows at the threshold or above, copies included)."""
    prints = fingerprints(docs)
    nodes = materialise(
        prints.where("key IS NOT NULL").groupBy("key").agg(
            F.min("rid").alias("node"), F.count("*").alias("copies"),
            F.min(F.col("doc.doc_id")).alias("least_id"), F.first("sig").alias("sig"), F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    edges = materialise(candidate_edges(nodes, threshold).distinct(), "candidates")
    clusters = components(edges, "candidates")
    links = materialise(verified_links(clusters, prints, nodes, threshold), "links")
    classes = components(links.select("a", "b"), "classes")
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    info = (
        nodes.select("key", "node", "copies", "least_id")
        .join(classes, "node", "left").join(counts, "node", "left")
        .select("key", "copies", "least_id", F.coalesce("comp", "node").alias("comp"),
                F.coalesce("links", F.lit(0)).alias("links"), "node")
    )
    info = materialise(info, "info")
    # The first row of each class: least doc_id (nulls last), then least rid.
    rank = F.struct(F.col("doc.doc_id").isNull().alias("n"), F.col("doc.doc_id").alias("d"), F.col("rid").alias("r"))
    slim = prints.select("rid", "key", rank.alias("rank"))
    firsts = slim.where("key IS NOT NULL").groupBy("key").agg(F.min("rank").alias("rank"))
    named = info.join(firsts, "key").groupBy("comp").agg(F.min("rank").alias("top"))
    info = materialise(info.join(named, "comp"), "classed")
    return (
        prints.select("rid", "doc", "key").join(info, "key", "left")
        .select(
            "rid", "doc",
            F.when(F.col("key").isNull(), F.col("doc.doc_id")).otherwise(F.col("top.d")).alias("class_id"),
            (F.col("key").isNull() | (F.col("top.r") == F.col("rid"))).alias("first"),
            F.coalesce("copies", F.lit(1)).alias("n_copies"),
            F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
        )
    )


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class of linked documents."""
    kept = jaccard_join(docs, threshold).where("first")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join(docs).select(F.col("doc.doc_id").alias("doc_id"), "class_id", "n_copies", "n_links")


# Exact at the small scale: all pairs that share a shingle, then components.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
n AS (
  SELECT array_to_string(w, ' ') AS k, any_value(w) AS w, min(r) AS node, count(*) AS copies, min(doc_id) AS least_id
  FROM d WHERE len(w) > 0 GROUP BY 1),
s AS (
  SELECT DISTINCT node, array_to_string(list_slice(w, i, i + 4), ' ') AS sh
  FROM (SELECT node, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM n)),
c AS (SELECT node, count(*) AS sz FROM s GROUP BY 1),
p AS (SELECT x.node AS a, y.node AS b, count(*) AS m FROM s x JOIN s y ON x.sh = y.sh AND x.node <> y.node GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN c ca ON ca.node = p.a JOIN c cb ON cb.node = p.b
      WHERE 10 * p.m >= 8 * (ca.sz + cb.sz - p.m)),
reach(a, b) AS (SELECT node, node FROM n UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
cls AS (SELECT reach.a AS node, min(n.least_id) AS class_id FROM reach JOIN n ON n.node = reach.b GROUP BY 1),
lk AS (SELECT e.a AS node, sum(n.copies) AS links FROM e JOIN n ON n.node = e.b GROUP BY 1)
SELECT d.doc_id, CASE WHEN n.node IS NULL THEN d.doc_id ELSE cls.class_id END AS class_id,
  CAST(coalesce(n.copies, 1) AS BIGINT) AS n_copies,
  CAST(coalesce(n.copies - 1 + coalesce(lk.links, 0), 0) AS BIGINT) AS n_links
FROM d LEFT JOIN n ON n.k = array_to_string(d.w, ' ') AND len(d.w) > 0
LEFT JOIN cls ON cls.node = n.node LEFT JOIN lk ON lk.node = n.node
"""

QUERIES = {"op9_ngram_jaccard_join": op9_ngram_jaccard_join}
ORACLES = {"op9_ngram_jaccard_join": ORACLE}
