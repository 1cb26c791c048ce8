"""WARC: Merkle fixity audit of archive replicas.

Records lie at byte offsets of WARC files.  A leaf is a record's sha256; the
records that start in one range of ``RANGE`` bytes hash, in offset order,
into a node of level 0, and ``FANOUT`` neighbouring nodes hash into one of the
next level, up to one root a file.  Replicas are compared root by root;
below a root that differs only differing nodes are opened, level by level,
down to the byte ranges and in them the records that are changed, missing or
extra.  Where all roots agree nothing below them is read.

Ranges are fixed by offset, so a node gathers a bounded number of rows
(records have a header, so at most a few hundred start in a range; at most
``FANOUT`` children) and a damaged record touches one path.  The record bytes
are hashed where they are scanned; only hashes and offsets are shuffled.

Cases: a null or empty payload is a record without content; null ids and urls
are written empty; repeated rows are records each; records at the same
offset of a replica are hashed in the order of their digests, and each that
differs is a row, paired with one of the same id there; a record with another
id is a missing and an extra one; an empty
replica makes every record of the other one missing or extra; two empty ones
agree; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, ordered_sums, table

RANGE = 64 << 10
FANOUT = 16
FILE_BYTES = 16 << 20


def levels(file_bytes: int = FILE_BYTES) -> int:
    """Levels above the ranges until one node covers a file."""
    n, out = math.ceil(file_bytes / RANGE), 0
    while n > 1:
        n, out = math.ceil(n / FANOUT), out + 1
    return out


def warc_record(url: Column, payload: Column, record_id: Column) -> Column:
    """The bytes of a WARC 1.1 resource record."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def write_offsets(records: DataFrame, order: list[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """``records`` (with ``length``) plus ``file`` and ``offset``: written one
    after the other in the given order, a new file each ``file_bytes``."""
    placed = ordered_sums(records, [F.col(c) for c in order], {"at": "length"}, [], "offsets")
    placed = placed.withColumn("file", F.floor(F.col("at") / file_bytes).cast("long"))
    firsts = materialise(placed.groupBy("file").agg(F.min("at").alias("begin")), "files")
    return placed.join(firsts, "file").withColumn("offset", F.col("at") - F.col("begin")).drop("at", "begin")


def merkle_nodes(leaves: DataFrame, top: int) -> list[DataFrame]:
    """For leaves (replica, file, offset, length, digest), the nodes (replica,
    file, k, hash) of level 0 to ``top``, each level stored."""
    item = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "digest")
    level = (
        leaves.groupBy("replica", "file", F.floor(F.col("offset") / RANGE).cast("long").alias("k"))
        .agg(F.sort_array(F.collect_list(F.struct("offset", "digest", item.alias("item")))).alias("items"))
        .select("replica", "file", "k", F.sha2(F.concat_ws(",", F.col("items.item")), 256).alias("hash"))
    )
    out = [materialise(level, "level0")]
    for n in range(1, top + 1):
        level = (
            out[-1].groupBy("replica", "file", F.floor(F.col("k") / FANOUT).cast("long").alias("up"))
            .agg(F.sort_array(F.collect_list(F.struct("k", F.concat_ws(":", F.col("k").cast("string"), "hash").alias("item")))).alias("items"))
            .select("replica", "file", F.col("up").alias("k"), F.sha2(F.concat_ws(",", F.col("items.item")), 256).alias("hash"))
        )
        out.append(materialise(level, f"level{n}"))
    return out


def differing(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """(file, k) of the nodes whose hashes differ, below the differing parents."""
    if above is not None:
        up = above.select("file", F.col("k").alias("up"))
        nodes = nodes.withColumn("up", F.floor(F.col("k") / FANOUT).cast("long")).join(up, ["file", "up"], "left_semi")
    pair = nodes.groupBy("file", "k").agg(
        F.max(F.when(F.col("replica") == "a", F.col("hash"))).alias("a"), F.max(F.when(F.col("replica") == "b", F.col("hash"))).alias("b")
    )
    return pair.where("NOT (a <=> b)").select("file", "k")


def audit(left: DataFrame, right: DataFrame, top: int) -> DataFrame:
    """Records of two replicas (file, offset, length, digest, record_id) that
    differ: file, offset, record_id, status, digests and both roots."""
    cols = ["file", "offset", "length", "digest", "record_id"]
    leaves = left.select(F.lit("a").alias("replica"), *cols).union(right.select(F.lit("b").alias("replica"), *cols))
    leaves = materialise(leaves, "leaves")
    nodes = merkle_nodes(leaves, top)
    open_nodes = None
    for n in range(top, -1, -1):
        open_nodes = materialise(differing(nodes[n], open_nodes), f"open{n}")
    inside = leaves.withColumn("k", F.floor(F.col("offset") / RANGE).cast("long")).join(open_nodes, ["file", "k"], "left_semi")
    # Equal records of both sides cancel by count; what remains differs.
    both = inside.groupBy("file", "offset", "length", "digest", "record_id").agg(
        F.sum(F.when(F.col("replica") == "a", 1).otherwise(0)).alias("na"), F.sum(F.when(F.col("replica") == "b", 1).otherwise(0)).alias("nb")
    ).where("na <> nb")
    # One row a record that remains; those of one record_id at one offset pair up in order of their digests.
    left_over = both.select(
        "file", "offset", "record_id", "digest", (F.col("na") > F.col("nb")).alias("in_a"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.abs(F.col("na") - F.col("nb")))).alias("copy"),
    )
    nth = Window.partitionBy("file", "offset", "record_id", "in_a").orderBy("digest", "copy")
    bad = left_over.withColumn("nth", F.row_number().over(nth)).groupBy("file", "offset", "record_id", "nth").agg(
        F.max(F.when(F.col("in_a"), F.col("digest"))).alias("digest_a"), F.max(F.when(~F.col("in_a"), F.col("digest"))).alias("digest_b")
    )
    roots = nodes[top].groupBy("file").agg(
        F.max(F.when(F.col("replica") == "a", F.col("hash"))).alias("root_a"), F.max(F.when(F.col("replica") == "b", F.col("hash"))).alias("root_b")
    )
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return bad.join(roots, "file").select("file", "offset", "record_id", status.alias("status"), "digest_a", "digest_b", "root_a", "root_b")


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits two replicas of an archive of all pages.  The second replica's
    damage follows from the page_id: a first byte overwritten where it leaves
    13 modulo 97, a record lost at 7 modulo 101; the first one lacks 5 modulo 103."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    record = warc_record(F.col("url"), F.col("html"), F.col("page_id"))
    damaged = F.when(
        (F.col("page_id") % 97 == 13) & (F.length("html") > 0), F.concat(F.lit("?"), F.expr("substring(html, 2)"))
    ).otherwise(F.col("html"))
    other = warc_record(F.col("url"), damaged, F.col("page_id"))
    records = pages.select(
        F.col("page_id").alias("record_id"), F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"), F.sha2(other, 256).alias("digest_b"),
    )
    placed = materialise(write_offsets(records, ["record_id", "digest"]), "records")
    left = placed.where("coalesce(record_id % 103, 0) <> 5")
    right = placed.where("coalesce(record_id % 101, 0) <> 7").drop("digest").withColumnRenamed("digest_b", "digest")
    return audit(left, right, levels())


ORACLE = f"""
WITH p AS (
  SELECT page_id AS record_id, url, coalesce(html, '') AS html,
    CASE WHEN page_id % 97 = 13 AND length(html) > 0 THEN '?' || substr(html, 2) ELSE coalesce(html, '') END AS html_b FROM pages),
r AS (
  SELECT record_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:'
    || coalesce(CAST(record_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS h,
    html, html_b, repeat(chr(13) || chr(10), 2) AS e FROM p),
d AS (
  SELECT record_id, strlen(h || strlen(html) || e || html || e) AS length, sha256(h || strlen(html) || e || html || e) AS digest,
    sha256(h || strlen(html_b) || e || html_b || e) AS digest_b FROM r),
o AS (
  SELECT *, coalesce(sum(length) OVER (ORDER BY record_id NULLS FIRST, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM d),
f AS (SELECT *, pos // {FILE_BYTES} AS file, pos - min(pos) OVER (PARTITION BY pos // {FILE_BYTES}) AS "offset" FROM o),
l AS (
  SELECT 'a' AS replica, file, "offset", length, digest, record_id FROM f WHERE coalesce(record_id % 103, 0) <> 5
  UNION ALL SELECT 'b', file, "offset", length, digest_b, record_id FROM f WHERE coalesce(record_id % 101, 0) <> 7),
n0 AS (SELECT replica, file, "offset" // {RANGE} AS k, sha256(string_agg("offset" || ':' || length || ':' || digest, ',' ORDER BY "offset", digest)) AS hash FROM l GROUP BY 1, 2, 3),
n1 AS (SELECT replica, file, k // {FANOUT} AS k, sha256(string_agg(n0.k || ':' || hash, ',' ORDER BY n0.k)) AS hash FROM n0 GROUP BY 1, 2, n0.k // {FANOUT}),
n2 AS (SELECT replica, file, k // {FANOUT} AS k, sha256(string_agg(n1.k || ':' || hash, ',' ORDER BY n1.k)) AS hash FROM n1 GROUP BY 1, 2, n1.k // {FANOUT}),
roots AS (SELECT file, max(hash) FILTER (replica = 'a') AS root_a, max(hash) FILTER (replica = 'b') AS root_b FROM n2 GROUP BY 1),
x AS (SELECT file, "offset", coalesce(a.record_id, b.record_id) AS record_id, a.digest AS digest_a, b.digest AS digest_b
  FROM (SELECT * FROM l WHERE replica = 'a') a FULL JOIN (SELECT * FROM l WHERE replica = 'b') b USING (file, "offset")
  WHERE a.digest IS DISTINCT FROM b.digest)
SELECT file, "offset", record_id,
  CASE WHEN digest_b IS NULL THEN 'missing' WHEN digest_a IS NULL THEN 'extra' ELSE 'changed' END AS status,
  digest_a, digest_b, root_a, root_b FROM x JOIN roots USING (file)
"""

QUERIES = {"op1_merkle_fixity": op1_merkle_fixity}
ORACLES = {"op1_merkle_fixity": ORACLE}
