"""The audit opens only differing branches and finds what a full comparison finds."""

import hashlib

from pyspark.sql import functions as F

from loadwright.llm import op1_merkle as m


def replica(spark, n, changed=(), missing=(), extra=()):
    rows = [(0, i * 5000, 5000, hashlib.sha256(f"{i}{'x' if i in changed else ''}".encode()).hexdigest(), i) for i in range(n) if i not in missing]
    rows += [(1, i * 100, 100, "e" * 64, i) for i in extra]
    return spark.createDataFrame(rows, "file long, offset long, length long, digest string, record_id long")


def test_finds_changed_missing_and_extra(spark):
    a, b = replica(spark, 300), replica(spark, 300, changed=(17, 250), missing=(100,), extra=(4,))
    found = {(r["file"], r["record_id"], r["status"]) for r in m.audit(a, b, m.levels()).collect()}
    assert found == {(0, 17, "changed"), (0, 250, "changed"), (0, 100, "missing"), (1, 4, "extra")}


def test_equal_replicas_agree(spark):
    a = replica(spark, 300)
    assert m.audit(a, a, m.levels()).count() == 0


def test_only_differing_branches_are_opened(spark):
    a, b = replica(spark, 300), replica(spark, 300, changed=(17,))
    leaves = a.withColumn("replica", F.lit("a")).union(b.withColumn("replica", F.lit("b")))
    nodes = m.merkle_nodes(leaves, m.levels())
    opened = None
    for level in reversed(nodes):
        opened = m.differing(level, opened)
        assert [tuple(r) for r in opened.collect()] == [(0, 0 if level is not nodes[0] else 17 * 5000 // m.RANGE)]


def test_root_hash_by_hand(spark):
    a = replica(spark, 3)
    leaves = a.withColumn("replica", F.lit("a"))
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(3)]
    h = hashlib.sha256(",".join(f"{i * 5000}:5000:{d}" for i, d in enumerate(digests)).encode()).hexdigest()
    for _ in range(m.levels()):
        h = hashlib.sha256(f"0:{h}".encode()).hexdigest()
    assert m.merkle_nodes(leaves, m.levels())[-1].first()["hash"] == h


def test_each_record_at_one_offset_is_a_row(spark):
    ddl = "file long, offset long, length long, digest string, record_id long"
    at = [(0, 0, 10, "a" * 64, 1), (0, 0, 10, "b" * 64, 2), (0, 0, 10, "c" * 64, None), (0, 0, 10, "d" * 64, 4), (0, 0, 10, "d" * 64, 4)]
    other = [(0, 0, 10, "e" * 64, 1), (0, 0, 10, "f" * 64, 2), (0, 0, 10, "c" * 64, None), (0, 0, 10, "a" * 64, 5)]
    got = m.audit(spark.createDataFrame(at, ddl), spark.createDataFrame(other, ddl), m.levels())
    found = sorted((r["record_id"], r["status"], (r["digest_a"] or "-")[0], (r["digest_b"] or "-")[0]) for r in got.collect())
    assert found == [(1, "changed", "a", "e"), (2, "changed", "b", "f"), (4, "missing", "d", "-"), (4, "missing", "d", "-"), (5, "extra", "-", "a")]
