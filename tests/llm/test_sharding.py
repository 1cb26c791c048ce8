"""Bulk scheduling against a plain heap; groups, slots and balance."""

import heapq
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadwright.llm import op10_sharding as s


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 500), st.integers(1, 60), min_size=1, max_size=25), st.integers(1, 9))
def test_bulk_is_the_plain_heap(counts, shards):
    heap = [(0, x) for x in range(shards)]
    expected = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            load, x = heapq.heappop(heap)
            expected.append((size, x))
            heapq.heappush(heap, (load + size, x))
    got = []
    for size, first, cycle in s.lpt(list(counts.items()), shards):
        got += [(size, first[r] if r < len(first) else cycle[(r - len(first)) % shards]) for r in range(counts[size])]
    assert got == expected


def test_a_hot_group_leaves_the_plan_short():
    sizes, n, shards = [(4_000_000, 1), (100, 50_000), (60, 20_000), (7, 3)], 70_004, 40
    runs = s.turns(sizes, shards)
    assert sum(len(cycle) for *_, cycle in runs) <= len(sizes) * shards * 3
    heap, loads, k = [(0, x) for x in range(shards)], [0] * shards, 0
    for size, start, stop, cycle in runs:
        for r in range(start, stop):
            load, x = heapq.heappop(heap)
            assert cycle[(r - start) % len(cycle)] == x
            heapq.heappush(heap, (load + size, x))
            loads[x], k = load + size, k + 1
    assert k == n and max(loads[1:]) - min(loads[1:]) <= 100
    big = s.turns([(10**15, 1), (100, 10**11)], shards)
    assert sum(len(cycle) for *_, cycle in big) <= 2 * shards and big[-1][2] == 10**11


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 100_000), st.integers(1, 60), min_size=1, max_size=12), st.integers(1, 9))
def test_turns_are_the_plain_heap(counts, shards):
    heap, at = [(0, x) for x in range(shards)], {size: 0 for size in counts}
    for size, start, stop, cycle in s.turns(list(counts.items()), shards):
        assert start == at[size] and len(cycle) <= stop - start
        for r in range(start, stop):
            load, x = heapq.heappop(heap)
            assert cycle[(r - start) % len(cycle)] == x
            heapq.heappush(heap, (load + size, x))
        at[size] = stop
    assert at == counts


def test_rounding(spark):
    sizes = [1, 16, 4095, 4096, 4097, 123_456_789, 2**40 + 12345]
    df = spark.createDataFrame([(x,) for x in sizes], "n long")
    got = [r[0] for r in df.select(s.rounded(F.col("n"))).collect()]
    drop = [max(0, x.bit_length() - s.BITS) for x in sizes]
    assert got == [x >> d << d for x, d in zip(sizes, drop, strict=True)]


def test_query(spark, edge_dir):
    docs = {(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{edge_dir}/documents.parquet").collect()}
    rows = s.op10_lpt_shards(spark, edge_dir).collect()
    by_id = {i: t for i, t in docs}
    slots, shard_of, bytes_of, groups = defaultdict(list), {}, defaultdict(int), defaultdict(int)
    for r in rows:
        text = by_id[r["doc_id"]]
        data = (text or "").encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "bytes" and r["grown_shard"] is None
        assert shard_of.setdefault(text, r["shard"]) == r["shard"] and 0 <= r["shard"] < s.SHARDS
        slots[r["shard"]].append(r["slot"])
        bytes_of[r["shard"]] += r["size"]
        groups[text] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    # No shard outgrows the mean by more than its largest group (a bound of LPT).
    mean = sum(groups.values()) / s.SHARDS
    assert max(bytes_of.values()) <= max(max(groups.values()), mean * 1.34)


def test_stage_keeps_columns_and_replaces_its_own(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = s.shard_documents(docs)
    assert sorted(out.columns) == sorted(docs.columns) and dict(out.dtypes)["shard"] == "int"
    assert out.count() == docs.count()
