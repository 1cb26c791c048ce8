"""Hits against a plain search; blocks, span removal and stages' columns."""

import random
import re
import tracemalloc

from hypothesis import given, settings
from hypothesis import strategies as st

from loadwright.llm import op5_decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(text, items, n):
    w, hit, found = WORD.findall(lower(text)), set(), set()
    for item, t in items:
        b = WORD.findall(lower(t))
        k = min(n, len(b))
        for win in {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else ():
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) == win:
                    hit |= set(range(i, i + k))
                    found.add(item)
    return len(w), sorted(hit), found


TEXT = st.lists(st.sampled_from(["a", "B", "ç", "x1", "a.", "É", "--", "b"]), max_size=14).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(TEXT, max_size=4))
def test_scan_like_brute_force(text, items):
    pairs = list(enumerate(items))
    hit, found = d.scan(text, d.index_items(pairs, 3))
    assert (len(hit), [i for i, h in enumerate(hit) if h], found) == brute(text, pairs, 3)


def test_the_index_is_small():
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(2000)}" for _ in range(500))) for i in range(100)]
    tracemalloc.start()
    index = d.index_items(items, 10)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert sum(len(h) for h, _ in index["windows"].values()) == 100 * 491
    assert held < 40 * 100 * 491
    hit, found = d.scan(f"new {items[7][1]} words", index)
    assert hit.sum() == 500 and found == {7}


def test_blocks_give_the_same(spark, edge_dir):
    docs, bench = (spark.read.parquet(f"{edge_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    cols = ["doc_id", "hits.n_words", "hits.n_hit", "hits.items"]
    one = d.scan_documents(docs, bench).select(*cols).collect()
    many = d.scan_documents(docs, bench, block_bytes=20).select(*cols).collect()
    assert sorted(map(str, one)) == sorted(map(str, many)) and any(r["n_hit"] for r in one)


def test_removal(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x Alpha, BETA gamma! y", "h"), (2, "clean", "h"), (3, None, "h"), (4, "a delta b", "h")], "doc_id long, text string, hits string"
    )
    kept = d.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    cut = {r["doc_id"]: r["text"] for r in d.decontaminate(docs, bench, remove="spans").collect()}
    assert cut == {1: "x ! y", 2: "clean", 3: None, 4: "a  b"}
