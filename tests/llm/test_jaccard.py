"""Parts of the join against brute force; blocks of any size give the same."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from loadwright.llm import op9_jaccard as j
from loadwright.llm import textnp


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t ", max_size=60), st.integers(1, 20))
def test_word_hashes(text, piece):
    words = [w for w in j.split(text)]
    whole = textnp.word_hashes(text)
    assert len(whole) == len(words)
    assert all((words[a] == words[b]) == (whole[a] == whole[b]) for a in range(len(words)) for b in range(a))
    old, textnp.PIECE = textnp.PIECE, piece
    try:
        assert np.array_equal(textnp.word_hashes(text), whole)
    finally:
        textnp.PIECE = old


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(2)
    s = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for overlap in (0.3, 0.6, 0.9):
        k = int(1000 * overlap)
        a, b = s[:1000], s[1000 - k : 2000 - k]
        est = np.mean([(j.minhash(textnp.mix(a + np.uint64(i))) == j.minhash(textnp.mix(b + np.uint64(i)))).mean() for i in range(10)])
        assert abs(est - k / (2000 - k)) < 0.05


def test_pruning_bound():
    least = j.least_matches(0.8, 1e-6)
    assert least == sorted(least) and least[-1] < 0.8 * j.HASHES
    rng = np.random.default_rng(0)
    kept = (np.cumsum(rng.random((20_000, j.HASHES)) < 0.8, axis=1)[:, j.STEP - 1 :: j.STEP] >= least).all(axis=1).mean()
    assert kept > 0.999


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=2, max_size=8), st.sampled_from([0.3, 0.5, 0.8]))
def test_verified(sets, t):
    arrays = [np.array(sorted(x), dtype=np.uint64) for x in sets]
    i, k = np.triu_indices(len(sets), 1)
    expected = [len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9 for a, b in zip(i, k, strict=True)]
    assert j.verified(i, k, arrays, arrays, t).tolist() == expected
    many = np.tile(i, 50), np.tile(k, 50)  # the dense way
    assert j.verified(*many, arrays, arrays, t).tolist() == expected * 50


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 12), st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=15))
def test_forest(n, pairs):
    pairs = [(a % n, b % n) for a, b in pairs]
    root = j.forest(n, np.array([a for a, _ in pairs], dtype=int), np.array([b for _, b in pairs], dtype=int))
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert root.tolist() == label


def test_small_blocks_give_the_same(spark, edge_dir, monkeypatch):
    whole = sorted(map(str, j.op9_ngram_jaccard_join(spark, edge_dir).collect()))
    monkeypatch.setattr(j, "BLOCK", 2)
    assert sorted(map(str, j.op9_ngram_jaccard_join(spark, edge_dir).collect())) == whole


def test_one_of_each_class_stays(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = j.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    classes = j.jaccard_join(docs)
    assert kept.count() == classes.where("first").count()
    groups = classes.where("n_copies > 0").selectExpr("class_id", "doc.text IS NULL OR trim(doc.text) = '' AS bare", "first").collect()
    assert len({g["class_id"] for g in groups if not g["bare"] and g["class_id"] is not None}) == len([g for g in groups if g["first"] and not g["bare"] and g["class_id"] is not None])
    near = {r["class_id"] for r in classes.where("doc.doc_id BETWEEN 200 AND 270").collect()}
    assert near == {200}
