"""The kernel against its definition, held-out accuracy, and odd inputs."""

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from loadwright.llm import op7_toxicity as t


def kernel(x, y):
    """Common gapped subsequences of two words, by definition."""

    def subsequences(s):
        s, out = f"^{s}", {}
        for k in itertools.combinations(range(len(s)), 4):
            if all(b - a <= t.GAP for a, b in zip(k, k[1:], strict=False)):
                key = "".join(s[i] for i in k)
                out[key] = out.get(key, 0.0) + t.DECAY ** (k[-1] - k[0])
        return out

    a, b = subsequences(x), subsequences(y)
    return sum(v * b[k] for k, v in a.items() if k in b) / np.sqrt((len(x) + 3) * (len(y) + 3))


def test_table_lookup_is_the_kernel():
    feats, norm = t.phi([" idiot"])
    table = np.zeros(t.CLASSES**4)
    for code, v in feats[0].items():
        table[code] = v / norm[0]
    for word in ("idiot", "idxiot", "idot", "hello", "i", "idiotidiot"):
        assert abs(t.margins(word, table)[0] - kernel(word, "idiot")) < 1e-9
    near = t.margins("idiot", table)[0]
    assert t.margins("you i.d.i.o.t!", table)[0] == near and t.margins("i d i o t", table)[0] == near


def test_windows_are_words_pairs_and_halves():
    def read(word):
        return t.read_back(t.units_of(f" {word}")[0])

    def windows(text):
        cls, window, n, total = t.windows_of(" " + text)
        assert (np.diff(window) >= 0).all() and len(window) == len(cls)
        return n, [t.read_back(cls[window == i]) for i in range(total)]

    assert windows("you are an id iot. Not") == (6, ["you", "are", "an", "id", "iot", "not", "youare", "arean", "anid", "idiot"])
    assert windows("a b\nc d") == (2, ["ab", "cd", "b", "d"])
    assert windows("ixdxixoxt") == (1, ["ixdxixoxt", "idiot"])
    assert windows("i\u200bd\u00b7i-o*t \u00e9t\u00e9") == (2, ["idiot", read("été"), read("idiotété")])
    assert windows("") == (0, []) and windows(" \n ") == (0, []) and windows("... !!") == (2, ["", ""])


def test_read_back_keeps_classes():
    for c in range(1, t.START):
        assert t.units_of(f" {t.read_back(np.array([c]))}")[0].tolist() == [t.START, c]


def test_inserted_characters_and_spaces_are_tolerated():
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(1500)]
    insults = ["idiot", "trash", "clown", "moron", "stupid", "pathetic"]

    def text(toxic):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 60))]
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(insults))
        return " ".join(words)

    toxic = np.array([i % 4 == 0 for i in range(800)])
    model = t.train([text(x) for x in toxic], toxic, np.arange(800) % 3 == 0, 0.25)
    for w in insults:
        forms = [w, w.upper(), *[s.join(w) for s in ("x", "\u200b", "\u00b7", ".", " ", "-")], f"{w[:2]} {w[2:]}", f"{w[:3]} {w[3:]}"]
        for form in forms:
            assert t.score(f"{text(False)} {form} {text(False)}", model) >= t.THRESHOLD, form
    clean = [t.score(text(False), model) >= t.THRESHOLD for _ in range(300)]
    found = [t.score(text(True), model) >= t.THRESHOLD for _ in range(300)]
    assert np.mean(clean) <= 0.05 and np.mean(found) >= 0.95


def test_long_texts_are_scored_whole(monkeypatch):
    feats, _ = t.phi([" idiot"])
    table = np.zeros(t.CLASSES**4)
    table[list(feats[0])] = 1
    text = "good words here " * 500 + "idiot"
    whole = t.margins(text, table)
    monkeypatch.setattr(t, "PIECE", 100)
    assert t.margins(text, table) == whole and whole[0] == t.margins("idiot", table)[0]


def test_held_out_accuracy(spark, edge_dir):
    rows = t.op7_toxicity(spark, edge_dir)
    truth = spark.read.parquet(f"{edge_dir}/labels.parquet").where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    got = rows.join(truth, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) >= 20 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) >= 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= t.THRESHOLD) for r in rows.collect())


def test_labels_of_held_out_rows_are_not_used(spark, edge_dir):
    docs, labels = (spark.read.parquet(f"{edge_dir}/{n}.parquet") for n in ("documents", "labels"))
    changed = labels.withColumn("toxic", F.when(t.remainder(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = t.fit_model(docs, labels), t.fit_model(docs, changed)
    assert np.array_equal(a["weights"], b["weights"]) and np.array_equal(a["logit"], b["logit"])


def test_one_class_or_no_labels(spark, edge_dir):
    docs, labels = (spark.read.parquet(f"{edge_dir}/{n}.parquet") for n in ("documents", "labels"))
    none = t.fit_model(docs, labels.where("false"))
    one = t.fit_model(docs, labels.where("toxic = 0"))
    assert t.score("anything", none) == 0.0 and t.score(None, one) == 0.0
