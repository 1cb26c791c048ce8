"""Recurring templates go, other lines stay; chunks and blocks change nothing."""

import random

from loadwright.llm import op6_templates as t

_RNG = random.Random(1)
VOCAB = ["".join(_RNG.choice("klmnopqr") for _ in range(6)) for _ in range(500)]


def corpus(n=60):
    rng = random.Random(5)
    docs = []
    for i in range(n):
        body = " ".join(rng.choice(VOCAB) for _ in range(12))
        lines = [f"login of user {rng.choice(VOCAB)} from host {i} today", body]
        if i % 3 == 0:
            lines.append("All rights reserved by the maker")
        if i == 0:
            lines += ["A line found once in a document", "", "  "]
        docs.append((i, "\n".join(lines)))
    return [*docs, (100, None), (101, ""), (102, "one two"), (103, "x " * 50_000)], [d.split("\n")[1] for _, d in docs]


def test_drops_templates_only(spark):
    rows, bodies = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc"]["doc_id"]: r for r in t.drop_recurring_lines(df).collect()}
    for i, body in enumerate(bodies):
        rest = [body] if i else [body, "A line found once in a document", "", "  "]
        assert got[i]["kept"] == "\n".join(rest) and got[i]["n_dropped"] == 1 + (i % 3 == 0)
    assert got[100]["kept"] is None and got[101]["kept"] == "" and got[102]["kept"] == "one two"
    assert got[103]["n_lines"] == 1 and got[103]["n_dropped"] == 0


def test_small_chunks_and_blocks_give_the_same(spark, monkeypatch):
    rows, _ = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(r["line"] for r in t.recurring_lines(df).collect())
    monkeypatch.setattr(t, "CHUNK", 4)
    monkeypatch.setattr(t, "BLOCK", 3)
    monkeypatch.setattr(t, "SENT", 7)
    assert sorted(r["line"] for r in t.recurring_lines(df).collect()) == whole and len(whole) > 50


def test_a_loose_component_keeps_its_recurring_parts(spark, monkeypatch):
    # B is like A, and A like C, but all three agree at 4 of 10 places only.
    a = "p q a b c d e f g h"
    b = "p q a b c d e x y z"
    c = "p q u v w d e f g h"
    assert t.similar(a.split(), b.split()) and t.similar(a.split(), c.split()) and not t.similar(b.split(), c.split())
    rows = [(i, f"{a}\nown line {VOCAB[i]} of {VOCAB[i + 50]}") for i in range(40)] + [(50 + i, x) for i, x in enumerate((b, c, "p q k l m n o r s t"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (500, 0.001):  # the second: each line a chunk of its own
        monkeypatch.setattr(t, "CHUNK", chunk)
        got = {r["doc"]["doc_id"]: r["kept"] for r in t.drop_recurring_lines(df).collect()}
        assert all(a not in got[i] for i in range(40))
        assert got[52] == "p q k l m n o r s t"


def test_regrouping_leaves_no_two_alike(spark, monkeypatch):
    rng = random.Random(4)
    bases = [["p", "q", *rng.sample(VOCAB, 18)] for _ in range(25)]
    parts = []
    for name in rng.sample(range(1, 10_000), 150):
        tokens = list(rng.choice(bases))
        for at in rng.sample(range(2, 20), rng.randint(0, 6)):
            tokens[at] = rng.choice(VOCAB)
        parts.append((name % 2, name, " ".join(tokens)))
    df = spark.createDataFrame(parts, "template long, part long, text string").cache()
    for chunk, block in ((500, 500), (3, 40)):  # the second: hardly two alike meet in a chunk
        monkeypatch.setattr(t, "CHUNK", chunk)
        monkeypatch.setattr(t, "BLOCK", block)
        of = {r["part"]: r["group"] for r in t.regrouped(df).collect()}
        assert len(of) == 150
        shared = {}
        for component, name, text in parts:
            now = shared.setdefault((component, of[name]), text.split())
            shared[component, of[name]] = [x if x == y else t.VARIABLE for x, y in zip(now, text.split(), strict=True)]
        assert all(2 * m.count(t.VARIABLE) <= len(m) for m in shared.values())
        assert not [1 for (i, m) in shared.items() for (j, n) in shared.items() if i[0] == j[0] and i < j and t.similar(m, n)]


def test_long_short_and_numeric_lines_by_their_documents(spark):
    rng = random.Random(9)
    passage = " ".join(rng.choice(VOCAB) for _ in range(60))
    near = passage.rsplit(" ", 3)[0] + " other last words"
    once = " ".join(rng.choice(VOCAB) for _ in range(60))
    shorter = " ".join(rng.choice(VOCAB) for _ in range(30))
    rows = [(i, f"{passage if i < 2 else near}\n{shorter}") for i in range(3)] + [(3, once)]
    rows += [(10 + i, f"Advertisement\n1 2 3\n{i} {i + 1} {i + 2}") for i in range(12)]
    got = {r["doc"]["doc_id"]: r["kept"] for r in t.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(4)] == [shorter, shorter, shorter, once]
    assert all(got[10 + i] == (f"{i} {i + 1} {i + 2}" if i != 1 else "") for i in range(12))


def test_masking():
    assert t.masked("  a b2  c\t3 ") == ["a", "<*>", "c", "<*>"]
    for line in ("a  b c", " a b", "a b ", "a\tb", "a\u00a0b", "a b", "a\rb c", "x 1 y z"):
        tokens = t.masked(line)
        leaf = t._hash(" ".join([str(len(tokens)), *tokens[: t.LEAD]])) & ~1
        assert t.line_hashes(line) == ([leaf], [t._hash(" ".join(tokens))]) and t.hashes_of(line).tolist() == t.line_hashes(line)[1], line
    assert t.line_hashes(None) == ([], []) and t.line_hashes("") == ([0], [0])
    assert t.similar("a b c d".split(), "a b c x".split()) and not t.similar("a b c d".split(), "a b x y".split())
