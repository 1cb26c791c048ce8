"""Stripes, slices and bucket tables against plain counting."""

import random
import re
from collections import Counter

from loadwright.llm import op11_collocations as m


def plain(rows, least, top):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    counts[lang, tuple(ws[i : i + k])] += 1
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in found.items():
        if any(l2 == lang and len(q) > len(p) and 100 * f >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
               for (l2, q), f in found.items()):
            continue
        score, k = min((2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, lft, r, total[lang], -s)
        for lang, rows in out.items() for i, (s, a, p, lft, r) in enumerate(sorted(rows)[:top])
    )


def corpus():
    rng = random.Random(4)
    vocab = ["Ab", "b", "çé", "D d", "e", "fgh", "x" * 3000, "zz"]
    rows = [(rng.choice(["en", "de", None, ""]), "".join(rng.choice(vocab) + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".\n"]) for _ in range(rng.randint(0, 90))))
            for _ in range(60)]
    return rows + [(None, None), ("en", ""), ("en", " \t.,"), ("fr", "one two three four " * 900)] * 3


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(map(tuple, m.collocations(df, least=5, top=40, **how).collect()))


def test_same_as_plain_counting(spark):
    rows = corpus()
    want = plain(rows, 5, 40)
    assert len(want) > 60 and run(spark, rows) == want
    assert run(spark, rows, bits=9) == want  # full tables: all phrases are listed


def test_slices_hold_each_phrase_once(monkeypatch):
    for data in (b"", b"a", b"a b c d e f g h", b"a,b.c d  e\tf g" * 30, b"x" * 500 + b" y z " * 9, b"long" * 100):
        whole = next(iter(m.slices(data, 3)))[0]
        want = Counter((k, int(x)) for k, h, ok in whole.phrases() for x in h[ok])
        monkeypatch.setattr(m, "SLICE", 16)
        monkeypatch.setattr(m, "PART", 8)
        got = Counter((k, int(x)) for w, n in m.slices(data, 3) for k, h, ok in w.phrases() for x in h[:n][ok[:n]])
        monkeypatch.undo()
        assert got == want, data[:20]


def test_entries_given_out_early_merge_to_the_same(monkeypatch):
    import pyarrow as pa

    rows = corpus()
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] or "und" for r in rows], "text": [r[1] or "" for r in rows]})

    class Full:
        value = [b"\xff" * (1 << 6 >> 3), *[b"\xff" * (1 << 9 >> 3)] * 2]

    def merged():
        built = list(m._build_stripes(Full, 9)(iter([batch.slice(i, 10) for i in range(0, len(rows), 10)])))
        rows_ = sorted((r for b in built for r in b.to_pylist()), key=lambda r: (r["lang"], r["k"], r["prefix"], r["seg"]))
        schema = built[0].schema
        out = m._merge_stripes(iter([pa.RecordBatch.from_pylist(rows_[i : i + 50], schema=schema) for i in range(0, len(rows_), 50)]))
        return {(r["lang"], r["k"], r["prefix"], w): c for b in out for r in b.to_pylist() for w, c in zip(r["words"], r["counts"])}

    want = merged()
    monkeypatch.setattr(m, "HELD", 20)
    assert merged() == want and want["fr", 2, "one two", "three"] == 2700


def test_stripes_of_more_text_are_not_dealt_to_more_tasks_than_cores(spark, monkeypatch):
    monkeypatch.setattr(m, "TASK_TEXT", 1000)
    text = " ".join(f"w{i % 50}" for i in range(200))
    cores = spark.sparkContext.defaultParallelism

    def built(n):
        docs = spark.createDataFrame([("en", text)] * n, "lang string, text string").repartition(n)
        rows = m.built_stripes(docs, 5, bits=16).collect()
        return len(rows), len({(r.lang, r.k, r.prefix, r.seg) for r in rows}), sum(c for r in rows if r.k == 0 for c in r.counts)

    (few, keys, words), (many, same_keys, all_words) = built(cores), built(5 * cores)
    assert keys == same_keys and all_words == 5 * words == 1000 * cores
    assert few <= many <= cores * keys  # a row of each key a task: five times as many before
    # Tasks stay within the text they may read, however few the cores.
    assert [m.tasks(s, 4) for s in (0, 1, 1001, 10**9)] == [1, 1, 2, 4] and m.tasks(100 << 30, 4) == 100


def test_second_pass_leaves_out_what_collisions_list(spark):
    rare = [("en", f"r{i} s{i}\n" * 20) for i in range(4000)]  # 20 times each, below least
    often = [("en", f"p{i} q{i}\n" * 30) for i in range(50)]
    docs = spark.createDataFrame(rare + often, "lang string, text string").repartition(2)
    listed = {(r.prefix, w): c for r in m.stripes(docs, 30, bits=20).collect() for w, c in zip(r.words, r.counts)}
    assert all(listed["", f"p{i}"] == listed[f"p{i}", f"q{i}"] == 30 for i in range(50))
    assert sum(listed[k] for k in listed if k[0] == "") == 2 * 20 * 4000 + 2 * 30 * 50
    assert len(listed) < 170  # 151 that recur and the unlisted words; hundreds more with the first pass alone
