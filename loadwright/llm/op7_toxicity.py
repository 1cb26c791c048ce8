"""Toxicity: subsequence string-kernel SVM with Nystroem landmarks.

The kernel counts common subsequences of four characters, one character
between any two of them allowed (a span of up to ``SPAN``), each occurrence
weighted ``DECAY`` to the power of its span.  What is neither letter nor digit
is left out of a sentence first, be it ASCII, a middle dot or of no width, so
"id.iot" reads "idiot".  The kernel is taken over windows of a sentence, and the
worst window counts:

- every word (runs of single characters, "i d i o t", are one word);
- every two neighbouring words as one string, for what a space splits ("id iot")
  and for insults of two words;
- of a run of single characters all but the first ("a i d i o t");
- of words of seven letters and more every second letter, for a character
  inserted in every gap ("ixdxixoxt").

Each is normalised by its length.  A window's Nystroem features against the
landmarks feed a linear SVM; as features and SVM are both linear in the
kernel, the landmarks collapse into one table of subsequence weights, and a
text of any length is scored by table look-ups.

Only documents are labelled, so training is multiple-instance: the worst word
of a document stands for it, chosen anew as the SVM is refitted, beside all
words that are much more frequent in toxic documents than in clean ones.  The worst
windows of clean documents are counter-examples.  A text's margins become a
probability by logistic fits on labelled documents the SVM has not seen: one on its two
worst windows, one on how far the worst passes what clean documents reach (all
but ``RARE`` of them).  The larger one counts, so one plain insult is enough.

Training takes at most ``SAMPLE`` labelled documents of each class, of up to
``SAMPLE_CHARS`` characters, chosen by hash of the doc_id among the rows the
contract allows; class frequencies for the calibration are counted over all
of them.  Scoring reads every whole text.

Cases: null and empty texts score as texts without any word; without both
classes among the labels every text scores the base rate (0 without labels);
null labels are left out, of several labels for a document the highest
counts; a row with a null doc_id is scored, never trained on and not held
out; repeated rows score alike.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

SPAN = 6
GAP = 2  # distance of neighbours in a subsequence, at most
DECAY = 0.6
LANDMARKS = 120
HARD = 60  # more landmarks: the clean words that a first fit rates worst
SAMPLE = 1500
SAMPLE_CHARS = 20_000
PIECE = 1 << 19  # characters scored at a time; pieces end at white space
ROWS = 10_000  # feature rows handled at a time in training, to bound the driver's memory
THRESHOLD = 0.3
CLASSES = 40  # characters are mapped to so many classes
START = 39  # the class of a word's start
COST = 10_000.0  # SVM cost of all documents
OFFSETS = [(i, i + j, i + j + k) for i in range(1, GAP + 1) for j in range(1, GAP + 1) for k in range(1, GAP + 1)]
HALF = 7  # letters of a word from which every second one is read too
RARE = 0.01
WINDOWS = 2  # worst windows of a clean document that training sees

# 0: neither letter nor digit (left out); 1-26 letters, 27-28 digits, 29-38
# letters and digits beyond ASCII; 39 a word's start; 254 a line's end, 255 other white space.
LINE, SPACE = 254, 255


def _class(cp: int) -> int:
    kind = unicodedata.category(chr(cp))[0]
    if cp in (10, 13, 0x2028, 0x2029):
        return LINE
    if cp in (9, 11, 12) or kind == "Z":
        return SPACE
    if 97 <= cp <= 122:
        return cp - 96
    if 48 <= cp <= 57:
        return 27 + cp % 2
    return 29 + cp % 10 if cp >= 128 and kind in "LN" else 0


_LUT = np.array([_class(cp) for cp in range(1 << 16)], dtype=np.uint8)
_ENDS = np.zeros(1 << 16, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def units_of(text: str) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]:
    """Character classes, their word numbers (not decreasing), words, whether each
    word and the next are in one sentence, whether it is a run of single characters.

    What is no letter or digit is left out, and single characters one space apart in
    a line make one word: "id.iot" and "i d i o t" both read "idiot".  The white space before
    a word stays as its first character, so a kernel can tell a word's start.
    Sentences end with a line or a word that ends in one of ``.!?``.
    """
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    cls = np.where(cp < 1 << 16, _LUT[cp & 0xFFFF], np.where(cp < 0x20000, 0, 29 + cp % 10)).astype(np.uint8)
    inside = cls < LINE
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return cls[:0], np.empty(0, dtype=np.int32), 0, np.empty(0, dtype=bool), np.empty(0, dtype=bool)
    single = ends - starts == 1
    lines = np.concatenate(([0], np.cumsum(cls == LINE)))
    line = lines[starts[1:]] == lines[ends[:-1]]
    same = np.concatenate((line & ~_ENDS[np.minimum(cp[ends[:-1] - 1], 0xFFFF)], [False]))
    glued = np.concatenate(([False], single[1:] & single[:-1] & (starts[1:] - ends[:-1] == 1) & line))
    unit = (np.cumsum(~glued) - 1).astype(np.int32)
    joined = same[np.concatenate((~glued[1:], [True]))]
    word = np.zeros(len(cls), dtype=np.int32)
    word[inside] = np.repeat(unit, ends - starts)
    first = starts[~glued] - 1
    first = first[first >= 0]
    word[first] = word[first + 1]
    cls[first] = START
    kept = (cls > 0) & (cls < LINE)
    return cls[kept], word[kept], int(unit[-1]) + 1, joined, np.bincount(unit, weights=glued) > 0


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Character classes, their window numbers (not decreasing), words, windows:
    the words, then pairs of neighbours in a sentence, runs of single characters
    less their first, halves of long words."""
    cls, word, n, joined, run = units_of(text)
    length = np.bincount(word, minlength=n)
    start = np.cumsum(length) - length
    left = np.flatnonzero(joined[:-1] & (length[:-1] > 1) & (length[1:] > 1)) if n else np.empty(0, dtype=int)
    both = length[left] + length[left + 1]
    at = np.repeat(start[left] - (np.cumsum(both) - both), both) + np.arange(both.sum())
    pair = np.repeat(np.arange(n, n + len(left)), both)
    keep = at != np.repeat(start[left + 1], both)
    at, pair = at[keep], pair[keep]
    place = np.arange(len(cls)) - start[word]
    parts, numbers, total = [cls, cls[at]], [word, pair], n + len(left)
    # A run's start and all but its first letter; a long word's start and first, third, fifth ... letter.
    for some, kept in ((run & (length > 2), place != 1), (length > HALF, (place == 0) | (place % 2 == 1))):
        at = np.flatnonzero(some[word] & kept)
        parts.append(cls[at])
        numbers.append((np.cumsum(some) - 1 + total)[word[at]])
        total += int(some.sum())
    return np.concatenate(parts), np.concatenate(numbers).astype(np.int32), n, total


def read_back(cls: np.ndarray) -> str:
    """A string of these classes (its start apart)."""
    return "".join(chr(c + 96) if c <= 26 else str((c - 1) % 2) if c <= 28 else chr(220 + (c - 29)) if c > 32 else chr(230 + (c - 29)) for c in cls.tolist() if c < START)


def occurrences(cls: np.ndarray, word: np.ndarray):
    """Subsequences of words: word numbers, codes and weight for each gap pattern."""
    c = cls.astype(np.int32)
    pair = {}
    for i in {i for i, _, _ in OFFSETS}:
        pair[i] = (c[:-i] * CLASSES + c[i:]) * CLASSES**2 if len(c) > i else c[:0]
    for i, j, k in OFFSETS:
        if len(c) <= k:
            continue
        n = len(c) - k
        at = np.flatnonzero(word[:n] == word[k:])
        yield word[at], pair[i][at] + c[at + j] * CLASSES + c[at + k], DECAY**k


def length_norm(n):
    return np.sqrt(n + 2.0)


def pieces(text: str):
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end


def values_of(piece: str, weights: np.ndarray):
    """SVM values of a piece's windows, with their characters and numbers."""
    cls, window, n, total = windows_of(f" {piece}")
    c = cls.astype(np.int32)
    two = {i: c[:-i] * CLASSES**3 + c[i:] * CLASSES**2 for i in range(1, GAP + 1) if len(c) > i}
    last = c * CLASSES
    found = np.zeros(len(c))  # by first character
    for i, j, k in OFFSETS:
        m = len(c) - k
        if m > 0:
            code = two[i][:m] + last[j : j + m]
            code += c[k:]
            code *= window[:m] == window[k:]  # no subsequence has code 0
            found[:m] += weights.take(code) * DECAY**k
    value = np.bincount(window, weights=found, minlength=total)
    return value / length_norm(np.bincount(window, minlength=total)), cls, window, n


def margins(text: str | None, weights: np.ndarray) -> tuple[float, float]:
    """SVM values of the two worst words; a pair or half counts as its first word
    does, if it is worse (0 where there are fewer)."""
    best = [0.0, 0.0]
    for piece in pieces(text or ""):
        value, cls, window, n = values_of(piece, weights)
        if not n:
            continue
        top = value[:n]
        joint = float(value[n:].max()) if len(value) > n else 0.0
        top = np.partition(top, n - min(2, n))[-2:].tolist() if n > 2 else top.tolist()
        if joint > max(top):
            top = [*top, joint]
        best = sorted(best + top, reverse=True)[:2]
    return best[0], best[1]


def worst_windows(text: str | None, weights: np.ndarray, k: int) -> list[str]:
    """The pairs and halves of a text that have the largest values."""
    found: list[tuple[float, str]] = []
    for piece in pieces(text or ""):
        value, cls, window, n = values_of(piece, weights)
        for i in (np.argsort(-value[n:], kind="stable")[:k] + n).tolist():
            lo, hi = np.searchsorted(window, [i, i + 1])
            found.append((-value[i], read_back(cls[lo:hi])))
    return [w for _, w in sorted(found)[:k] if len(w) > 1]


def phi(strings: list[str]) -> tuple[list[dict[int, float]], np.ndarray]:
    """Explicit subsequence features of short strings, and their norms."""
    out = []
    for s in strings:
        cls, word, *_ = units_of(s)
        f: dict[int, float] = {}
        for _, code, weight in occurrences(cls, word):
            for x in code.tolist():
                f[x] = f.get(x, 0.0) + weight
        out.append(f)
    return out, length_norm(np.array([len(s) for s in strings], dtype=float))


def choose_landmarks(bags: list[set[str]], toxic: np.ndarray, m: int) -> tuple[list[str], np.ndarray]:
    """Words and word parts whose documents differ most by label, each unlike
    the ones before, with their gains; the rest are the commonest clean words
    (gain 0)."""
    clean_words = Counter(w for b, t in zip(bags, toxic, strict=True) if not t for w in b)
    n_pos, n_neg = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))

    def parts_of(bag: set[str]) -> set[str]:
        own = set()
        for w in bag:
            w = f" {w[:24]}"
            own.add(w)
            for k in (4, 5, 6):
                own.update(w[i : i + k] for i in range(len(w) - k + 1))
        return own

    seen: Counter = Counter()
    for b, t in zip(bags, toxic, strict=True):
        if t:
            seen.update(parts_of(b))
    bad = {g: p for g, p in seen.items() if p >= 2}
    del seen
    usual_in: Counter = Counter()  # clean documents, counted for the parts in ``bad`` only
    for b, t in zip(bags, toxic, strict=True):
        if not t:
            usual_in.update(g for g in parts_of(b) if g in bad)
    scored = []
    for g, p in bad.items():
        q = usual_in[g]
        # A conservative lift: each share is moved by two standard deviations
        # against it, so chance words of a small sample do not pass.
        share, usual = (p - 2 * math.sqrt(p)) / n_pos, (q + 1 + 2 * math.sqrt(q + 1)) / (n_neg + 1)
        gain = share * math.log(share / usual) if share > usual else 0.0
        if gain > 0:
            scored.append((-gain, -len(g), g))
    scored.sort()
    chosen: list[str] = []
    gains: list[float] = []
    parts: set[str] = set()
    for gain, _, g in scored:
        if len(chosen) >= m - m // 5:
            break
        own = {g[i : i + 3] for i in range(len(g) - 2)}
        if len(own & parts) * 2 <= len(own):
            chosen.append(g)
            gains.append(-gain)
            parts |= own
    for w, _ in sorted(clean_words.items(), key=lambda x: (-x[1], x[0])):
        if len(chosen) >= m:
            break
        if len(w) >= 4 and f" {w}" not in chosen:
            chosen.append(f" {w}")
            gains.append(0.0)
    return chosen, np.array(gains)


def fit_svm(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge) by Newton steps; ``c`` weighs the rows."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    reg = np.eye(x1.shape[1])
    reg[-1, -1] = 1e-6
    v = np.zeros(x1.shape[1])
    for _ in range(30):
        active = y * (x1 @ v) < 1
        if not active.any():
            break
        xa, ya, ca = x1[active], y[active], c[active]
        new = np.linalg.solve(reg + 2 * (xa * ca[:, None]).T @ xa, 2 * (xa * ca[:, None]).T @ ya)
        if np.allclose(new, v, atol=1e-9):
            break
        v = new
    return v[:-1], float(v[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
    x1 = np.hstack([x, np.ones((len(x), 1))])
    v = np.zeros(x1.shape[1])
    reg = np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ v, -30, 30)))
        step = np.linalg.solve((x1 * (c * p * (1 - p))[:, None]).T @ x1 + reg, x1.T @ (c * (p - y)) + reg @ v)
        v = v - step
        if np.abs(step).max() < 1e-8:
            break
    return v


def dots(z: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``z @ v`` in double precision, a block of rows converted at a time."""
    return np.concatenate([z[i : i + ROWS] @ v for i in range(0, len(z), ROWS)] or [np.empty(0)])


def documents_with(members, y, n: int) -> tuple[np.ndarray, np.ndarray]:
    """In how many toxic and in how many clean documents each word is."""
    none = [np.empty(0, dtype=int)]
    return tuple(np.bincount(np.concatenate([m for m, t in zip(members, y, strict=True) if t == side] or none), minlength=n) for side in (True, False))


def fit_landmarks(marks, gains, vocab, members, y, prior):
    """Nystroem features of all words, then a multiple-instance SVM on them.

    A word weighs as the documents that it stands for, classes by their share of all
    labels, so words that clean documents hold too get small values.  Words whose
    share of the toxic documents passes that of the clean ones by a safe distance
    stand for all of their toxic documents.

    Returns subsequence codes, the SVM's weight of each, and every word's value.
    """
    feats, norm = phi(marks)
    codes = np.array(sorted({c for f in feats for c in f}))
    at = {c: i for i, c in enumerate(codes.tolist())}
    grid = np.zeros((len(marks), len(codes)))
    for j, f in enumerate(feats):
        for code, v in f.items():
            grid[j, at[code]] = v
    grid /= norm[:, None]
    values, vectors = np.linalg.eigh(grid @ grid.T)
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    project = grid.T @ whiten
    known = np.full(CLASSES**4, -1, dtype=np.int32)
    known[codes] = np.arange(len(codes))
    z = np.zeros((len(vocab), project.shape[1]), dtype=np.float32)
    for start in range(0, len(vocab), ROWS):
        cls, word, n, *_ = units_of(" " + " ".join(vocab[start : start + ROWS]))
        rows = z[start : start + n]
        for w, code, weight in occurrences(cls, word):
            col = known[code]
            hit = np.flatnonzero(col >= 0)
            for i in range(0, len(hit), ROWS):
                some = hit[i : i + ROWS]
                np.add.at(rows, w[some], (weight * project[col[some]]).astype(np.float32))
        rows /= length_norm(np.bincount(word, minlength=n)).astype(np.float32)[:, None]
    # First witnesses: the words nearest to the landmarks of the largest gain.
    value = dots(z, whiten.T @ (gains / gains.max()))
    v = np.zeros(project.shape[1])
    neg = np.empty(0, dtype=int)
    n_pos, n_neg = max(1, int(y.sum())), max(1, int((~y).sum()))
    p, q = documents_with(members, y, len(vocab))
    sure = np.flatnonzero((p - 2 * np.sqrt(p)) / n_pos > (q + 1 + 2 * np.sqrt(q + 1)) / (n_neg + 1))
    for _ in range(6):
        pos = np.array([m[np.argmax(value[m])] for m, t in zip(members, y, strict=True) if t and len(m)], dtype=int)
        worst = [m[np.argsort(value[m])[-4:]] for m, t in zip(members, y, strict=True) if not t and len(m)]
        neg = np.unique(np.concatenate([neg, *worst]))
        if not len(pos) or not len(neg):
            break
        rows = np.concatenate([pos, sure, neg])
        side = np.concatenate([np.ones(len(pos) + len(sure)), -np.ones(len(neg))])
        docs = np.concatenate([np.ones(len(pos)), p[sure], q[neg]])
        cost = COST * docs * np.where(side > 0, prior / n_pos, (1 - prior) / n_neg)
        v, _ = fit_svm(z[rows], side, cost)
        value = dots(z, v)
    return codes, project @ v, value


def train(texts: list[str], toxic: np.ndarray, held: np.ndarray, prior: float) -> dict:
    """``held`` marks the documents kept for the calibration."""
    if not toxic.any() or toxic.all():
        return {"weights": None, "rate": prior}
    words: dict[str, str] = {}  # one string for each word, however many documents hold it
    bags = [{words.setdefault(w, w) for w in (t or "").lower().split() if len(w) > 1} for t in texts]
    del words
    fit = ~held if toxic[~held].any() and not toxic[~held].all() else np.ones(len(bags), dtype=bool)
    cal = held if toxic[held].sum() >= 5 and (~toxic[held]).sum() >= 5 else np.ones(len(bags), dtype=bool)
    marks, gains = choose_landmarks([b for b, f in zip(bags, fit, strict=True) if f], toxic[fit], LANDMARKS)
    if not gains.any():
        return {"weights": None, "rate": prior}
    vocab = sorted(set().union(*[b for b, f in zip(bags, fit, strict=True) if f]))
    index = {w: i for i, w in enumerate(vocab)}
    members = [np.array([index[w] for w in sorted(b)], dtype=int) for b, f in zip(bags, fit, strict=True) if f]
    y = toxic[fit]
    codes, weights, value = fit_landmarks(marks, gains, vocab, members, y, prior)
    clean = np.zeros(len(vocab), dtype=bool)
    clean[np.concatenate([m for m, t in zip(members, y, strict=True) if not t])] = True
    worst = np.argsort(np.where(clean, -value, np.inf), kind="stable")[:HARD]
    more = [f" {vocab[i]}" for i in worst if clean[i] and f" {vocab[i]}" not in marks]
    # The worst windows of clean documents, as the first fit sees them, are further clean words.
    table = np.zeros(CLASSES**4, dtype=np.float32)
    table[codes] = weights
    of_fit = [t for t, f in zip(texts, fit, strict=True) if f]
    for k, (text, toxic_one) in enumerate(zip(of_fit, y, strict=True)):
        if toxic_one:
            continue
        new = []
        for w in worst_windows(text, table, WINDOWS):
            if w not in index:
                index[w] = len(vocab)
                vocab.append(w)
            new.append(index[w])
        members[k] = np.unique(np.concatenate([members[k], np.array(new, dtype=int)]))
    codes, weights, _ = fit_landmarks(marks + more, np.concatenate([gains, np.zeros(len(more))]), vocab, members, y, prior)
    table = np.zeros(CLASSES**4, dtype=np.float32)
    table[codes] = weights
    seen = np.array([margins(t, table) for t, k in zip(texts, cal, strict=True) if k])
    y = toxic[cal]
    balance = np.where(y, prior / max(1, y.sum()), (1 - prior) / max(1, (~y).sum())) * len(y)
    reach = float(np.quantile(seen[~y, 0], 1 - RARE))
    fitted = fit_logistic(seen, y.astype(float), balance)
    beyond = fit_logistic(np.maximum(seen[:, :1] - reach, 0), y.astype(float), balance)
    return {
        "codes": codes, "weights": weights, "logit": fitted, "reach": reach, "beyond": beyond,
        "rate": prior, "landmarks": marks + more,
    }


_TABLES: dict[bytes, np.ndarray] = {}


def table_of(model: dict) -> np.ndarray:
    """The weights by code, unpacked once per worker."""
    key = model["weights"].tobytes()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = np.zeros(CLASSES**4, dtype=np.float32)
        _TABLES[key][model["codes"]] = model["weights"]
    return _TABLES[key]


def score(text: str | None, model: dict) -> float:
    if model["weights"] is None:
        return float(model["rate"])
    seen = margins(text, table_of(model))
    x = np.array([*seen, 1.0]) @ model["logit"]
    if seen[0] > model["reach"]:
        x = max(x, np.array([seen[0] - model["reach"], 1.0]) @ model["beyond"])
    return float(1 / (1 + math.exp(-min(30.0, max(-30.0, x)))))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def fit_model(docs: DataFrame, labels: DataFrame) -> dict:
    """Train from the documents whose id's crc32 has not the remainder 2."""
    spark = docs.sparkSession
    truth = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(remainder(F.col("doc_id")) != 2)
    )
    counts = {r["toxic"] > 0: r["n"] for r in truth.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    prior = counts.get(True, 0) / max(1, sum(counts.values()))
    picked = None
    for side in ("toxic > 0", "NOT toxic > 0"):
        some = truth.where(side).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(SAMPLE)
        picked = some if picked is None else picked.union(some)
    rows = picked.collect()  # at most 2 * SAMPLE ids
    if not rows:
        return {"weights": None, "rate": prior}
    ids = spark.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in rows], "doc_id long, toxic int")
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(ids), "doc_id")
        .where(F.length("text") <= SAMPLE_CHARS)
        .orderBy("doc_id", "text")
        .limit(2 * SAMPLE)
        .select("text", "toxic", remainder(F.col("doc_id")).alias("r"))
        .toPandas()
    )
    if not len(sample):
        return {"weights": None, "rate": prior}
    return train(sample["text"].tolist(), sample["toxic"].to_numpy() > 0, sample["r"].to_numpy() == 3, prior)


def toxicity(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """``docs`` plus its score in a new column."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series([score(t, shared.value) for t in text], dtype=float)

    return docs.withColumn(column, scored(F.col("text")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity(docs, fit_model(docs, table(spark, sf_dir, "labels")))
    return out.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLES: dict[str, str] = {}
