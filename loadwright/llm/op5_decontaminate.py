"""Benchmark decontamination.

A broadcast set of the benchmark's normalised word n-grams; every training
text is scanned window by window, hits are verified word by word, and hit
documents (or just their hit spans) are removed.

Words: A-Z in lower case, then runs of ``[0-9a-z]`` and characters from U+0080.
A window is ``n`` (10) consecutive words of an item; an item of fewer words,
but not none, is one window.

The benchmark is read in blocks of about ``BLOCK_BYTES`` of text.  A block's
index holds 16 bytes a window (its hash and place, sorted by hash), 4 bytes a
word and one dictionary entry a distinct word; a window is verified against the
words themselves.  So each broadcast has a fixed bound; a document's hits
are carried from block to block on its own row, without a shuffle.

Cases: a null or empty text has no words and no hits; null items and items
without words have no window; repeated items count once by item_id; an item
with a null id marks its hits but is not listed; an empty benchmark leaves
every document clean; repeated documents are scanned each; other columns
pass through untouched.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small_batches, table

N_GRAM = 10
BLOCK_BYTES = 32 << 20

_KEEP = bytes(
    (c | 0x20) if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
# The same words in the text as written, where A-Z are not lowered yet.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_MULT = np.array([pow(0x9E3779B97F4A7C15, j + 1, 2**64) | 1 for j in range(64)], dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


def window_hash(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(len(starts), dtype=np.uint64)
    for j in range(n):
        h += ids[starts + j].astype(np.uint64) * _MULT[j % 64] + np.uint64(j)
    return h


def index_items(items: list[tuple[object, str | None]], n: int) -> dict:
    """Vocabulary, the items' words as one array, and by window length the
    sorted hashes of all windows with their places in it."""
    vocab: dict[bytes, int] = {}
    words = array("i")
    ends, names = array("q"), []
    for item_id, text in items:
        own = words_of(text)
        if own:
            words.extend(vocab.setdefault(w, len(vocab) + 1) for w in own)
            ends.append(len(words))
            names.append(item_id)
    ids, ends = np.array(words, dtype=np.int32), np.array(ends, dtype=np.int64)
    lengths = np.diff(ends, prepend=0)
    sizes = np.minimum(lengths, n)
    # A place starts a window of its item's size if that ends in the item.
    at = np.arange(len(ids))
    size_at = np.repeat(sizes, lengths)
    starts = at + size_at <= np.repeat(ends, lengths)
    windows = {}
    for size in np.unique(sizes).tolist():
        places = at[starts & (size_at == size)]
        h = window_hash(ids, places, size)
        order = np.argsort(h, kind="stable")
        windows[size] = (h[order], places[order])
    return {"vocab": vocab, "words": ids, "ends": ends, "names": names, "windows": windows}


def scan(text: str | None, index: dict) -> tuple[np.ndarray, set]:
    """Which words of the text lie in a benchmark window, and whose."""
    words = words_of(text)
    hit = np.zeros(len(words), dtype=bool)
    found: set = set()
    get = index["vocab"].get
    ids = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
    known = np.concatenate(([0], np.cumsum(ids > 0)))
    for size, (hashes, places) in index["windows"].items():
        if size > len(ids):
            continue
        starts = np.flatnonzero(known[size:] - known[:-size] == size)
        if not len(starts):
            continue
        h = window_hash(ids, starts, size)
        first, last = np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")
        for k in np.flatnonzero(first < last).tolist():
            i = int(starts[k])
            same = places[first[k] : last[k]]
            for j in range(size):
                same = same[index["words"][same + j] == ids[i + j]]
            if len(same):
                hit[i : i + size] = True
                found.update(index["names"][x] for x in np.unique(np.searchsorted(index["ends"], same, side="right")).tolist())
    return hit, found


def cut_spans(text: str | None, hit: np.ndarray) -> str | None:
    """The text without its runs of hit words (from first to last character)."""
    if text is None or not hit.any():
        return text
    spans = [m.span() for m in _WORD.finditer(text)]
    out, last, i = [], 0, 0
    while i < len(spans):
        if hit[i]:
            j = i
            while j + 1 < len(spans) and hit[j + 1]:
                j += 1
            out.append(text[last : spans[i][0]])
            last = spans[j][1]
            i = j
        i += 1
    return "".join(out) + text[last:]


def benchmark_blocks(bench: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The benchmark's items in blocks of about ``block_bytes`` of text."""
    items = bench.select("item_id", "text").where(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    if n > 1:
        items = materialise(items.withColumn("b", F.pmod(F.xxhash64("text"), F.lit(n))), "bench")
    for b in range(n):
        part = items.where(F.col("b") == b) if n > 1 else items
        yield [(r["item_id"], r["text"]) for r in part.select("item_id", "text").toLocalIterator()]


HITS = "struct<n_words:long,n_hit:long,bits:binary,items:array<string>,cleaned:string>"


def scanner(shared, spans: bool):
    """Scans texts for one block of the benchmark, adding to the hits so far."""

    @F.pandas_udf(HITS)
    def scanned(text: pd.Series, bits: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for t, b, its in zip(text, bits, items, strict=True):
            hit, found = scan(t, shared.value)
            if b is not None:
                hit |= np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=len(hit)).astype(bool)
            names = {str(x) for x in found if x is not None} | set(its if its is not None else ())
            cleaned = cut_spans(t, hit) if spans else None
            rows.append((len(hit), int(hit.sum()), np.packbits(hit).tobytes(), sorted(names), cleaned))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "bits", "items", "cleaned"])

    return scanned


def scan_documents(
    docs: DataFrame, bench: DataFrame, n: int = N_GRAM, block_bytes: int = BLOCK_BYTES, spans: bool = False
) -> DataFrame:
    """``docs`` plus a struct ``hits``: n_words, n_hit, items, and with
    ``spans`` the text without its hit spans (``cleaned``)."""
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.withColumn("hits", F.lit(None).cast(HITS))
    for items in benchmark_blocks(bench, block_bytes):
        scanned = scanner(spark.sparkContext.broadcast(index_items(items, n)), spans)
        out = out.withColumn("hits", scanned(F.col("text"), F.col("hits.bits"), F.col("hits.items")))
    return out


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = N_GRAM, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with
    their hit spans cut from the text."""
    cols = docs.columns
    seen = scan_documents(docs.select(F.struct("*").alias("doc"), F.col("text")), bench, n, spans=remove == "spans")
    if remove == "documents":
        return seen.where("hits.n_hit = 0").select(*[F.col("doc").getField(c).alias(c) for c in cols])
    if remove != "spans":
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    return seen.select(*[(F.col("hits.cleaned") if c == "text" else F.col("doc").getField(c)).alias(c) for c in cols])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scan_documents(docs, table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.col("hits.n_hit").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hits.items")), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# Windows as joined words; documents' windows of every length that occurs.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w,
    row_number() OVER () AS r FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

QUERIES = {"op5_decontaminate": op5_decontaminate}
ORACLES = {"op5_decontaminate": ORACLE}
