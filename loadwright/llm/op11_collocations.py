"""Phrase collocation mining with stripes.

A stripe is an associative counter keyed by a prefix: the prefix of 0 to 3
words maps every next word that may recur often enough to its count; words
that cannot are counted under the empty word of the empty prefix.  Stripes are
built in each task, dealt by (language, prefix, segment of the next word),
sorted, and merged elementwise as they stream by.  Three things come from the
merged stripes: the extensions (the phrases and their counts), the totals (of
a prefix, from its own entry one word before; of all words, from the sum of the
empty prefix) and the subsumption maxima (the largest count in a phrase's own
stripe, and of its entries as the end of a longer phrase; a still longer phrase
has no larger count than one of these).

Before, one pass counts the hashes of all words and phrases of 2 and 3 words in
tables of a fixed number of buckets (32 MB each at most, sized by the corpus).
A phrase whose bucket, or whose part's, stays below ``least`` cannot be a
candidate and is not listed; hash collisions only list more.  A phrase of 4
words is listed if both its parts of 3 are.  A second pass counts only what the
first one lists, words to phrases of 4, by other hashes in smaller tables, and
leaves out most of what was listed by collisions.  The tables are merged in
chunks on the executors; bitmaps of one bit a bucket (4 MB a length at most)
are broadcast.  A corpus of far more words than buckets fills the tables, and
then more phrases are listed (all, in the end), with the same results.

A task gives a stripe for each listed prefix that it meets, so stripes grow with
the product of tasks and prefixes while a phrase is met by most tasks.  Text is
therefore dealt to as many tasks as there are cores, not to more as it grows,
until a task has ``MOST_TEXT``; what a task holds is bounded by ``HELD``.

A prefix with very many next words is spread over several stripes by a hash of
the next word (``SEGMENTS``).  The counts are exact (64-bit hashes place and combine
phrases in a batch: two phrases of one batch are mixed up with probability
below 1e-6 for 5 million phrases); the score is taken in decimals.

Long texts are read in slices that overlap by three words, so memory does not
grow with a text, only with a single word.

Cases: a null text is empty, a null language ``und``; an empty language is its
own; texts without words count nothing; repeated rows count each time; ties in
the score go to the shortest first part, ties in rank to the phrase; an empty
table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import functools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, small_batches, table
from .textnp import mix

LONGEST = 4
MIN_COUNT = 30
SUBSUMED = (80, 100)  # a phrase goes if 100 * f(longer) >= 80 * a
SCALE = 2_000_000
TOP = 2000
# Stripes of a prefix of 0, 1, 2 and 3 words: shorter prefixes have more next words.
SEGMENTS = (64, 4, 1, 1)
MAX_BITS = 25  # buckets of a table: 2^25 at most
COUNTED = 3  # phrases of up to so many words have bucket tables in the first pass
AGAIN = 2  # tables of the second pass are smaller by so many bits
CHUNK = 1 << 16
SLICE = 1 << 20  # bytes of text read at a time
PART = 1 << 16  # bytes hashed at a time
HELD = 2_000_000  # entries a task holds before it gives its stripes out
STRIPES_OUT = 10_000  # stripes of a batch
TASK_TEXT = 64 << 20  # characters a task reads at least, so that its stripes combine counts
MOST_TEXT = 1 << 30  # and at most, if there are more tasks than cores

_BASE = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, dtype=np.uint8)  # 0 in a word, 1 blank, 2 between pieces
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# Powers of the word hash's odd multiplier and their inverses (modulo 2^64): a
# word's hash is a difference of running sums, moved to its first byte.
_POWERS = np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(PART, _BASE))))
_INVERSE = np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(PART, pow(int(_BASE), -1, 1 << 64), dtype=np.uint64))))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Hash, start, end and piece of each word, and the number of pieces that end.  At most
    ``PART`` bytes, so that the arrays stay in the processor's cache."""
    kind = _KIND[data]
    inside = np.concatenate(([False], kind == 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(data)], out=sums[1:])
    word = (sums[ends] - sums[starts]) * _INVERSE[starts] + (ends - starts).astype(np.uint64)
    cuts = np.flatnonzero(kind == 2)
    return word, starts, ends, np.searchsorted(cuts, starts), len(cuts)


def _long_word_hash(data: np.ndarray) -> np.uint64:
    """The same hash for a word of any length."""
    total, power = len(data), 1
    for at in range(0, len(data), PART):
        part = data[at : at + PART].astype(np.uint64) + np.uint64(1)
        total += int((part * _POWERS[: len(part)]).sum(dtype=np.uint64)) * power
        power = power * int(_POWERS[len(part)]) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(total & 0xFFFFFFFFFFFFFFFF)


class Words:
    """Words of one slice: hashes, places, and whether the next one follows in the piece."""

    def __init__(self, data: bytes, seed: int):
        self.bytes = _LOWER[np.frombuffer(data, dtype=np.uint8)]
        self.lower = self.bytes.tobytes()
        parts, at, pieces = [], 0, 0
        while at < len(data):
            end = min(at + PART, len(data))
            while end < len(data) and end > at and _KIND[data[end - 1]] == 0 and _KIND[data[end]] == 0:
                end -= 1  # a word is not cut
            if end > at:
                word, starts, ends, piece, n = _word_hashes(self.bytes[at:end])
                parts.append((word, starts + at, ends + at, piece + pieces))
                pieces += n
            else:
                end = at + PART
                while end < len(data) and _KIND[data[end]] == 0:
                    end += 1
                parts.append((np.array([_long_word_hash(self.bytes[at:end])]), np.array([at]), np.array([end]), np.array([pieces])))
            at = end
        word, self.starts, self.ends, piece = (
            [np.concatenate(p) for p in zip(*parts)] if parts else [np.empty(0, dtype=np.uint64), *[np.empty(0, dtype=np.int64)] * 3]
        )
        self.hash = mix(word + np.uint64(seed))
        self.follows = np.concatenate((piece[1:] == piece[:-1], [False]))[: len(word)]

    def phrases(self, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, hash, is a phrase) for the phrases that start at each word."""
        h, ok = self.hash, np.ones(len(self.hash), dtype=bool)
        yield 1, h, ok
        for k in range(2, longest + 1):
            nxt = np.zeros(len(h), dtype=np.uint64)
            nxt[: len(h) - k + 1] = self.hash[k - 1 :]
            far = np.zeros(len(h), dtype=bool)
            far[: len(h) - k + 2] = self.follows[k - 2 :]
            h, ok = mix(h * _BASE + nxt + np.uint64(k)), ok & far
            yield k, h, ok

    def text(self, i: int, k: int) -> bytes:
        return b" ".join([self.lower[self.starts[j] : self.ends[j]] for j in range(i, i + k)])


def slices(data: bytes, seed: int) -> Iterator[tuple[Words, int]]:
    """Slices of a text with the number of words at which phrases start there.

    A slice that is not the last leaves its last three words to the next one,
    so every phrase starts in one slice and lies whole in it.
    """
    start, size = 0, SLICE
    while True:
        end = min(start + size, len(data))
        while end < len(data) and _KIND[data[end]] == 0:
            end += 1
        words = Words(data[start:end], seed)
        n = len(words.hash)
        if end == len(data):
            yield words, n
            return
        if n < LONGEST:
            size *= 2  # hardly a word in it
            continue
        yield words, n - LONGEST + 1
        start, size = start + int(words.starts[n - LONGEST + 1]), SLICE


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Language and its texts of a batch, joined in pieces."""
    by_lang = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        by_lang[lang].append(text.encode("utf-8", "surrogatepass"))
    for lang, texts in by_lang.items():
        yield lang, b"\n".join(texts)


def _seed(lang: str) -> int:
    return zlib.crc32(lang.encode("utf-8", "surrogatepass")) * 0x9E3779B1 & 0xFFFFFFFF


def _bits(k: int, bits: int, again: bool = False) -> int:
    """Words repeat more than phrases: a table of an eighth.  The second pass counts few of each."""
    return bits - AGAIN if again else bits - 3 if k == 1 else bits


def _bucket(h: np.ndarray, k: int, bits: int, again: bool = False) -> np.ndarray:
    """Buckets of the first or the second pass, of independent bits of the hash."""
    return ((mix(h + _BASE) if again else h) >> np.uint64(64 - _bits(k, bits, again))).astype(np.int64)


def _maps(buckets: list[bytes]) -> list[np.ndarray]:
    return [np.unpackbits(np.frombuffer(b, dtype=np.uint8)).view(bool) for b in buckets]


def _listed(words: Words, bits: int, first: list[np.ndarray], second: list[np.ndarray] = ()) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, hash, is listed) for the phrases that start at each word."""
    shorter = None
    for k, h, keep in words.phrases():
        for maps, again in ((first, False), (second, True)):
            if k <= len(maps):
                keep = keep & maps[k - 1][_bucket(h, k, bits, again)]
        if k > 1:
            # listed only if both parts one word shorter are
            keep = keep & shorter & np.concatenate((shorter[1:], [False]))
        yield k, h, keep
        shorter = keep


# ------------------------------------------------------------------ bucket counts


def _count_buckets(bits: int, least: int, first=None):
    """Counts of all phrases of ``COUNTED`` words, or of the phrases listed by ``first`` (broadcast)."""
    kind = np.uint8 if least < 256 else np.uint32
    again = first is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = _maps(first.value) if again else None
        counts = [np.zeros(1 << _bits(k, bits, again), dtype=kind) for k in range(1, (LONGEST if again else COUNTED) + 1)]
        any_rows = False
        for batch in batches:
            for lang, data in _texts(batch):
                any_rows = True
                for words, n in slices(data, _seed(lang)):
                    for k, h, ok in _listed(words, bits, maps) if again else words.phrases(COUNTED):
                        found, many = np.unique(_bucket(h[:n][ok[:n]], k, bits, again), return_counts=True)
                        counts[k - 1][found] = np.minimum(counts[k - 1][found].astype(np.int64) + many, least)
        if any_rows:
            for k, c in enumerate(counts):
                for at in range(0, len(c), CHUNK):
                    part = c[at : at + CHUNK]
                    if part.any():
                        yield pa.RecordBatch.from_pydict({
                            "k": pa.array([k], pa.int32()), "chunk": pa.array([at // CHUNK], pa.int32()),
                            "counts": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary()),
                        })

    return run


def _merge_buckets(least: int):
    kind = np.uint8 if least < 256 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def bits():
            return pa.RecordBatch.from_pydict({
                "k": pa.array([now[0]], pa.int32()), "chunk": pa.array([now[1]], pa.int32()),
                "bits": pa.array([np.packbits(total >= least).tobytes()], pa.binary()),
            })

        for batch in batches:
            for k, chunk, data in zip(*[c.to_pylist() for c in batch.columns]):
                part = np.frombuffer(zlib.decompress(data), dtype=kind).astype(np.int64)
                if now != (k, chunk):
                    if now is not None:
                        yield bits()
                    now, total = (k, chunk), part
                else:
                    total = np.minimum(total + part, least)
        if now is not None:
            yield bits()

    return run


def frequent_buckets(docs: DataFrame, bits: int, least: int, first=None) -> list[bytes]:
    """For each length counted: a bit a bucket, set where a phrase may reach ``least``."""
    again = first is not None
    parts = docs.mapInArrow(_count_buckets(bits, least, first), "k int, chunk int, counts binary")
    merged = parts.repartition("k", "chunk").sortWithinPartitions("k", "chunk").mapInArrow(
        _merge_buckets(least), "k int, chunk int, bits binary"
    )
    out = [bytearray((1 << _bits(k, bits, again)) // 8) for k in range(1, (LONGEST if again else COUNTED) + 1)]
    for k, chunk, data in merged.collect():  # at most COUNTED * 2^MAX_BITS / 8 bytes
        at = chunk * CHUNK // 8
        out[k][at : at + len(data)] = data
    return [bytes(b) for b in out]


# ------------------------------------------------------------------ stripes


_STRIPE = "lang string, k int, prefix string, seg int, words array<string>, counts array<long>"


def _grouped(lang: pa.Array, k: np.ndarray, prefix: pa.Array, seg: np.ndarray, word: pa.Array, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One stripe a (lang, k, prefix, seg) from its entries."""
    if not len(k):
        return
    codes = [np.array(x.dictionary_encode().indices) for x in (lang, prefix)]
    order = np.lexsort((seg, codes[1], k, codes[0]))
    columns = [codes[0][order], k[order], codes[1][order], seg[order]]
    first = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))))
    bounds = np.append(first, len(order))
    heads = pa.array(order[first])
    word, count = word.take(pa.array(order)), pa.array(count[order])
    names = ["lang", "k", "prefix", "seg", "words", "counts"]
    flat = [lang.take(heads), pa.array(columns[1][first]), prefix.take(heads), pa.array(columns[3][first])]
    for at in range(0, len(first), STRIPES_OUT):
        cut = bounds[at : at + STRIPES_OUT + 1]
        offsets = pa.array((cut - cut[0]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, x.slice(cut[0], cut[-1] - cut[0])) for x in (word, count)]
        yield pa.RecordBatch.from_arrays([*[c.slice(at, STRIPES_OUT) for c in flat], *lists], names)


class _Entries:
    """Counts of (prefix, next word) met by a task."""

    def __init__(self):
        self.langs: list[str] = []
        self.prefixes: list[bytes] = []
        self.words: list[bytes] = []
        self.sizes: list[int] = []  # words of the prefix
        self.counts = np.zeros(1024, dtype=np.int64)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by words: sorted hashes and their places
        self.unlisted: dict[str, int] = defaultdict(int)

    def add(self, words: Words, lang: str, k: int, h: np.ndarray, where: np.ndarray) -> None:
        """Phrases of ``k`` words at ``where``, as entries of their first k - 1 words."""
        if not len(where):
            return
        values = h[where]
        found, many = np.unique(values, return_counts=True)
        hashes, places = self.known.get(k, (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)))
        at = np.searchsorted(hashes, found)
        old = np.zeros(len(found), dtype=bool)
        inside = at < len(hashes)
        old[inside] = hashes[at[inside]] == found[inside]
        self.counts[places[at[old]]] += many[old]
        new = found[~old]
        if not len(new):
            return
        spot = np.minimum(np.searchsorted(new, values), len(new) - 1)
        is_new = new[spot] == values
        one = np.empty(len(new), dtype=np.int64)
        one[spot[is_new]] = where[is_new]  # some occurrence of each
        start = len(self.words)
        for i in one.tolist():
            self.prefixes.append(words.text(i, k - 1))
            self.words.append(words.text(i + k - 1, 1))
        self.langs += [lang] * len(new)
        self.sizes += [k - 1] * len(new)
        while len(self.words) > len(self.counts):
            self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
        self.counts[start : len(self.words)] = many[~old]
        hashes = np.concatenate((hashes, new))
        places = np.concatenate((places, np.arange(start, len(self.words))))
        order = np.argsort(hashes)
        self.known[k] = hashes[order], places[order]

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """What is held, as stripes; nothing is held then."""
        more = list(self.unlisted)
        lang = pa.array([*self.langs, *more], pa.string())
        k = np.array([*self.sizes, *[0] * len(more)], dtype=np.int32)
        prefix = pa.array([*self.prefixes, *[b""] * len(more)], pa.binary()).cast(pa.string())
        word = [*self.words, *[b""] * len(more)]
        count = np.concatenate((self.counts[: len(self.words)], np.array(list(self.unlisted.values()), dtype=np.int64)))
        seg = np.array([zlib.crc32(w) % SEGMENTS[n] for w, n in zip(word, k.tolist())], dtype=np.int32)
        self.__init__()
        yield from _grouped(lang, k, prefix, seg, pa.array(word, pa.binary()).cast(pa.string()), count)


def _build_stripes(buckets, bits: int, again=None):
    """Stripes of the phrases listed by the tables (broadcast) of the first pass, and of the second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _maps(buckets.value), _maps(again.value) if again else []
        entries = _Entries()
        for batch in batches:
            for lang, data in _texts(batch):
                for words, n in slices(data, _seed(lang)):
                    if not n:
                        continue
                    for k, h, keep in _listed(words, bits, first, second):
                        if k == 1:
                            entries.unlisted[lang] += int(n - keep[:n].sum())
                        entries.add(words, lang, k, h, np.flatnonzero(keep[:n]))
                    if len(entries.words) >= HELD:
                        yield from entries.stripes()
        yield from entries.stripes()

    return run


def _merge_stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the stripes of each key elementwise; they come sorted by key."""
    key = ["lang", "k", "prefix", "seg"]
    held = None  # the entries of the last key, which may go on

    def entries(batch: pa.RecordBatch) -> pa.Table:
        row = pc.list_parent_indices(batch.column("words"))
        flat = {c: batch.column(c).take(row) for c in key}
        return pa.table({**flat, "word": batch.column("words").flatten(), "n": batch.column("counts").flatten()})

    def merged(t: pa.Table) -> pa.Table:
        return t.group_by([*key, "word"]).aggregate([("n", "sum")]).rename_columns([*key, "word", "n"])

    def out(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        one = {c: (t.column(c).chunk(0) if t.column(c).num_chunks else pa.array([], t.schema.field(c).type)) for c in t.column_names}
        yield from _grouped(one["lang"], np.array(one["k"]), one["prefix"], np.array(one["seg"]), one["word"], np.array(one["n"]))

    for batch in batches:
        if not batch.num_rows:
            continue
        t = entries(batch)
        t = merged(pa.concat_tables([held, t]) if held is not None else t)
        last = batch.slice(batch.num_rows - 1)
        same = functools.reduce(pc.and_, [pc.equal(t.column(c), last.column(c)[0]) for c in key])
        held = t.filter(same)
        yield from out(t.filter(pc.invert(same)))
    if held is not None:
        yield from out(held)


def tasks(size: int, cores: int) -> int:
    """Tasks that read ``size`` characters: up to one a core, of ``TASK_TEXT`` to ``MOST_TEXT``."""
    return max(1, min(-(-size // TASK_TEXT), max(cores, -(-size // MOST_TEXT))))


def built_stripes(docs: DataFrame, least: int, bits: int | None = None) -> DataFrame:
    """Each task's stripes of ``lang`` and ``text`` (neither null)."""
    context = docs.sparkSession.sparkContext
    size = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    if bits is None:
        bits = min(MAX_BITS, max(16, (size // 20).bit_length()))
    docs = docs.coalesce(tasks(size, context.defaultParallelism))
    first = context.broadcast(frequent_buckets(docs, bits, least))
    second = context.broadcast(frequent_buckets(docs, bits, least, first))
    return docs.mapInArrow(_build_stripes(first, bits, second), _STRIPE)


def stripes(docs: DataFrame, least: int, bits: int | None = None) -> DataFrame:
    """Merged stripes of ``lang`` and ``text`` (neither null), written once."""
    key = ["lang", "k", "prefix", "seg"]
    merged = built_stripes(docs, least, bits).repartition(*key).sortWithinPartitions(*key).mapInArrow(_merge_stripes, _STRIPE)
    return materialise(merged, "stripes")


# ------------------------------------------------------------------ phrases


def _words(phrase: str, first: Column | int, count: Column | int) -> Column:
    return F.concat_ws(" ", F.slice(F.split(phrase, " ", -1), first, count))


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = MIN_COUNT, top: int = TOP, bits: int | None = None
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    merged = stripes(docs, least, bits)
    entry = F.inline(F.arrays_zip("words", "counts"))
    listed = merged.select("lang", "k", "prefix", entry)
    # Extensions: the phrases of two words and more that recur often enough.
    phrases = materialise(
        listed.where((F.col("words") != "") & (F.col("counts") >= least)).select(
            "lang", (F.col("k") + 1).alias("k"), "prefix",
            F.when(F.col("k") == 0, F.col("words")).otherwise(F.concat_ws(" ", "prefix", "words")).alias("phrase"),
            F.col("counts").alias("a"),
        ),
        "phrases",
    )
    # Totals of a phrase's parts, which recur at least as often; and of all words.
    part = phrases.where(F.col("k") < LONGEST).select(F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), F.col("a").alias("f"))
    n = listed.where("k = 0").groupBy(F.col("lang").alias("n_lang")).agg(F.sum("counts").alias("n"))
    phrases = phrases.where("k > 1")
    # Subsumption maxima: over a phrase's own stripe, and over the entries that end in it.
    longer = phrases.where("k > 2").select(
        "lang", "a", F.explode(F.array("prefix", _words("phrase", F.lit(2), F.col("k") - 1))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    share, of = SUBSUMED
    alone = (
        phrases.join(longer, ["lang", "phrase"], "left")
        .where(F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * of < F.col("a").cast("decimal(20,0)") * share))
    )
    cuts = alone.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    first = part.select(F.col("p_lang").alias("f_lang"), F.col("part").alias("f_part"), F.col("f").alias("l"))
    rest = part.select(F.col("p_lang").alias("r_lang"), F.col("part").alias("r_part"), F.col("f").alias("r"))
    cuts = cuts.withColumn("head", _words("phrase", F.lit(1), F.col("cut"))).withColumn(
        "tail", _words("phrase", F.col("cut") + 1, F.col("k") - F.col("cut"))
    )
    scored = (
        cuts.join(first, (F.col("lang") == F.col("f_lang")) & (F.col("head") == F.col("f_part")))
        .join(rest, (F.col("lang") == F.col("r_lang")) & (F.col("tail") == F.col("r_part")))
        .withColumn("score", F.expr(f"CAST(a AS DECIMAL(20,0)) * {SCALE} div (CAST(l AS DECIMAL(20,0)) + r)"))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))
        .select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # Ranked and cut as Spark's own row number, so each task gives at most ``top`` rows a language on.
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(n, F.col("lang") == F.col("n_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), range(1, {LONGEST + 1}) t(k)
  WHERE i + k - 1 <= len(ws) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT * FROM g WHERE k > 1 AND f >= {MIN_COUNT}),
m AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:k - 1], ' '), array_to_string(string_split(phrase, ' ')[2:k], ' ')]) AS phrase
    FROM c) GROUP BY ALL),
s AS (
  SELECT c.lang, c.phrase, c.f AS a, cut, x.f AS l, y.f AS r, ({SCALE}::HUGEINT * c.f // (x.f + y.f))::BIGINT AS score
  FROM c LEFT JOIN m USING (lang, phrase), range(1, c.k) t(cut), g x, g y
  WHERE (most IS NULL OR {SUBSUMED[1]}::HUGEINT * most < {SUBSUMED[0]}::HUGEINT * c.f)
    AND x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[1:cut], ' ')
    AND y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[cut + 1:c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= {TOP}
"""

QUERIES = {"op11_collocations": op11_collocations}
ORACLES = {"op11_collocations": ORACLE}
