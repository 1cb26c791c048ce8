"""Line de-duplication with a log-template tree.

A line is a list of tokens; tokens with a digit are variable and read ``<*>``.
The tree has a fixed depth: the number of tokens, then the first ``LEAD``
tokens, lead to a leaf.  In a leaf, lines whose tokens agree at ``SIMILAR`` of
the places or more share a template, and places where they differ become
``<*>`` too.  A template, at least half of its tokens constant, that occurs in
``MIN_DOCS`` documents or more (``LONG_DOCS`` if it has ``LONG`` tokens or more)
is boilerplate: all its lines are dropped.  A line less than half constant has
no template and counts as it is written, digits and all.

1. Each document's lines are hashed (leaf, masked line) in one pass; equal
   masked lines meet as counts, combined before the shuffle.  A masked line in
   enough documents recurs by itself, whatever its length.  Only leaves of two
   lines or more, with enough lines' documents, can hold another recurring
   template; the texts of their distinct lines are fetched in a second pass.
2. A leaf's distinct lines are parsed in chunks of about ``CHUNK``: a line joins
   the first template it is similar to, or starts one.  Templates of
   different chunks are then compared in pairs of blocks, and components of
   similar ones are merged.  No task holds a whole leaf.  A component that is
   less than half constant is taken apart again: its templates join each other
   as lines do, only while what they share is at least half (``regrouped``).
3. Documents per template are counted over all lines, and the hashes of the
   dropped masked lines are sent, in blocks of at most ``SENT`` hashes (a
   fixed bound, more blocks for more hashes), to a last pass over the texts.

Cases: a null text has no lines and stays null; blank lines never drop and
stay; a document's repeated lines count once; repeated rows are documents
each; texts of one very long line are lines as any; an empty table gives an
empty result; other columns are carried in a struct.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, materialise, small_batches, table
from .op9_jaccard import block_pairs, forest, groups

LEAD = 2
SIMILAR = 0.7
MIN_DOCS = 10
LONG = 50  # a line of so many tokens recurs from LONG_DOCS documents
LONG_DOCS = 2
CHUNK = 500
BLOCK = 500
SENT = 4_000_000
VARIABLE = "<*>"
_DIGIT = re.compile(r"[0-9]")


def masked(line: str) -> list[str]:
    tokens = line.split()
    return [VARIABLE if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line) else tokens


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _plain(line: str) -> bool:
    """Is the line its tokens, one blank between them?"""
    return line.isprintable() and line[:1] not in ("", " ") and line[-1] != " " and "  " not in line


def lines_of(text: str | None, leaves: bool = True) -> Iterator[tuple[int, int]]:
    """Leaf (0 unless asked for) and masked-line hash of every line, as ``line_hashes``."""
    if text is None:
        return
    digits = any(d in text for d in "0123456789")
    for line in text.split("\n"):
        if _plain(line) and not (digits and _DIGIT.search(line)):
            # Most lines: nothing to mask, no white space to mend.
            h = _hash(line)
            if leaves:
                n = line.count(" ") + 1
                leaf = _hash(" ".join([str(n), *line.split(" ", LEAD)[:LEAD]]))
                yield leaf | 1 if n >= LONG else leaf & ~1, h
            else:
                yield 0, h
            continue
        tokens = masked(line)
        if not tokens:
            yield 0, 0
            continue
        if 2 * tokens.count(VARIABLE) > len(tokens):
            h = leaf = _hash(f"\n{' '.join(line.split())}")
        else:
            h = _hash(" ".join(tokens))
            leaf = _hash(" ".join([str(len(tokens)), *tokens[:LEAD]])) if leaves else 0
        yield leaf | 1 if len(tokens) >= LONG else leaf & ~1, h


def line_hashes(text: str | None) -> tuple[list[int], list[int]]:
    """Leaf and masked-line hash of every line; blank lines have (0, 0).

    The leaf's lowest bit tells lines of ``LONG`` tokens.  A line less than
    half constant is hashed as written and is a leaf of its own.
    """
    found = list(lines_of(text))
    return [leaf for leaf, _ in found], [h for _, h in found]


def hashes_of(text: str | None) -> np.ndarray:
    return np.array([h for _, h in lines_of(text, leaves=False)], dtype=np.int64)


def enough(min_docs: int) -> Column:
    """The documents that make a line of a leaf recur."""
    return F.when(F.col("leaf").bitwiseAND(F.lit(1)) == 1, min(LONG_DOCS, min_docs)).otherwise(min_docs)


def hash_blocks(hashes: DataFrame, column: str) -> Iterator[np.ndarray]:
    """The column's values as sorted arrays of about SENT values at most."""
    n = max(1, -(-hashes.count() // SENT))
    for b in range(n):
        part = hashes.where(F.pmod(F.col(column), F.lit(n)) == b) if n > 1 else hashes
        yield np.sort(part.select(column).toPandas()[column].to_numpy(dtype=np.int64))


def is_in(values: np.ndarray, block: np.ndarray) -> np.ndarray:
    if not len(block) or not len(values):
        return np.zeros(len(values), dtype=bool)
    return block[np.minimum(np.searchsorted(block, values), len(block) - 1)] == values


def similar(a: list[str], b: list[str]) -> bool:
    same = sum(x == y and x != VARIABLE for x, y in zip(a, b, strict=True))
    fixed = max(1, len(a) - sum(x == VARIABLE or y == VARIABLE for x, y in zip(a, b, strict=True)))
    return same >= SIMILAR * fixed and 2 * same >= len(a)


def grid_of(texts: list[str], ids: dict[str, int] | None = None) -> np.ndarray:
    """The tokens of texts of one length as numbers, ``VARIABLE`` as 0."""
    ids = {VARIABLE: 0} if ids is None else ids
    return np.array([[ids.setdefault(t, len(ids)) for t in text.split(" ")] for text in texts], dtype=np.int32)


def similar_rows(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """``similar`` of each row of a grid and one."""
    same = ((rows == one) & (one > 0)).sum(axis=1)
    fixed = np.maximum(1, ((rows > 0) & (one > 0)).sum(axis=1))
    return (same >= SIMILAR * fixed) & (2 * same >= len(one))


def parse_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk of a leaf: each line's template (named by its first line)."""
    for g in groups(batches, ["leaf", "chunk"]):
        ids = {VARIABLE: 0}
        grid = grid_of(g["text"], ids)
        found = np.empty_like(grid)  # the templates
        names: list[int] = []
        of, seen = [], {}
        for name, line, tokens in zip(g["line"], g["text"], grid, strict=True):
            at = seen.get(line)
            if at is None:
                hits = np.flatnonzero(similar_rows(found[: len(names)], tokens))
                at = int(hits[0]) if len(hits) else None
            if at is None:
                at = len(names)
                names.append(name)
                found[at] = tokens
            else:
                found[at][found[at] != tokens] = 0
            seen[line] = at
            of.append(at)
        words = np.array(list(ids), dtype=object)
        texts = [" ".join(words[row]) for row in found[: len(names)]]
        yield pd.DataFrame({
            "leaf": g["leaf"].to_numpy(), "line": g["line"].to_numpy(),
            "part": [names[i] for i in of], "text": [texts[i] for i in of],
        })


def similar_in(g: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Each template of a pair of blocks and the places of those like it, each pair once."""
    own, bi, bj = g["own"].to_numpy(), int(g["bi"].iloc[0]), int(g["bj"].iloc[0])
    grid = grid_of(g["text"])
    apart = np.flatnonzero(own == bj)
    for i in range(len(grid)):
        others = apart if bi != bj else np.arange(i + 1, len(grid))
        if len(others) and (bi == bj or own[i] == bi):
            hit = others[similar_rows(grid[others], grid[i])]
            if len(hit):
                yield i, hit


def alike_templates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning forest of the similar templates of a pair of blocks of a leaf."""
    for g in groups(batches, ["leaf", "bi", "bj"]):
        left, right = [], []
        for i, hit in similar_in(g):
            left += [i] * len(hit)
            right += hit.tolist()
        names, root = g["part"].to_numpy(), forest(len(g), np.array(left, dtype=int), np.array(right, dtype=int))
        out = np.flatnonzero(root != np.arange(len(g)))
        if len(out):
            yield pd.DataFrame({"a": names[out], "b": names[root[out]]})


def nearest_alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each template of a pair of blocks that is like another: the least such."""
    for g in groups(batches, ["leaf", "bi", "bj"]):
        names = g["part"].to_numpy()
        least: dict[int, int] = {}
        for i, hit in similar_in(g):
            for x, y in ((i, names[hit].min()), *((j, names[i]) for j in hit.tolist())):
                least[x] = min(least.get(x, y), y)
        if least:
            yield pd.DataFrame({"part": names[list(least)], "near": list(least.values())})


def fetcher(shared):
    """Texts of the lines whose hash is in the block, once per batch."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got: dict[int, str] = {}
            for text in batch["text"]:
                if text is None:
                    continue
                lines = hashes_of(text)
                hits = np.flatnonzero(is_in(lines, shared.value))
                if len(hits):
                    raw = text.split("\n")
                    got.update((int(lines[i]), " ".join(masked(raw[i]))) for i in hits.tolist())
            if got:
                yield pd.DataFrame({"line": list(got.keys()), "text": list(got.values())})

    return fetch


def candidate_lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, text) of the distinct masked lines whose hash is wanted."""
    spark, out = docs.sparkSession, None
    for block in hash_blocks(wanted, "line"):
        part = docs.select("text").mapInPandas(fetcher(spark.sparkContext.broadcast(block)), "line long, text string")
        out = part if out is None else out.union(part)
    return out.dropDuplicates(["line"])


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(line): hashes of the masked lines of recurring templates."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("leaves array<long>, lines array<long>")
    def hashed(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([line_hashes(t) for t in text], columns=["leaves", "lines"])

    own = docs.select(F.monotonically_increasing_id().alias("rid"), hashed(F.col("text")).alias("h"))
    own = materialise(own, "lines")
    pairs = F.array_distinct(F.arrays_zip("h.leaves", "h.lines"))
    rows = own.select("rid", F.explode(pairs).alias("p")).select("rid", F.col("p.leaves").alias("leaf"), F.col("p.lines").alias("line"))
    rows = rows.where("line <> 0")
    counts = materialise(rows.groupBy("leaf", "line").agg(F.count("*").alias("docs")), "counts")
    recur = counts.where(F.col("docs") >= enough(min_docs)).select("line")
    leaves = counts.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("lines"))
    leaves = materialise(leaves.where((F.col("lines") > 1) & (F.col("docs") >= enough(min_docs))), "leaves")
    wanted = materialise(counts.select("leaf", "line").join(leaves.select("leaf", "lines"), "leaf"), "wanted")
    texts = materialise(candidate_lines(docs, wanted), "texts")
    lines = wanted.join(texts, "line")
    chunked = lines.withColumn("chunk", F.pmod(F.xxhash64("line"), F.ceil(F.col("lines") / CHUNK).cast("long")))
    chunked = chunked.repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "line")
    parsed = materialise(
        chunked.select("leaf", "chunk", "line", "text").mapInPandas(parse_chunks, "leaf long, line long, part long, text string"),
        "parsed",
    )
    parts = materialise(parsed.select("leaf", "part", "text").distinct(), "parts")
    sizes = parts.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
    work = block_pairs(parts.join(sizes, "leaf"), "leaf", F.ceil(F.col("n") / BLOCK).cast("long"), "part").drop("n")
    work = work.repartition("leaf", "bi", "bj").sortWithinPartitions("leaf", "bi", "bj", "part")
    edges = materialise(work.select("leaf", "bi", "bj", "own", "part", "text").mapInPandas(alike_templates, "a long, b long").distinct(), "alike")
    joined = components(edges, "alike").select(F.col("node").alias("part"), "comp")
    named = F.coalesce("comp", "part").alias("template")
    template = materialise(parsed.join(joined, "part", "left").select("leaf", "line", named), "members")
    often = materialise(often_seen(rows, template, min_docs), "often")
    # Of the recurring merged templates, the constant places: where all parts agree.
    many = parts.join(joined, "part").withColumnRenamed("comp", "template").join(often, "template", "left_semi")
    many = materialise(many.select("template", "part", "text"), "merged")
    tokens = many.select("template", F.posexplode(F.split("text", " ")).alias("i", "t"))
    loose = (
        tokens.groupBy("template", "i").agg(((F.min("t") == F.max("t")) & (F.max("t") != VARIABLE)).alias("fixed"))
        .groupBy("template").agg(F.avg(F.col("fixed").cast("int")).alias("share")).where("share < 0.5").select("template")
    )
    loose = materialise(loose, "loose")
    out = recur.union(template.join(often, "template", "left_semi").join(loose, "template", "left_anti").select("line"))
    if loose.isEmpty():
        return out.distinct()
    groups = regrouped(many.join(loose, "template", "left_semi"))
    template = materialise(parsed.select("leaf", "line", "part").join(groups, "part").select("leaf", "line", F.col("group").alias("template")), "regrouped")
    return out.union(template.join(often_seen(rows, template, min_docs), "template", "left_semi").select("line")).distinct()


def often_seen(rows: DataFrame, template: DataFrame, min_docs: int) -> DataFrame:
    """(template) of the templates in at least so many documents."""
    seen = rows.select("rid", "line").join(template, "line").select("rid", "leaf", "template").distinct()
    return seen.groupBy("leaf", "template").agg(F.count("*").alias("docs")).where(F.col("docs") >= enough(min_docs)).select("template")


def regrouped(parts: DataFrame) -> DataFrame:
    """(part, group): the parts (template, part, text) of each component, joined
    while the shared template is at least half constant.

    Rounds that join what they can in chunks of about ``CHUNK``, dealt anew,
    make the components small.  Then all templates of a component are compared
    in pairs of blocks, and those like another one go to the least such
    (``stars``); the rounds end when no two templates of a component are
    similar.  Each takes at least one template away: the least of all that are
    like another meets its nearest.
    """
    now = parts.select("template", F.col("part").alias("group"), "text")
    of = parts.select("part", F.col("part").alias("group"))
    left, turn, apart = now.count(), 0, True
    while apart:
        sizes = materialise(now.groupBy("template").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks")), "sizes")
        chunk = F.pmod(F.xxhash64("group", F.lit(turn)), F.col("chunks"))
        now, of = rejoined(now, of, now.join(sizes, "template").select("group", F.col("template").alias("leaf"), chunk.alias("chunk")))
        count, turn = now.count(), turn + 1
        apart = not sizes.where("chunks > 1").isEmpty() and count <= 0.95 * left
        left = count
    while not (dealt := stars(now)).isEmpty():
        now, of = rejoined(now, of, dealt)
    return of


def stars(now: DataFrame) -> DataFrame:
    """(group, leaf, chunk): the templates like another of their component, by the least such
    (or themselves), in chunks; the least of a chunk's star goes with its nearest."""
    sizes = now.groupBy("template").agg(F.count("*").alias("n")).where("n > 1")
    work = block_pairs(now.join(sizes, "template"), "template", F.ceil(F.col("n") / BLOCK).cast("long"), "group")
    work = work.select(F.col("template").alias("leaf"), "bi", "bj", "own", F.col("group").alias("part"), "text")
    work = work.repartition("leaf", "bi", "bj").sortWithinPartitions("leaf", "bi", "bj", "part")
    near = work.mapInPandas(nearest_alike, "part long, near long").groupBy("part").agg(F.min("near").alias("near"))
    near = materialise(near.withColumn("leaf", F.least("part", "near")), "near")
    sizes = near.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks"))
    chunk = F.pmod(F.xxhash64(F.greatest("part", F.when(F.col("part") < F.col("near"), F.col("near")))), F.col("chunks"))
    return near.join(sizes, "leaf").select(F.col("part").alias("group"), "leaf", chunk.alias("chunk"))


def rejoined(now: DataFrame, of: DataFrame, dealt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Templates (template, group, text) and groups (part, group) after those
    dealt (group, leaf, chunk) have joined each other as lines do."""
    work = dealt.join(now, "group").select("leaf", "chunk", F.col("group").alias("line"), "text")
    work = work.repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "line")
    done = materialise(work.mapInPandas(parse_chunks, "leaf long, line long, part long, text string"), "regrouping")
    to = done.select(F.col("line").alias("group"), F.col("part").alias("to"))
    of = of.join(to, "group", "left").select("part", F.coalesce("to", "group").alias("group"))
    new = done.select(F.col("part").alias("group"), F.col("text").alias("new")).distinct()
    now = now.join(to, "group", "left").where("to IS NULL OR to = group").drop("to")
    now = now.join(new, "group", "left").select("template", "group", F.coalesce("new", "text").alias("text"))
    return materialise(now, "regrouped"), materialise(of, "groups")


def marker(shared):
    """Bits of a text's lines: those before, and those whose hash is in the block."""

    @F.pandas_udf("binary")
    def marked(text: pd.Series, bits: pd.Series) -> pd.Series:
        rows = []
        for t, b in zip(text, bits, strict=True):
            hit = is_in(hashes_of(t), shared.value)
            if b is not None:
                hit |= np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=len(hit)).astype(bool)
            rows.append(np.packbits(hit).tobytes())
        return pd.Series(rows, dtype=object)

    return marked


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc`` (a struct of docs' columns), n_lines (with a token), n_dropped and
    the text without the dropped lines (``kept``)."""
    spark = docs.sparkSession
    small_batches(spark)
    drop = materialise(recurring_lines(docs, min_docs), "dropped")
    out = docs.select(F.struct("*").alias("doc"), F.col("text"), F.lit(None).cast("binary").alias("bits"))
    for block in hash_blocks(drop, "line"):
        out = out.withColumn("bits", marker(spark.sparkContext.broadcast(block))(F.col("text"), F.col("bits")))

    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def cleaned(text: pd.Series, bits: pd.Series) -> pd.DataFrame:
        rows = []
        for t, b in zip(text, bits, strict=True):
            if t is None:
                rows.append((0, 0, None))
                continue
            lines = t.split("\n")
            hit = np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=len(lines)).astype(bool)
            kept = "\n".join(x for x, h in zip(lines, hit, strict=True) if not h) if hit.any() else t
            rows.append((sum(1 for x in lines if x and not x.isspace()), int(hit.sum()), kept))
        return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])

    return out.withColumn("c", cleaned(F.col("text"), F.col("bits"))).select("doc", "c.n_lines", "c.n_dropped", "c.kept")


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.coalesce(F.length("kept"), F.lit(0)).cast("long").alias("n_chars"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


QUERIES = {"op6_line_templates": op6_line_templates}
ORACLES: dict[str, str] = {}
