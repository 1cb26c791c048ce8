"""Secret scan: fixed patterns, plus sliding-window entropy over candidates.

Base kinds are patterns (assignments, access keys, long hex strings).  The
method then looks at candidate strings, runs of at least ``WINDOW``
characters of ``[A-Za-z0-9+/=_-]`` with a letter and a digit, or with letters
whose case changes as in random ones (``scrambled``): a window of
``WINDOW`` characters slides over each, keeping the counts of its characters
and their Shannon entropy by increments.  Windows whose entropy reaches the
threshold of the string's character class (hex, one letter case, mixed)
make a span of kind ``entropy``.  Strings that match the allow list (UUIDs,
version strings, dates) or are made of words and numbers, as addresses and
titles are (``plain``), are left out; sample values are left out by the
piece between ``/`` ``=`` ``_``, the rest of the string is not.  Of an entropy
span, the parts inside base spans are left to those, the parts outside kept.

Spans are code points, end exclusive, and cover a pattern's whole match.

Cases: a null text is empty and has no spans; nothing is cut off, a text of
any length is searched whole; repeated rows give equal results; an empty
table gives an empty result; other columns pass through, but for one of the
result's own name, which it replaces.
"""

from __future__ import annotations

import hashlib
import math
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

WINDOW = 20
# Bits a character, by class; a window of 20 has at most log2(20) = 4.32.
ENTROPY = {"hex": 3.0, "one_case": 3.6, "mixed": 3.9}
LEAST = 8  # characters of a part of a span, as short as the shortest assigned secret
KINDS = ("assign", "access", "hex", "entropy")
ALLOW_LIST = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
    r"v?\d+(?:[._-]\d+)*(?:[-_+][A-Za-z]+[._-]?\d*)*",  # versions, dates, numbers
    r"[^/=_]*(?:EXAMPLE|example|xxxx|XXXX|0000000000|1234567890)[^/=_]*",  # sample values
)
# Pieces of a plain string: a word (a vowel in it, no case but a first capital,
# or all capitals), a number or a version.
_PLAIN = re.compile(r"(?=[A-Za-z]*[aeiouyAEIOUY])(?:[A-Z]?[a-z]+|[A-Z]+)\d{0,4}|v?\d+", re.ASCII)
_SAMPLE = re.compile(r"EXAMPLE|example|xxxx|XXXX|0000000000|1234567890")
_PIECE = re.compile(r"[^/=_]+")

_ASSIGN = re.compile(
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{%d,}" % WINDOW)
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost, not overlapping matches of each pattern; failing ones dropped."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def entropy_runs(s: str, threshold: float) -> list[tuple[int, int]]:
    """Joined windows of the string with at least so many bits a character."""
    counts: dict[str, int] = {}
    total = 0.0  # sum of c log2 c over the window's characters
    runs: list[tuple[int, int]] = []
    top = math.log2(WINDOW)
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += _TERM[c + 1] - _TERM[c] if c < WINDOW else 0.0
        counts[ch] = c + 1
        start = i - WINDOW + 1
        if start < 0:
            continue
        if top - total / WINDOW >= threshold - 1e-9:
            if runs and start <= runs[-1][1]:
                runs[-1] = (runs[-1][0], i + 1)
            else:
                runs.append((start, i + 1))
        out = s[start]
        c = counts[out]
        total += _TERM[c - 1] - _TERM[c]
        counts[out] = c - 1
    return runs


def plain(s: str) -> bool:
    """Is the string words and numbers between separators, mostly words?

    Keys in groups ("abcd-1234-efgh-5678") have more digits than a quarter.
    """
    pieces = [p for p in re.split(r"[-_/=+]", s) if p]
    return 4 * sum(map(str.isdigit, s)) <= len(s) and all(
        _PLAIN.fullmatch(p) or (len(p) <= 4 and p.isalpha()) for p in pieces
    )


def scrambled(s: str) -> bool:
    """Do capitals and small letters mix as in random letters?

    Half of such letters are capitals and half of the neighbours differ in
    case.  Names written in capitals within ("someLongName") have fewer
    capitals; letters of one case cannot be told from words.
    """
    letters = [c.isupper() for c in s if c.isalpha()]
    changes = sum(a != b for a, b in zip(letters, letters[1:], strict=False))
    return len(letters) >= LEAST and 3 * len(letters) <= 10 * sum(letters) <= 7 * len(letters) and 3 * changes >= len(letters) - 1


def secret_like(s: str) -> bool:
    return bool(re.search(r"[0-9]", s) and re.search(r"[A-Za-z]", s)) or scrambled(s)


def char_class(s: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    return "mixed" if re.search(r"[a-z]", s) and re.search(r"[A-Z]", s) else "one_case"


def find_secrets(text: str | None, allow: tuple[str, ...] = ALLOW_LIST) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start, then kind as listed."""
    text = text or ""
    longest = max(map(len, text.split()), default=0)
    if longest < 16 and ":" not in text and "=" not in text:
        return []
    spans = base_spans(text)
    base = sorted((a, b) for a, b, _ in spans)
    if longest >= WINDOW:
        allowed = re.compile("|".join(f"(?:{a})" for a in allow)) if allow else None
        for m in _CANDIDATE.finditer(text):
            s = m.group()
            if not secret_like(s) or plain(s) or (allowed and allowed.fullmatch(s)):
                continue
            # Pieces of the allow list are taken, so a secret beside them is still seen.
            taken = base
            if allowed:
                sample = [(p.start() + m.start(), p.end() + m.start()) for p in _PIECE.finditer(s) if _SAMPLE.search(p.group()) and allowed.fullmatch(p.group())]
                taken = sorted(base + sample) if sample else base
            for a, b in entropy_runs(s, ENTROPY[char_class(s)]):
                for x, y in outside(a + m.start(), b + m.start(), taken):
                    if y - x >= LEAST and secret_like(text[x:y]) and not plain(text[x:y]):
                        spans.append((x, y, "entropy"))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def outside(a: int, b: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a span outside the (sorted) taken ones."""
    out = []
    for x, y in taken:
        if x >= b:
            break
        if y > a:
            if x > a:
                out.append((a, x))
            a = max(a, y)
    return [*out, (a, b)] if a < b else out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redacted(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every span replaced by its kind in brackets."""
    if text is None:
        return None
    out, last = [], 0
    for a, b, k in spans:
        if a >= last:
            out += [text[last:a], f"[{k}]"]
        last = max(last, b)
    return "".join(out) + text[last:]


def scan_secrets(docs: DataFrame, redact: bool = False) -> DataFrame:
    """``docs`` plus a struct ``secrets``: counts, base_sha256, spans, and with
    ``redact`` the text without its secrets."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string, redacted string")
    def found(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            spans = find_secrets(t)
            counts = [sum(k == kind for _, _, k in spans) for kind in KINDS]
            base = joined([s for s in spans if s[2] != "entropy"])
            rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), joined(spans), redacted(t, spans) if redact else None))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans", "redacted"])

    return docs.withColumn("secrets", found(F.col("text")))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cols = ("n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans")
    return scan_secrets(docs).select("doc_id", *[F.col("secrets").getField(c).alias(c) for c in cols])


QUERIES = {"op3_secrets": op3_secrets}
ORACLES: dict[str, str] = {}
