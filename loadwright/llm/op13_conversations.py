"""Conversation structure repair by depth-first branch-and-bound.

``damage`` spoils rows in a fixed way; ``repair_conversations`` finds, for
each conversation, the cheapest edits that make its roles a legal sequence
(an optional system row, then user and assistant in turn) without blank or
repeated rows, and applies them.

The search (``cheapest_edits``) runs on one byte a row (initial of the role
and first fault).  A node is (rows read, last role); its children are the
edits Delete, Insert, Keep and Rerole in that order, so prefixes are visited
in ASCII order.  An explicit stack holds the open nodes.  A child is cut
- by the suffix lower bound: its cost plus a lower bound of what the rows left
  cost from its role cannot beat the incumbent (cost, audit);
- by its node's dominance table: an earlier prefix reached the node at no
  higher cost, and an earlier prefix is the ASCII-lesser one.
An empty stack proves the incumbent optimal.  The suffix bounds come from one
backward sweep over the rows and count insertions too, so few nodes besides
those of optimal prefixes are opened; memory is one entry a node.

In Spark, rows are hashed by conversation and sorted by turn, and Python
streams them: a first stream gathers a conversation's bytes (no texts) and
gives its audit, a second one merges each audit with the texts of its
conversation in order and hashes the repaired rows one by one.  So a task
holds a byte a row and one row's text, however long the conversation; its
audit, which has to be returned as one value, is as long.  Both streams are
functions of their sorted input: a lost executor's part is recomputed alike.

Cases: null role, text, conversation or turn read as one space where text is
needed; rows of a null conversation are one conversation; null turns come
first; rows of one turn are ordered by role, then text, so repeated rows and
ties have one result; a role that does not begin with s, u or a (also an
empty one) cannot be kept; a conversation without rows after the damage has
zeros, an empty audit and the hash of the empty text; an empty table gives an
empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table

KEEP_TRUNCATED, REROLE, DELETE, INSERT = 3, 3, 4, 3
SPACE = " \t\n\x0b\x0c\r"
INITIALS = "sua"
FAULTS = ("blank", "duplicate", "truncated")

# Last role written: none, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEVER = 1 << 60
# Role that an inserted or reroled row must have after each last role.
_DUE = (USER, USER, ASSISTANT, USER)
# Last role after keeping a row with initial s, u, a (or another).
_AFTER_KEEP = (
    (SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None),
)
_ENDS = (START, ASSISTANT)


def code(initial: int, fault: int) -> int:
    """One byte a row: index in ``INITIALS`` (3: another), and 0 or 1 + index in ``FAULTS``."""
    return initial * 4 + fault


def _edits(code: int, last: int) -> list[tuple[str, int, int]]:
    """(letter, cost, last role) of the edits that read a row, in ASCII order."""
    initial, fault = divmod(code, 4)
    out = [("D", DELETE, last)]
    if fault in (1, 2):
        return out
    more = KEEP_TRUNCATED if fault == 3 else 0
    kept = _AFTER_KEEP[last][initial]
    if kept is not None:
        out.append(("K", more, kept))
    out.append(("R", REROLE + more, _DUE[last]))
    return out


_EDITS = [[_edits(c, last) for last in range(4)] for c in range(16)]


def suffix_bounds(codes: bytes) -> list[tuple[int, int, int, int]]:
    """Least cost of the rows from each place on, after each last role."""

    def with_inserts(cost: list[int]) -> tuple[int, ...]:
        for _ in range(2):  # two insertions lead back to the same due role
            cost = [min(cost[s], INSERT + cost[_DUE[s]]) for s in range(4)]
        return tuple(cost)

    bounds = [with_inserts([0 if s in _ENDS else _NEVER for s in range(4)])]
    for c in reversed(codes):
        after = bounds[-1]
        bounds.append(with_inserts([min(cost + after[s] for _, cost, s in _EDITS[c][last]) for last in range(4)]))
    bounds.reverse()
    return bounds


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Least cost and, among the cheapest, the ASCII-least audit."""
    n = len(codes)
    bounds = suffix_bounds(codes)
    reached: dict[int, int] = {}  # dominance: least cost of a prefix at a node
    best_cost, best = _NEVER, ""
    path: list[str] = []
    stack = [(0, START, 0, 0, "")]  # rows read, last role, cost, edits before, letter
    while stack:
        i, last, cost, depth, letter = stack.pop()
        if cost + bounds[i][last] >= best_cost:
            continue  # equal cost: the incumbent came first, so its audit is less
        node = i * 4 + last
        if reached.get(node, _NEVER) <= cost:
            continue
        reached[node] = cost
        if letter:
            del path[depth - 1 :]
            path.append(letter)
        if i == n and last in _ENDS:
            best_cost, best = cost, "".join(path)
            continue  # more insertions only cost more
        children = [(INSERT, i, _DUE[last], "I")]
        if i < n:
            rows = [(c, i + 1, s, x) for x, c, s in _EDITS[codes[i]][last]]
            children = [rows[0], *children, *rows[1:]]  # D, I, K, R
        for c, j, s, x in reversed(children):
            if cost + c + bounds[j][s] < best_cost:
                stack.append((j, s, cost + c, depth + 1, x))
    return best_cost, best


# ------------------------------------------------------------------ rows


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped of the damaged rows; a dropped row
    stays, marked, so that its conversation is known."""

    def read(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    out = rows.select(
        "conv_id", "turn", kind.alias("kind"),
        F.when(kind == 4, F.lit("user")).otherwise(read("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(read("text"), ".!?", "")).otherwise(read("text")).alias("text"),
    )
    twice = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return out.select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("dropped"), twice).drop("copy")


def coded(rows: DataFrame) -> DataFrame:
    """Adds ``code``: initial and first fault; -1 for a dropped row.

    The rows are hashed by conversation, which also places the window that
    finds repeated rows, so the table is shuffled once.
    """
    rows = rows.repartition("conv_id")
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(end == "", 1).when(F.col("seen") > 1, 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    )
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    # Repeated rows of one turn lie in the order of ``seen``: the first of them is no duplicate.
    rows = rows.withColumn("seen", F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "text").orderBy("turn")))
    return rows.withColumn("code", F.when(F.col("dropped"), -1).otherwise(initial * 4 + fault).cast("int"))


_STATS = [*FAULTS, "illegal", "gaps", "cost"]
_LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au


class _Conversation:
    """What is kept of one conversation while its rows stream by."""

    def __init__(self):
        self.codes = bytearray()
        self.first = self.turn = None
        self.turns = 0

    def add(self, turn, code: int) -> None:
        if code < 0:
            return
        self.codes.append(code)
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1

    def row(self) -> tuple:
        codes = bytes(self.codes)
        faults = [sum(codes.count(code(i, f + 1)) for i in range(4)) for f in range(3)]
        illegal = sum((a >> 2, b >> 2) not in _LEGAL for a, b in zip(codes, codes[1:]))
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        cost, audit = cheapest_edits(codes)
        return (*faults, illegal, gaps, cost, audit)


def _audits(id_type: pa.DataType):
    names = ["conv_id", *_STATS, "audit"]
    types = [id_type, *[pa.int64()] * len(_STATS), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, state = [], None, None

        def flush():
            rows = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

        for batch in batches:
            for conv, turn, c in zip(*[batch.column(k).to_pylist() for k in ("conv_id", "turn", "code")]):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, *state.row()))
                    now, state = conv, _Conversation()
                state.add(turn, c)
            if done:
                yield flush()
        if state is not None:
            done.append((now, *state.row()))
            yield flush()

    return run


class _Repair:
    """Applies an audit to the rows as they come; yields the repaired ones."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, START

    def _write(self, role: str, text: str) -> tuple[str, str]:
        self.last = 1 + INITIALS.index(role[0])
        return role, text

    def _due(self) -> str:
        return ("", "", "user", "assistant")[_DUE[self.last]]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._write(self._due(), "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._write(role if edit == "K" else self._due(), text)


def _hashes(id_type: pa.DataType):
    names = ["conv_id", *_STATS, "audit", "repaired_sha256"]
    types = [id_type, *[pa.int64()] * len(_STATS), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = repair = digest = None

        def feed(rows) -> None:
            nonlocal first
            for role, text in rows:
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False

        def end() -> None:
            feed(repair.inserted())
            done.append((*now, digest.hexdigest()))

        def flush():
            rows = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

        first = True
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("conv_id", *_STATS, "audit", "role", "text", "dropped")]
            for *head, role, text, dropped in zip(*columns):
                if head[-1] is not None:  # the audit comes before its conversation's rows
                    if repair is not None:
                        end()
                    now, repair, digest, first = head, _Repair(head[-1]), hashlib.sha256(), True
                elif not dropped:
                    feed(repair.row(role, text))
            if done:
                yield flush()
        if repair is not None:
            end()
            yield flush()

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text and
    ``dropped``, as ``damage`` returns them): its faults, the cheapest edits
    and a hash of the repaired rows."""
    small_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    id_field = T.StructField("conv_id", kind)
    stats = [T.StructField(c, T.LongType()) for c in _STATS]
    audit = T.StructField("audit", T.StringType())
    rows = coded(rows)
    audits = (
        rows.sortWithinPartitions("conv_id", "turn", "role", "text", "seen")
        .select("conv_id", "turn", "code")
        .mapInArrow(_audits(_arrow(kind)), T.StructType([id_field, *stats, audit]))
    )
    nothing = [F.lit(None).cast("long").alias(c) for c in _STATS]
    # Dropped rows come along: both streams then read one shuffle.
    texts = rows.select(
        "conv_id", *nothing, F.lit(None).cast("string").alias("audit"), F.lit(1).alias("part"), "turn", "role", "text", "seen",
        "dropped",
    )
    heads = audits.select(
        "conv_id", *_STATS, "audit", F.lit(0).alias("part"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("seen"),
        F.lit(False).alias("dropped"),
    )
    merged = heads.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "text", "seen")
    out = T.StructType([id_field, *stats, audit, T.StructField("repaired_sha256", T.StringType())])
    return merged.drop("part", "turn", "seen").mapInArrow(_hashes(_arrow(kind)), out)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damage(table(spark, sf_dir, "conversations"))
    return repair_conversations(rows).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


ORACLE = r"""
WITH RECURSIVE
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM k, range(2) t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM d),
o AS (
  SELECT conv_id, turn, role, text, seen,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS c
  FROM e),
f AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o),
-- st: 0 nothing yet, 1 system, 2 user, 3 assistant; ins: a row put in after st (twice leads on as far as needed).
ins(st, put, cost, s, x) AS (VALUES (0,0,0,0,''), (1,0,0,1,''), (2,0,0,2,''), (3,0,0,3,''),
  (0,1,3,2,'I'), (1,1,3,2,'I'), (2,1,3,3,'I'), (3,1,3,2,'I'), (0,2,6,3,'II'), (1,2,6,3,'II'), (2,2,6,2,'II'), (3,2,6,3,'II')),
p(conv_id, i, st, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, '000000000' FROM f
  UNION ALL
  SELECT conv_id, i, st, min(lpad(CAST(cost AS VARCHAR), 9, '0') || audit) FROM (
    SELECT p.conv_id, f.i, y.x, best[1:9]::BIGINT + ins.cost + CASE y.x WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
        + CASE WHEN y.x <> 'D' AND fault = 3 THEN 3 ELSE 0 END AS cost,
      best[10:] || ins.x || y.x AS audit,
      CASE WHEN y.x = 'D' THEN ins.s WHEN y.x = 'R' THEN CASE WHEN ins.s = 2 THEN 3 ELSE 2 END
        WHEN c = 's' THEN 1 WHEN c = 'u' THEN 2 ELSE 3 END AS st
    FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1 JOIN ins USING (st), (VALUES ('D'), ('K'), ('R')) y(x)
    WHERE y.x = 'D' OR (fault IN (0, 3) AND (y.x = 'R' OR (c = 's' AND ins.s = 0) OR (c = 'u' AND ins.s <> 2) OR (c = 'a' AND ins.s = 2))))
  GROUP BY conv_id, i, st),
w AS (
  SELECT conv_id, min(lpad(CAST(best[1:9]::BIGINT + ins.cost AS VARCHAR), 9, '0') || best[10:] || ins.x) AS best
  FROM p JOIN ins USING (st) JOIN (SELECT conv_id AS c2, max(i) AS n FROM f GROUP BY 1) ON conv_id IS NOT DISTINCT FROM c2 AND i = n
  WHERE ins.s IN (0, 3) GROUP BY conv_id),
-- Letters of the audit with the row each one reads and the place of its result.
l AS (
  SELECT conv_id, pos, best[9 + pos] AS x,
    sum(CASE WHEN best[9 + pos] <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS i,
    sum(CASE WHEN best[9 + pos] <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS place
  FROM (SELECT conv_id, best, unnest(range(1, length(best) - 8)) AS pos FROM w)),
r AS (
  SELECT l.conv_id, pos, x, place, f.role, CASE WHEN x = 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN place = 1 AND x = 'K' AND c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS headed
  FROM l LEFT JOIN f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.i = f.i AND x <> 'I' WHERE x <> 'D'),
h AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN x = 'K' THEN role WHEN (place - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY pos)) AS repaired_sha256
  FROM r GROUP BY conv_id),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    sum((fault = 1)::INT)::BIGINT AS blank, sum((fault = 2)::INT)::BIGINT AS duplicate, sum((fault = 3)::INT)::BIGINT AS truncated,
    sum((i > 1 AND before || c NOT IN ('su', 'ua', 'au'))::INT)::BIGINT AS illegal
  FROM f GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.best[1:9]::BIGINT, 0) AS cost,
  coalesce(w.best[10:], '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN g ON a.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN w ON a.conv_id IS NOT DISTINCT FROM w.conv_id
LEFT JOIN h ON a.conv_id IS NOT DISTINCT FROM h.conv_id
"""

QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLES = {"op13_conversation_repair": ORACLE}
