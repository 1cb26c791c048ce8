"""The branch-and-bound search against all edit sequences, and one conversation by hand."""

import hashlib
import itertools
import random
import re

from loadwright.llm.op13_conversations import _EDITS, cheapest_edits, code, repair_conversations

LEGAL = re.compile(r"(s?(ua)+)?")


def brute_force(codes):
    """All audits of ``codes`` with up to two insertions at each place."""
    best = None
    puts = [""] + ["".join(p) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    choices = []
    for c in codes:
        initial, fault = divmod(c, 4)
        more = 3 if fault == 3 else 0
        edits = [("D", 4, "")]
        if fault in (0, 3):
            edits += [("K", more, "suao"[initial]), ("R", 3 + more, "u"), ("R", 3 + more, "a")]
        choices.append(edits)
    for rows in itertools.product(*choices):
        for ins in itertools.product(puts, repeat=len(codes) + 1):
            roles = ins[0] + "".join(r[2] + i for r, i in zip(rows, ins[1:]))
            if LEGAL.fullmatch(roles):
                cost = sum(r[1] for r in rows) + 3 * sum(map(len, ins))
                audit = "I" * len(ins[0]) + "".join(r[0] + "I" * len(i) for r, i in zip(rows, ins[1:]))
                if best is None or (cost, audit) < best:
                    best = cost, audit
    return best


def test_search_finds_the_cheapest_and_least_audit():
    kinds = [code(i, f) for i in range(4) for f in (0, 1, 3)]
    for n in range(3):
        for codes in itertools.product(kinds, repeat=n):
            assert cheapest_edits(bytes(codes)) == brute_force(codes), codes
    rng = random.Random(1)
    for _ in range(60):
        codes = [rng.choice(kinds) for _ in range(3)]
        assert cheapest_edits(bytes(codes)) == brute_force(codes), codes


def by_tables(codes):
    """Forward tables of (cost, audit) over all places: no stack, no bounds."""
    state = {0: (0, "")}

    def inserted(state):
        for _ in range(2):
            for s, (cost, audit) in list(state.items()):
                t = 3 if s == 2 else 2
                state[t] = min(state.get(t, (1 << 40, "")), (cost + 3, audit + "I"))
        return state

    for c in codes:
        new = {}
        for s, (cost, audit) in inserted(state).items():
            for x, more, t in _EDITS[c][s]:
                new[t] = min(new.get(t, (1 << 40, "")), (cost + more, audit + x))
        state = new
    state = inserted(state)
    return min(state[s] for s in (0, 3) if s in state)


def test_long_conversations_stay_linear():
    rng = random.Random(2)
    for n in (50, 400, 3000):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 4, 5, 7, 8, 8, 9, 11, 12, 15]) for _ in range(n))
        assert cheapest_edits(codes) == by_tables(codes)


def test_one_conversation_by_hand(spark):
    rows = [(7, 1, "system", "Be kind.", False), (7, 2, "user", "Hi there.", False), (7, 5, "user", "Hi there.", False),
            (7, 6, "tool", "An answer", False), (7, None, "user", " ", False), (8, 1, "user", "gone", True)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, dropped boolean")
    got = {r["conv_id"]: r.asDict() for r in repair_conversations(df).collect()}
    text = "system:Be kind.\nuser:Hi there.\nassistant:An answer"
    # blank row first (null turn), then kept, kept, duplicate, truncated and reroled
    assert got[7] == {"conv_id": 7, "blank": 1, "duplicate": 1, "truncated": 1, "illegal": 3, "gaps": 2, "cost": 4 + 4 + 6,
                      "audit": "DKKDR", "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
    assert got[8]["audit"] == "" and got[8]["cost"] == 0 and got[8]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_conversations_do_not_depend_on_the_batches(spark, monkeypatch):
    rows = [(c, t, "user" if t % 3 else "assistant", f"t{t % 17}" + "." * (t % 2), False) for c in range(3) for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, dropped boolean")
    want = sorted(map(tuple, repair_conversations(df).collect()))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        assert sorted(map(tuple, repair_conversations(df.repartition(5, "turn")).collect())) == want
    finally:
        spark.conf.set(key, before)
