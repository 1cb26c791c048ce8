"""Spans against a plain search, and entropy against a direct count."""

import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from loadwright.llm import op3_secrets as s


def brute_base(text):
    spec = [
        ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), lambda m: len(m[1]) >= 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
    ]
    out = [(m.start(), m.end(), k) for k, p, ok in spec for m in p.finditer(text) if ok(m)]
    return sorted(out, key=lambda x: (x[0], s.KINDS.index(x[2])))


PARTS = st.sampled_from([
    "token", "Secret", "api_key", "API-KEY", "password", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "deadbeef",
    "longvalue123", "é", "\n", "Q9x2Lm4Kp7Rt1Vz8Bn3Ws6", "a", "-", "ſecret",
])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_base_spans_like_brute_force(text):
    assert [x for x in s.find_secrets(text) if x[2] != "entropy"] == brute_base(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAB01xyz9/", min_size=0, max_size=60), st.floats(1.0, 4.0))
def test_incremental_entropy(text, threshold):
    good = []
    for i in range(len(text) - s.WINDOW + 1):
        c = Counter(text[i : i + s.WINDOW])
        h = -sum(v / s.WINDOW * math.log2(v / s.WINDOW) for v in c.values())
        if abs(h - threshold) < 1e-6:
            return
        if h >= threshold:
            good.append(i)
    covered = {p for i in good for p in range(i, i + s.WINDOW)}
    assert {p for a, b in s.entropy_runs(text, threshold) for p in range(a, b)} == covered


def test_entropy_spans_and_allow_list():
    random = "Q9x2Lm4Kp7Rt1Vz8Bn3Ws6"
    assert s.find_secrets(f"see {random} now") == [(4, 4 + len(random), "entropy")]
    assert s.find_secrets("id 550e8400-e29b-41d4-a716-446655440000 and thisisaverylongplainword") == []
    assert s.find_secrets(f"see {random} now", allow=("Q9.*",)) == []
    assert [k for _, _, k in s.find_secrets(f"token={random}")] == ["assign"]


def test_secrets_beside_base_spans_and_sample_values():
    secret, digest = "Q9x2Lm4Kp7Rt1Vz8Bn3Ws6Yd", "0123456789abcdef" * 2
    text = f"sk_live_{digest}_{secret} end"
    got = s.find_secrets(text)
    assert (8, 40, "hex") in got and secret not in s.redacted(text, got) and "Q9x2" not in s.redacted(text, got)
    for text in (f"example_key={secret}", f"docs/example/{secret}"):
        got = s.find_secrets(text)
        assert [k for *_, k in got] == ["entropy"] and secret not in s.redacted(text, got)
    assert s.find_secrets("AWSKEY7MDENG9bPxRfiCYEXAMPLEKEY") == []


def test_addresses_titles_and_names_are_no_secrets():
    for text in (
        "https://example.com/2024/Some-Long-Article-Title-About-Things-v2/index.html",
        "see /var/log/2024-05-01/application_server_debug.log and src/main/java/OurOldServiceFactoryBean",
        "someVeryLongVariableNameForTheUser THIS_IS_A_LONG_CONSTANT_2 a-title-of-many-words-and-one-2024",
    ):
        assert s.find_secrets(text) == [], text


def test_random_letters_of_both_cases():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = 0
    for _ in range(300):
        key = "".join(rng.choice(letters) for _ in range(40))
        text = f"the key {key} is old"
        found += any(k == "entropy" and b - a >= s.WINDOW and 8 <= a and b <= 48 for a, b, k in s.find_secrets(text))
    assert found >= 285


def test_keys_in_groups_are_found():
    for key in ("k3jd-92hf-x7pq-10zm-4vbn-8rty", "QWER-1234-TYUI-5678-OPAS-9012"):
        assert [k for *_, k in s.find_secrets(f"use {key} now")] == ["entropy"], key


def test_null_empty_and_redaction():
    assert s.find_secrets(None) == [] and s.find_secrets("") == [] and s.redacted(None, []) is None
    text = 'x token = "abcDEF123456" y'
    assert s.redacted(text, s.find_secrets(text)) == 'x [assign]" y'
