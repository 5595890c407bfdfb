"""The one-pass automaton against regular expressions, and the digest of op10 over a whole table."""

import hashlib
import random
import re
import time

import pytest

from skyledger.llm import queries, secrets

SF = "/root/testdata/sf0.001"
RULES = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", lambda m: len(m[0]) >= 40),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]+", lambda m: len(m[0]) >= 15),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", lambda m: len(m[0]) >= 30),
    "private_key": (r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", lambda m: True),
}
COMPILED = [(k, re.compile(p, re.A), ok) for k, (p, ok) in RULES.items()]


def _spans(text):
    found = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(COMPILED) for m in p.finditer(text or "") if ok(m)]
    return [(COMPILED[i][0], a, e) for a, i, e in sorted(found)]


@pytest.fixture(scope="module")
def scanner():
    return secrets.Scanner()


def test_random_strings_by_regex(scanner):
    rng = random.Random(11)
    bits = ["token", "SECRET", "password", "Passwd", "api_key", "apikey", "api", "key", "=", ":", " ", "'", '"', "AKIA", "AKI", "A1B2C3D4E5F6G7", "0123456789ab", "deadbeef", "f", "\n", "é", "中", "😀", "ſecret",
            "x", "abc", "/", "-", "_", ".", "eyJ", "eyJhbGciOi", "eyJhbGciOiJIUzI1.eyJzdWIiOi", ".sIgNaTuRe", "ghp_", "ghs", "xoxb-", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "A" * 30, "\x00", "Ab3" * 12]
    hits = dict.fromkeys(RULES, 0)
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 16)))
        expected = _spans(text)
        assert scanner.spans(text) == expected, repr(text)
        for kind, _, _ in expected:
            hits[kind] += 1
    assert min(hits.values()) > 20


def test_long_runs_take_time_in_proportion(scanner):
    for run in ("0123456789abcdef", "token=secret= ", "eyJa.", "AKIA", "-----BEGIN "):
        text = run * (1_000_000 // len(run))
        began = time.process_time()
        found = scanner.spans(text)
        assert time.process_time() - began < 10
        assert run[0] != "0" or found == [("hex", 0, 1_000_000)]


#: More rules of the token kind: head, tail, least characters.
TOKENS = [
    ("sk_live_", "[A-Za-z0-9]+", 20), ("AIza", "[A-Za-z0-9_-]+", 39), ("glpat-", "[A-Za-z0-9_-]+", 26), ("npm_", "[A-Za-z0-9]+", 40),
    ("hf_", "[A-Za-z]+", 30), ("dop_v1_", "[a-f0-9]+", 71), ("SG.", "[A-Za-z0-9_-]+", 20), ("shpat_", "[a-fA-F0-9]+", 38),
    ("pypi-", "[A-Za-z0-9_-]+", 30), ("rk_test_", "[A-Za-z0-9]+", 20), ("ya29.", "[A-Za-z0-9_-]+", 20), ("EAAC", "[A-Za-z0-9]+", 20),
    ("lin_api_", "[A-Za-z0-9]+", 20), ("dapi", "[a-h0-9]+", 20), ("PMAK-", "[A-Za-z0-9-]+", 20), ("xkeysib-", "[a-f0-9-]+", 20),
    ("key-", "[a-z0-9]+", 20), ("sq0atp-", "[A-Za-z0-9_-]+", 20),
]


@pytest.fixture(scope="module")
def many():
    began = time.process_time()
    rules = (*secrets.RULES, *(secrets.Rule(f"k{i}", head.replace(".", r"\."), tail, least=n) for i, (head, tail, n) in enumerate(TOKENS)))
    scanner = secrets.Scanner(rules)
    assert time.process_time() - began < 10
    return scanner


@pytest.mark.parametrize("states", [secrets.STATES, 40])
def test_many_rules_in_one_pass(many, monkeypatch, states):
    """25 rules, also with so few states that they are forgotten within a text."""
    monkeypatch.setattr(many.automaton, "states", states)
    many._forget()
    compiled = [*COMPILED, *((f"k{i}", re.compile(re.escape(h) + t, re.A), lambda m, n=n: len(m[0]) >= n) for i, (h, t, n) in enumerate(TOKENS))]
    rng = random.Random(states)
    bits = ["token", "=", ": ", "'", "AKIA", "A1B2C3D4E5F6G7", "0123456789ab", "deadbeef", "\n", "é", " ", "-", "_", "eyJhbGciOi", ".sIgN", "ghp_", "xoxb-", "-----BEGIN ", "PRIVATE KEY-----", "Ab3" * 12, "abc" * 12, "0123456789ab" * 6, "token=", "AKIAA1B2C3D4E5F6G7", *(h for h, _, _ in TOKENS)]
    hits = dict.fromkeys((k for k, _, _ in compiled), 0)
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 20)))
        found = sorted((m.start(), i, m.end()) for i, (_, p, ok) in enumerate(compiled) for m in p.finditer(text) if ok(m))
        assert many.spans(text) == [(compiled[i][0], a, e) for a, i, e in found], repr(text)
        assert len(many.rows) <= states
        for _, i, _ in found:
            hits[compiled[i][0]] += 1
    assert min(hits.values()) > 3


def test_rules_that_one_pass_cannot_tell_are_refused():
    with pytest.raises(ValueError, match="later start"):
        secrets.Automaton((secrets.Rule("y", "(abbbbc|bb)", "d*"),))


def test_digest_over_a_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op10_secret_scan(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    joined = lambda spans: ",".join(f"{k}:{a}:{e}" for k, a, e in spans)
    for r in rows:
        spans = _spans(texts[r.doc_id])
        base = [s for s in spans if s[0] in secrets.BASE]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in secrets.BASE)
        assert (r.base_sha256, r.spans) == (hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))
