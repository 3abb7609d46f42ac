from __future__ import annotations

import hashlib
import random
import re

from sparkingest.llm import secrets
from tests.llm.fixtures import awkward_rows, documents, no_documents

PATTERNS = (
    (
        "assign",
        r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        lambda m: len(m[1]) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def naive(text: str) -> list[tuple[int, int, int]]:
    return sorted(
        (m.start(), kind, m.end())
        for kind, (_, pattern, good) in enumerate(PATTERNS)
        for m in re.finditer(pattern, text)
        if good(m)
    )


def hexes(chooser, n, length=40):
    return ["".join(chooser.choices("0123456789abcdef", k=length)) for _ in range(n)]


def test_base_spans_are_those_of_the_plain_patterns():
    chooser = random.Random(3)
    pieces = [
        "token", "TOKEN", "Api_Key", "apikey", "password", "passwd", "secret", " ", ": ", "=", '"',
        "'", "\n", "AKIA", "ABCDEFGH12345678", "é", "deadbeef", "0123456789", "abc", "ſecret", "  ",
    ]
    for _ in range(3000):
        text = "".join(chooser.choices(pieces, k=chooser.randrange(1, 14)))
        words = secrets.long_words(text)
        assert [x[:3] for x in secrets.base_spans(text, words)] == naive(text), text


def test_states_with_equal_statistics_merge():
    chooser = random.Random(1)
    automaton = secrets.infer_automaton([secrets.symbols(x) for x in hexes(chooser, 300)])
    assert len(automaton.steps) < 200
    fresh = secrets.symbols(hexes(chooser, 1)[0])
    assert automaton.score(fresh) > automaton.score("l" * 40) + 50


def test_grammar_finds_formats_that_no_pattern_names(spark):
    chooser = random.Random(2)
    keys = ["".join(chooser.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=32)) for _ in range(135)]
    plain = ["".join(chooser.choices("abcdefghijklmnopqrstuvwxyz", k=20)) for _ in range(900)]
    rows = [(i, f"set token = {k} now", "en", "s", 0) for i, k in enumerate(keys[:120])]
    rows += [(1000 + i, f"word {p} and more", "en", "s", 0) for i, p in enumerate(plain)]
    rows += [(5000 + i, f"bare é {k} here", "en", "s", 0) for i, k in enumerate(keys[120:])]
    got = {r.doc_id: r for r in secrets.scan_secrets(documents(spark, rows)).collect()}
    assert sum(got[5000 + i].spans == "grammar:7:39" for i in range(15)) >= 10
    assert sum(bool(got[1000 + i].spans) for i in range(900)) <= 3
    for i in range(120):
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (1, 0, 0)
        assert got[i].spans == "assign:4:44"


def test_many_credentials_that_no_pattern_names(spark):
    chooser = random.Random(4)
    keys = ["".join(chooser.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=32)) for _ in range(420)]
    words = ["".join(chooser.choices("abcdefghijklmnopqrstuvwxyz", k=20)) for _ in range(600)]
    rows = [(i, f"set token = {k} now", "en", "s", 0) for i, k in enumerate(keys[:120])]
    rows += [(1000 + i, f"word {w} and more", "en", "s", 0) for i, w in enumerate(words)]
    rows += [(5000 + i, f"bare {k} here", "en", "s", 0) for i, k in enumerate(keys[120:])]
    got = {r.doc_id: r for r in secrets.scan_secrets(documents(spark, rows)).collect()}
    assert sum(got[5000 + i].spans == "grammar:5:37" for i in range(300)) >= 250
    assert sum(bool(got[1000 + i].spans) for i in range(600)) <= 3


def test_awkward_rows(spark):
    got = secrets.scan_secrets(documents(spark)).collect()
    assert len(got) == len(awkward_rows())
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty for r in got)
    assert secrets.scan_secrets(no_documents(spark)).collect() == []


def test_whole_table(spark, sf_dir):
    from sparkingest.llm.queries import QUERIES

    found = {r.doc_id: r for r in QUERIES["op8_secret_scan"](spark, sf_dir).collect()}
    names = [p[0] for p in PATTERNS]
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        base = naive(row.text)
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
        got = found[row.doc_id]
        assert got.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [got.n_assign, got.n_access, got.n_hex] == [
            sum(x[1] == k for x in base) for k in range(3)
        ]
        assert {s for s in listed.split(",") if s} <= set(got.spans.split(","))
