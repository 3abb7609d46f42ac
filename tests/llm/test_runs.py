"""Periodic runs against brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sparkingest.llm import runs as r
from sparkingest.llm.queries import QUERIES
from tests.llm.fixtures import awkward_rows, documents, no_documents, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words: list, least: int) -> list[tuple[int, int, int]]:
    """All maximal stretches of each period, the smallest period for equal stretches."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        t = 0
        while t + q < n:
            begin = t
            while t + q < n and words[t] == words[t + q]:
                t += 1
            if t - begin + q >= max(least, 2 * q):
                found.setdefault((begin, t - begin + q), q)
            t += t == begin
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda x: (x[0], x[2]))


def names(words: list) -> np.ndarray:
    seen: dict = {}
    return np.array([seen.setdefault(w, i) for i, w in enumerate(words)], dtype=np.int64)


def strings(seed: int):
    """Random, periodic, Fibonacci and nested periodic strings over few letters."""
    rng = random.Random(seed)
    for turn in range(150):
        letters = rng.choice([1, 2, 2, 3])
        some = lambda n: [rng.randrange(letters) for _ in range(n)]  # noqa: B023, E731
        if turn % 4 == 0:
            yield some(rng.randrange(0, 80))
        elif turn % 4 == 1:
            unit = some(rng.randrange(1, 25))
            yield some(rng.randrange(20)) + (unit * 6)[: rng.randrange(2 * len(unit), 6 * len(unit))] + some(9)
        elif turn % 4 == 2:
            a, b = "a", "ab"
            for _ in range(rng.randrange(4, 10)):
                a, b = b, b + a
            yield list(b)[rng.randrange(8) :]
        else:
            inner = some(rng.randrange(1, 4))
            outer = inner * rng.randrange(1, 6) + some(rng.randrange(3))
            whole = outer * rng.randrange(1, 5) + outer[: rng.randrange(len(outer) + 1)] + inner * 3
            yield (whole + some(rng.randrange(3))) * rng.randrange(1, 3)


@pytest.mark.parametrize("least", [2, 5, 12])
@pytest.mark.parametrize("seed", range(4))
def test_all_runs(seed, least):
    for words in strings(seed):
        assert [tuple(x) for x in r.find_runs(names(words), least).tolist()] == brute(words, least)


def test_runs_end_with_their_text():
    one = [b"a", b"b"] * 10
    found = [(runs.tolist(), kept.tolist()) for runs, kept in r.block_runs([one, [], one, [b"c"]])]
    assert found[0] == found[2] == ([[0, 20, 2]], [True] * 2 + [False] * 18)
    assert found[1] == ([], []) and found[3] == ([], [True])


def plain(doc_id, text) -> tuple:
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words, 12)
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *longest, digest(lines), digest(kept))


def rows(df) -> list:
    return sorted((tuple(x) for x in df.collect()), key=repr)


def test_whole_table(spark, sf_dir):
    source = table(spark, sf_dir, "documents")
    expected = sorted((plain(int(i), t) for i, t in zip(source.doc_id, source.text, strict=True)), key=repr)
    found = rows(QUERIES["op11_periodic_runs"](spark, sf_dir))
    assert found == expected
    assert sum(x[1] > 0 for x in found) > len(found) / 20


def test_awkward_rows(spark):
    source = [(i, t) for i, t, *_ in awkward_rows() if i not in (7, 8)]
    docs = documents(spark, [x for x in awkward_rows() if x[0] not in (7, 8)])
    found = rows(r.run_digests(r.periodic_runs(r.planted(docs))))
    assert found == sorted((plain(i, t) for i, t in source), key=repr)


def test_long_text(spark):
    words = [f"w{i}" for i in range(50_000)]
    text = " ".join(words + words + words[:100])
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = r.periodic_runs(docs).first()
    assert [tuple(x) for x in found["runs"]] == [(0, 100_100, 50_000)]
    assert found["collapsed"] == " ".join(words) and found["n_words"] == 100_100


def test_empty_table(spark):
    assert r.run_digests(r.periodic_runs(r.planted(no_documents(spark)))).count() == 0
