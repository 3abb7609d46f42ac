"""Conversation repair against exhaustive search, and against a plain reading of the rules."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkingest.llm import conversations as c
from sparkingest.llm.queries import QUERIES
from tests.llm.fixtures import CLASHING, table

FORM = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows: list[tuple[str, str | None]]) -> tuple[int, str, str]:
    """Best-first search over audits: (cost, audit, initials). ``rows``: initial and fault."""
    heap = [(0, "", 0, "")]
    done = set()
    while heap:
        cost, audit, at, initials = heapq.heappop(heap)
        if at == len(rows) and FORM.fullmatch(initials):
            return cost, audit, initials
        if (audit, at, initials) in done or len(initials) > len(rows) + 3:
            continue
        done.add((audit, at, initials))
        # Only beginnings of well-formed initials are carried on.
        options = [(5, "I", at, "u"), (5, "I", at, "a")]
        if at < len(rows):
            initial, fault = rows[at]
            options.append((2, "D", at + 1, ""))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                options += [(extra + 1, "R", at + 1, "u"), (extra + 1, "R", at + 1, "a")]
                if initial in "sua" and initial:
                    options.append((extra, "K", at + 1, initial))
        for price, letter, place, more in options:
            if re.fullmatch("s?(ua)*u?", initials + more):
                heapq.heappush(heap, (cost + price, audit + letter, place, initials + more))
    raise AssertionError


def test_cheapest_edits_and_least_audits():
    rng = random.Random(5)
    codes, wanted = [], []
    for _ in range(400):
        n = rng.randrange(0, 7)
        initial = [rng.choice([0, 1, 2, 2, 3, 3]) for _ in range(n)]
        fault = [rng.choice([0, 0, 0, 1, 2]) for _ in range(n)]
        codes.append(np.array([3 * i + f for i, f in zip(initial, fault, strict=True)], dtype=np.int64))
        names = ["", "s", "u", "a"]
        told = [None, "truncated", "blank"]
        wanted.append(cheapest([(names[i], told[f]) for i, f in zip(initial, fault, strict=True)])[:2])
    cost, audits = c.cheapest_edits(codes)
    assert [(int(a), b.decode()) for a, b in zip(cost, audits, strict=True)] == wanted


@pytest.mark.parametrize("seed", range(30))
def test_least_paths_where_labels_repeat(seed):
    rng = random.Random(seed)
    nodes = rng.randrange(2, 14)
    arcs = set()
    for v in range(nodes - 1):
        for _ in range(rng.randrange(0, 4)):
            arcs.add((v, rng.randrange(v + 1, nodes), rng.choice([65, 66])))
    arcs = sorted(arcs)

    def least(v):
        words = [bytes([letter]) + least(w) for s, w, letter in arcs if s == v]
        return min(words, default=b"")

    columns = np.array(arcs, dtype=np.int64).reshape(-1, 3)
    starts = np.arange(nodes)
    got = c.least_paths(nodes, columns[:, 0], columns[:, 1], columns[:, 2], starts)
    assert got == [least(v) for v in range(nodes)]


def test_long_conversation():
    codes = np.tile(np.array([3 * 2, 3 * 3]), 5000)
    cost, audits = c.cheapest_edits([codes, np.zeros(0, dtype=np.int64)])
    assert cost.tolist() == [0, 0] and audits == [b"K" * 10_000, b""]


def plain(rows: list[tuple]) -> dict:
    """Summary by conversation, straight from the rules."""
    damaged: dict = {}
    for conv, turn, role, text in rows:
        kept = damaged.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        kept += [(turn, role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, kept in damaged.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in kept if t is not None]
        seen, told = set(), []
        for _, role, text in kept:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = (
                "blank"
                if not solid
                else "duplicate"
                if (role, text) in seen
                else None
                if solid[-1] in ".!?"
                else "truncated"
            )
            seen.add((role, text))
            told.append((role[:1], fault))
        cost, audit, initials = cheapest(told)
        lines, at, out_at = [], 0, 0
        for letter in audit:
            if letter != "D":
                role = {"u": "user", "a": "assistant"}.get(initials[out_at], "")
                lines.append(
                    f"{role}:" if letter == "I" else f"{kept[at][1] if letter == 'K' else role}:{kept[at][2]}"
                )
                out_at += 1
            at += letter != "I"
        pairs = [a + b for (a, _), (b, _) in zip(told, told[1:], strict=False)]
        faults = [f for _, f in told]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def digests(df) -> dict:
    rows = c.repair_digests(c.damaged(df)).collect()
    found = {r["conv_id"]: tuple(r[n] for n in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


def test_whole_table(spark, sf_dir):
    rows = [tuple(None if v != v else v for v in r) for r in table(spark, sf_dir, "conversations")[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    df = QUERIES["op13_conversation_repair"](spark, sf_dir)
    found = {r["conv_id"]: tuple(r[n] for n in COLUMNS) for r in df.collect()}
    assert found == plain(rows)


def test_awkward_rows(spark):
    rng = random.Random(2)
    texts = ["Yes.", "No", "", None, " \n", "Ends. \t", "x\x0b", "?", "Fine!\n", "so ", "é…"]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, 0, 1, 2, 3, -5]), rng.choice(roles[:3] + roles), rng.choice(texts))
        for _ in range(160)
    ]
    rows += [(100, 1, "user", "Same text.")] * 6 + [(101, t, "user", "Same text.") for t in (4, 2, 9)]
    rows.append((102, 0, "user", "long " * 50_000 + "."))
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(1).alias(x) for x in CLASHING))
    df = df.select("*", F.lit("x").alias("conversation"), F.lit("y").alias("row"), F.lit(0).alias("a.b"))
    assert digests(df) == plain(rows)


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], SCHEMA)) == {}
    repaired, _ = c.repair(c.damaged(spark.createDataFrame([], SCHEMA)))
    assert repaired.count() == 0
