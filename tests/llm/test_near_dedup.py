from __future__ import annotations

import math
import random
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pytest

from sparkingest.llm import near_dedup
from sparkingest.llm.components import components
from sparkingest.llm.words import bag
from tests.llm.fixtures import (
    awkward_rows,
    documents,
    jaccard,
    no_documents,
    prose,
    shingle_bag,
)


def roots(n, links) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(rows) -> list[tuple]:
    """Classes by comparing all pairs."""
    texts = [r[1] or "" for r in rows]
    bags = [shingle_bag(t) for t in texts]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if texts[i] == texts[j] or jaccard(bags[i], bags[j]) >= 0.8
    ]
    of = roots(len(rows), links)
    ids: dict[int, list] = {}
    for i, row in enumerate(rows):
        ids.setdefault(of[i], []).append(row[0])
    out = []
    for i, row in enumerate(rows):
        members = ids[of[i]]
        least = min((x for x in members if x is not None), default=None)
        out.append((row[0], least, len(members), row[0] == least))
    return sorted(out, key=repr)


def result(df) -> list[tuple]:
    return sorted(
        ((r.doc_id, r.class_id, r.class_size, r.kept) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("seed", range(4))
def test_signatures_estimate_weighted_jaccard(seed):
    chooser = random.Random(seed)
    hits, expected = [], []
    for trial in range(40):
        base = {chooser.getrandbits(64): chooser.choice([1, 1, 2, 3, 5, 9, 40]) for _ in range(60)}
        other = dict(base)
        for key in chooser.sample(sorted(base), 25):
            other[key] = chooser.choice([0, 1, 4, 17])
        other = {k: w for k, w in other.items() if w}
        sets = [base, other]
        document = np.repeat([0, 1], [len(s) for s in sets])
        element = np.array([k for s in sets for k in s], dtype=np.uint64)
        weight = np.array([w for s in sets for w in s.values()])
        registers = near_dedup.signatures(document, element, weight, 2)
        assert np.isfinite(registers).all()
        hits.append((registers[0] == registers[1]).mean())
        expected.append(jaccard(Counter(base), Counter(other)))
    assert abs(np.mean(hits) - np.mean(expected)) < 0.03


def test_signature_does_not_depend_on_neighbours():
    element = np.arange(1, 30, dtype=np.uint64)
    weight = np.arange(29) % 6 + 1
    alone = near_dedup.signatures(np.zeros(29, int), element, weight, 1)
    both = near_dedup.signatures(
        np.concatenate([np.zeros(29, int), np.ones(3, int)]),
        np.concatenate([element, element[:3]]),
        np.concatenate([weight, [700, 1, 2]]),
        3,
    )
    assert (alone[0] == both[0]).all() and np.isinf(both[2]).all()


def test_bags_count_occurrences():
    a = bag(np.array([5, 5, 5, 9], dtype=np.uint64))
    b = bag(np.array([5, 9, 5, 7], dtype=np.uint64))
    assert len(np.unique(a)) == 4 and len(np.intersect1d(a, b)) == 3


def test_components(spark):
    chooser = random.Random(5)
    links = [(chooser.randrange(300), chooser.randrange(300)) for _ in range(170)]
    links += [(i, i + 1) for i in range(300, 360)] + [(400, x) for x in range(401, 460)]
    of = roots(460, links)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert {(r.key, r.root) for r in found} == {(x, of[x]) for x in touched}
    assert len(found) == len(touched)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_awkward_rows(spark):
    assert result(near_dedup.near_duplicates(documents(spark))) == brute(awkward_rows())
    assert near_dedup.near_duplicates(no_documents(spark)).collect() == []


def test_whole_table(spark, sf_dir):
    from sparkingest.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(QUERIES["op3_near_dedup"](spark, sf_dir)) == brute(rows)


def test_passages_in_common_do_not_join_and_copies_among_them_do(spark):
    """Half of every text is one passage, so bands collide all over; a few are copies."""
    common = prose(99, 60)
    rows = [(i, f"{common} {prose(1000 + i, 60)}", "en", "s", 0) for i in range(120)]
    rows += [(500 + i, f"{common} {prose(1000 + i, 60)} more", "en", "s", 0) for i in range(0, 120, 7)]
    assert result(near_dedup.near_duplicates(documents(spark, rows))) == brute(rows)


def test_large_group_of_edited_copies(spark):
    chooser = random.Random(8)
    words = prose(7, 400).split()
    rows = []
    for i in range(150):
        edited = list(words)
        edited[chooser.randrange(400)] = f"new{i}"
        rows.append((i, " ".join(edited), "en", "s", 0))
    got = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(0, 150)}


def test_copies_of_copies_in_a_large_family(spark):
    """Every third copy has an edit of its own that resembles this copy alone."""
    chooser = random.Random(9)
    words = prose(17, 400).split()
    rows = [(0, " ".join(words), "en", "s", 0)]
    for i in range(1, 121):
        # Places are apart, so an edit costs five shingles each.
        first, *more = (6 * x + 5 for x in chooser.sample(range(65), 9))
        copy = list(words)
        copy[first] = f"new{i}"
        rows.append((i, " ".join(copy), "en", "s", 0))
        if i % 3 == 0:
            for n in more:
                copy[n] = f"newer{i}x{n}"
            rows.append((1000 + i, " ".join(copy), "en", "s", 0))
    bags = {r[0]: shingle_bag(r[1]) for r in rows}
    for i in range(3, 121, 3):
        near = [j for j in bags if j != 1000 + i and jaccard(bags[j], bags[1000 + i]) >= 0.8]
        assert near == [i]
    got = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(0, len(rows))}


def test_a_round_has_a_row_for_each_band_of_a_text_at_most(spark, monkeypatch):
    """Every third copy has more edits and resembles another such copy only."""
    chooser = random.Random(12)
    words = prose(27, 400).split()
    rows = []
    for i in range(120):
        copy = list(words)
        copy[chooser.randrange(200, 400)] = f"new{i}"
        for n in range(0, 60, 6) if i % 3 == 0 else ():
            copy[n] = f"newer{i // 6}x{n}"
        rows.append((i, " ".join(copy), "en", "s", 0))
    made = {}

    @contextmanager
    def counted(df, name, scratch=near_dedup.scratch_table):
        with scratch(df, name) as out:
            made[name] = out.count()
            yield out

    monkeypatch.setattr(near_dedup, "scratch_table", counted)
    assert result(near_dedup.near_duplicates(documents(spark, rows))) == brute(rows)
    rounds = [n for name, n in made.items() if name != "near-rarest"]
    assert len(rounds) > 2 and max(rounds) <= near_dedup.BANDS * len(rows), made


def test_registers_of_similar_texts_differ_in_few(spark):
    """At similarity 0.8 practically no pair is dropped by its registers."""
    chance = sum(
        math.comb(near_dedup.REGISTERS, k) * 0.2**k * 0.8 ** (near_dedup.REGISTERS - k)
        for k in range(near_dedup.DIFFERING + 1, near_dedup.REGISTERS + 1)
    )
    assert chance < (1 - 0.8**4) ** 16 / 20
    values = np.random.default_rng(3).random((2, near_dedup.REGISTERS))
    values[1, 10:] = values[0, 10:]
    planes = near_dedup.register_planes(values)
    differing = int(np.bitwise_or.reduce(planes[0] ^ planes[1]))
    assert differing < 1 << 10 and differing.bit_count() >= 7


def _searched(spark, bags: dict[int, list[int]], bands: dict[int, list[int]]) -> list[tuple]:
    key = lambda n: bytes([n])
    nodes = spark.createDataFrame(
        [(key(n), b, [0] * near_dedup.PLANES) for n, b in bands.items()],
        "key binary, bands array<bigint>, planes array<bigint>",
    )
    labels = nodes.selectExpr("key", "key AS root")
    rows = spark.createDataFrame([(key(n), b) for n, b in bags.items()], "key binary, bag array<bigint>")
    found = near_dedup.apart_pairs(nodes, labels, rows, 0.8).collect()
    return sorted(tuple(sorted((r.a[0], r.b[0]))) for r in found)


def test_search_makes_no_pairs_that_places_of_shingles_rule_out(spark):
    """Texts 1 and 2 share 87 of 113 shingles, and each shares its other 13 with further texts."""
    x, y, c = list(range(13)), list(range(100, 113)), list(range(200, 287))
    bags = {
        1: x + c,
        2: y + c,
        3: x + list(range(1000, 1087)),
        4: y + list(range(2000, 2087)),
        5: x + c[5:] + list(range(3000, 3005)),
    }
    assert _searched(spark, bags, {n: [7] for n in bags}) == [(1, 5)]
    rare = near_dedup.rarest_shingles(
        spark.createDataFrame(list(bags.items()), "node bigint, bag array<bigint>"), 0.8
    ).collect()
    # What one text alone has is no row, and texts that share too little have none.
    assert {r.node for r in rare} == {1, 2, 5} and max(r.shingle for r in rare) < 1000
    # Two texts alone in their bucket have met as leader and member.
    assert _searched(spark, {1: x + c, 5: x + c}, {1: [7], 5: [7]}) == []


def test_search_finds_every_similar_pair(spark):
    chooser = random.Random(4)
    bags = {
        n: chooser.sample(range(140), chooser.randrange(90, 130)) + [1000 + n * 10 + i for i in range(n % 5)]
        for n in range(60)
    }
    found = set(_searched(spark, bags, {n: [7] for n in bags}))
    sets = {n: set(b) for n, b in bags.items()}
    similar = {
        (a, b) for a in bags for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    }
    assert similar and {tuple(sorted(p)) for p in similar} <= found


@pytest.mark.parametrize("work", [None, 50])
def test_search_repeats_no_member_for_each_part_of_its_bucket(spark, monkeypatch, work):
    """Copies of one text in a large class, and some with more edits that resemble none or one."""
    chooser = random.Random(14)
    words = prose(37, 400).split()
    rows = []
    for i in range(120):
        copy = list(words)
        copy[chooser.randrange(200, 400)] = f"new{i}"
        for n in range(0, 60, 6) if i % 6 == 0 else ():
            copy[n] = f"newer{i // 12}x{n}"
        rows.append((i, " ".join(copy), "en", "s", 0))
    made = {}

    def counted(df, name, write=near_dedup.materialize):
        made[name] = write(df, name)
        return made[name]

    monkeypatch.setattr(near_dedup, "materialize", counted)
    monkeypatch.setattr(near_dedup, "TILE", 4)
    if work:
        monkeypatch.setattr(near_dedup, "WORK", work)
    assert result(near_dedup.near_duplicates(documents(spark, rows))) == brute(rows)
    members = made["near-apart-members"].collect()
    repeated = sum(r.tiles for r in members if not getattr(r, "common", False))
    assert members and (repeated <= len(members) if not work else repeated > 0)
    assert not work or max(r.tiles for r in members) > 1
