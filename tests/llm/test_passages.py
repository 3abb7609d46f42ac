from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from sparkingest.llm import passages
from tests.llm.fixtures import awkward_rows, documents, no_documents, prose, words_of


@pytest.mark.parametrize("seed", range(6))
def test_compact_windows_group_all_long_subsequences(seed):
    chooser = random.Random(seed)
    n, width = chooser.randrange(1, 60), chooser.randrange(1, 12)
    values = np.array([chooser.randrange(chooser.choice([4, 10**6])) << 24 for _ in range(n)], np.uint64)
    windows = passages.compact_windows(values, width)
    for i in range(n):
        for j in range(i + width - 1, n):
            held = [c for lo, c, hi in windows if lo <= i <= c <= j <= hi]
            first = i + int(np.argmin(values[i : j + 1]))
            assert held == [first], (i, j)
    assert len({c for _, c, _ in windows}) == len(windows)


def test_rolling_hashes_are_equal_where_runs_are():
    values = np.array([1, 2, 3, 4, 5, 9, 1, 2, 3, 4, 5, 7], dtype=np.uint64)
    for width in range(1, 6):
        runs = passages._rolling(values, width)
        assert len(runs) == len(values) - width + 1
        for i in range(len(runs)):
            for j in range(len(runs)):
                same = (values[i : i + width] == values[j : j + width]).all()
                assert (runs[i] == runs[j]) == same


def exact_runs(rows, length=50):
    """Words of each row that lie in a run of ``length`` words which another row has."""
    words = [words_of(r[1]) for r in rows]
    seen = defaultdict(set)
    for i, w in enumerate(words):
        for k in range(len(w) - length + 1):
            seen[tuple(w[k : k + length])].add(i)
    marks = [np.zeros(len(w), bool) for w in words]
    for i, w in enumerate(words):
        for k in range(len(w) - length + 1):
            if len(seen[tuple(w[k : k + length])]) > 1:
                marks[i][k : k + length] = True
    return marks


def spans(df):
    out = defaultdict(list)
    for r in df.collect():
        assert r.n_words == r.last_word - r.first_word + 1 >= 50
        out[r.doc_id].append(r)
    return out


def test_whole_table_holds_every_exact_passage(spark, sf_dir):
    from sparkingest.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = spans(QUERIES["op9_passages"](spark, sf_dir))
    found = total = 0
    for row, mark in zip(rows, exact_runs(rows), strict=True):
        assert not mark.any() or row[0] in got, row[0]
        covered = np.zeros(len(mark), bool)
        for r in got.get(row[0], []):
            covered[r.first_word : r.last_word + 1] = True
        found += (mark & covered).sum()
        total += mark.sum()
    assert found >= 0.98 * total
    # A passage is shared: nothing is found in a single document.
    classes = defaultdict(set)
    for doc, rows_of in got.items():
        for r in rows_of:
            classes[r.passage_id].add(doc)
    assert all(len(docs) > 1 for docs in classes.values())


def test_near_copies_short_lines_and_clean_texts(spark):
    passage = prose(1, 90).split()
    edited = list(passage)
    edited[45] = "other"
    line = prose(2, 30)
    rows = [(1, f"{prose(10, 80)} {' '.join(passage)} {prose(11, 80)}", "en", "s", 0)]
    rows += [(2, f"{prose(12, 50)} {' '.join(edited)} {prose(13, 90)}", "en", "s", 0)]
    # A line shorter than a passage stands in very many texts.
    rows += [(100 + i, f"{prose(200 + i, 40)} {line} {prose(400 + i, 60)}", "en", "s", 0) for i in range(60)]
    # Two of them share a passage around that line as well.
    longer = f"{prose(3, 15)} {line} {prose(4, 15)}"
    rows += [(900 + i, f"{prose(700 + i, 40)} {longer} {prose(800 + i, 60)}", "en", "s", 0) for i in range(2)]
    got = spans(passages.repeated_passages(documents(spark, rows)))
    assert sorted(got) == [1, 2, 900, 901]
    assert {r.passage_id for i in (1, 2) for r in got[i]} == {1}
    assert {r.passage_id for i in (900, 901) for r in got[i]} == {900}
    (first,), (second,) = got[1], got[2]
    assert (first.first_word, first.last_word) == (80, 169)
    assert (second.first_word, second.last_word) == (50, 139)


def test_awkward_rows(spark):
    got = spans(passages.repeated_passages(documents(spark)))
    rows = awkward_rows()
    for row, mark in zip(rows, exact_runs(rows), strict=True):
        assert mark.any() == (row[0] in got), row[0]
    assert passages.repeated_passages(no_documents(spark)).collect() == []


def test_exact_passages_beside_a_near_copy(spark):
    """One text quotes another, of which there is a near copy that lacks words of the quote.
    Which of the three is compared with the others depends on their keys."""
    rows = []
    for i in range(60):
        passage = prose(5000 + i, 120).split()
        copy = list(passage)
        copy[39], copy[79] = "other", "another"
        rows.append((10 * i, f"{prose(6000 + i, 30)} {' '.join(passage)}", "en", "s", 0))
        rows.append((10 * i + 1, f"{prose(7000 + i, 30)} {' '.join(copy)}", "en", "s", 0))
        quote = " ".join(passage[35:85])
        rows.append((10 * i + 2, f"{prose(8000 + i, 40)} {quote} {prose(9000 + i, 40)}", "en", "s", 0))
    got = spans(passages.repeated_passages(documents(spark, rows)))
    assert sorted(got) == sorted(r[0] for r in rows)
    for i in range(60):
        assert [(r.first_word, r.last_word) for r in got[10 * i + 2]] == [(40, 89)]


def test_near_copies_with_an_edit_at_every_place(spark):
    """One word of a passage is another word in the second document: similarity 0.8 or more."""
    rows, pairs = [], []
    for n in (50, 60):
        for at in range(n):
            passage = prose(20_000 + 100 * n + at, n).split()
            edited = [*passage[:at], "other", *passage[at + 1 :]]
            pairs.append((2 * len(pairs), 2 * len(pairs) + 1))
            for doc, words in zip(pairs[-1], (passage, edited), strict=True):
                around = prose(40_000 + doc, 60), prose(50_000 + doc, 60)
                rows.append((doc, f"{around[0]} {' '.join(words)} {around[1]}", "en", "s", 0))
    got = spans(passages.repeated_passages(documents(spark, rows)))
    found = sum(a in got and b in got for a, b in pairs)
    assert found >= 0.9 * len(pairs), (found, len(pairs))
    # Nothing beyond the passages: what is before and after differs.
    assert all(50 <= r.first_word and r.last_word < 130 for x in got.values() for r in x)


def test_every_place_of_a_passage(spark):
    notice = prose(70_000, 60)
    rows = [
        (i, " ".join([prose(71_000 + i, 40), notice, prose(72_000 + i, 40), notice, prose(73_000 + i, 40)]), "en", "s", 0)
        for i in range(2)
    ]
    got = spans(passages.repeated_passages(documents(spark, rows)))
    for i in range(2):
        assert sorted((r.first_word, r.last_word) for r in got[i]) == [(40, 99), (140, 199)]


def test_a_long_periodic_text_is_not_compared_place_by_place(spark):
    rows = [(i, " ".join(["again", "and"] * 4000), "en", "s", 0) for i in range(2)]
    rows.append((2, " ".join(["again", "and"] * 3000 + ["end"]), "en", "s", 0))
    assert sorted(spans(passages.repeated_passages(documents(spark, rows)))) == [0, 1, 2]


def test_places_without_room_are_not_compared_in_full(spark, monkeypatch):
    """Texts with a line in common that is shorter than a passage, and two that share a passage."""
    import pyarrow as pa

    words, line = prose(80_000, 60).split(), prose(80_001, 30).split()
    texts = [[*prose(80_010 + i, 70).split(), *line, *prose(80_050 + i, 70).split()] for i in range(4)]
    texts += [[*prose(80_090 + i, 70).split(), *words, *prose(80_095 + i, 70).split()] for i in range(2)]
    place = pa.array([[{"at_a": 80, "at_b": 80}]] * 3)
    full = []

    def counted(*args, compare=passages.shared_passage):
        full.append(args[4:6])
        return compare(*args)

    monkeypatch.setattr(passages, "shared_passage", counted)
    join = lambda at: pa.array([" ".join(texts[i]) for i in at])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b"a"] * 3), pa.array([b"b"] * 3), place, join((0, 2, 4)), join((1, 3, 5))],
        names=["a", "b", "places", "text_a", "text_b"],
    )
    (out,) = passages._verify(46, 0.8)([batch])
    assert out.column("similar").to_pylist() == [False, False, True]
    assert out.column("a_low").to_pylist()[2] == 70 and out.column("a_high").to_pylist()[2] == 125
    # Only the passage itself; before, each cost was tried at each place.
    assert len(full) == 1
    long = np.random.default_rng(5).random((40, 3000)) < 0.6
    for hits in long:
        for miss in passages.MISSES:
            ends = []
            for side in (hits[:1500][::-1], hits[1501:]):
                score = np.cumsum(np.where(side, 1, -miss))
                over = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > passages.DROP)
                score = score[: over[0]] if len(over) else score
                ends.append(int(np.argmax(score)) + 1 if len(score) and score.max() > 0 else 0)
            assert passages._extend(hits, 1500, miss) == (1500 - ends[0], 1500 + ends[1])


def test_large_tables_go_when_they_are_used_and_texts_are_packed(spark, monkeypatch):
    kept = {}

    def counted(df, name, write=passages.materialize):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(passages, "materialize", counted)
    shared, line = prose(90_000, 400), prose(90_001, 30)
    rows = [(i, f"{prose(90_010 + i, 40)} {shared}", "en", "s", 0) for i in range(3)]
    rows += [(10 + i, f"{prose(90_020 + i, 60)} {line} {prose(90_040 + i, 60)} ퟿é", "en", "s", 0) for i in range(4)]
    got = spans(passages.repeated_passages(documents(spark, rows)))
    assert {i: [(r.first_word, r.last_word) for r in x] for i, x in got.items()} == {i: [(40, 439)] for i in range(3)}
    # Windows, of which most stand in one text, are not kept to the end.
    assert not {"passage-windows", "passage-finer"} & set(kept)
    texts = {bytes(r.packed) for r in kept["passage-texts"].collect()}
    assert {passages._text(t) for t in texts} <= {r[1] for r in rows}
    assert sum(map(len, texts)) < 0.6 * sum(len(passages._text(t)) for t in texts)


def test_windows_are_compared_with_the_least_text_of_their_value(spark):
    chooser = random.Random(3)
    rows = {
        (bytes([chooser.randrange(4)]), chooser.randrange(9), c := chooser.randrange(50), c, c + chooser.randrange(4))
        for _ in range(60)
    }
    found = passages._with_least(spark.createDataFrame(sorted(rows), passages._WINDOW)).collect()
    groups = defaultdict(list)
    for key, value, *ends in rows:
        groups[value].append((key, *ends))
    expected = []
    for value, group in groups.items():
        least, most = min(group), max(group)
        for w in group if least[0] != most[0] else ():
            other = most if w[0] == least[0] else least
            expected.append((value, *w, w[:2] == least[:2], other))
    assert sorted((r.value, bytes(r.key), *r[2:6], (bytes(r.other[0]), *r.other[1:])) for r in found) == sorted(expected)


def test_hashes_of_many_texts_are_those_of_each():
    from sparkingest.llm import words

    chooser = random.Random(11)
    letters = "abcXYZ019_ .,\n\tßİΣσςéÉ中文𝔘ａ٣²Ⅷ'-̀‍"
    texts = ["".join(chooser.choices(letters, k=chooser.randrange(60))) for _ in range(400)]
    texts += ["", " ", "ΑΣ", "ΑΣ.", "x" * 200_000]
    hashes, bounds = words.block_hashes(texts, {})
    assert bounds[0] == 0 and bounds[-1] == len(hashes)
    for i, text in enumerate(texts):
        assert (hashes[bounds[i] : bounds[i + 1]] == words.word_hashes(text, words.HashedWords())).all(), text
    assert words.block_hashes([], {})[1].tolist() == [0]


def test_pairs_are_compared_without_reading_their_texts_again(monkeypatch):
    """A text is read once; its pairs get the hashes of its words, and places that give one
    stretch share its similarity."""
    import pyarrow as pa

    words = prose(95_000, 400).split()
    edited = [w if i % 23 else f"other{i}" for i, w in enumerate(words)]
    texts = [" ".join([*prose(95_001, 70).split(), *words]), " ".join([*prose(95_002, 30).split(), *edited])]
    texts += [" ".join([*prose(95_003, 90).split(), *words[:60]]), prose(95_004, 120)]
    (packed,) = passages._packed([pa.RecordBatch.from_arrays([pa.array([b"k"] * 4), pa.array(texts)], names=["key", "text"])])
    # Places of the edited copy, of the quote, and of nothing.
    at = [[{"at_a": 70 + 23 * k + 5, "at_b": 30 + 23 * k + 5} for k in range(16)], [{"at_a": 90, "at_b": 110}], [{"at_a": 90, "at_b": 50}]]
    fields = [pa.array([b"a"] * 3), pa.array([b"b"] * 3), pa.array(at)]

    def compared(column):
        sides = column.take(pa.array([0, 0, 0])), column.take(pa.array([1, 2, 3]))
        batch = pa.RecordBatch.from_arrays([*fields, *sides], names=["a", "b", "places", "text_a", "text_b"])
        return next(passages._verify(46, 0.8)([batch])).to_pylist()

    read, sorts = compared(pa.array(texts)), []
    monkeypatch.setattr(passages, "word_hashes", None)
    monkeypatch.setattr(passages.np, "sort", lambda v, sort=np.sort: (sorts.append(len(v)), sort(v))[1])
    assert compared(packed.column("prints")) == read
    assert [r["similar"] for r in read] == [False] * 16 + [True, False]
    # One stretch of the edited copy for each cost at most, and the quote.
    assert len(sorts) <= 2 * (len(passages.MISSES) * 2 + 1), sorts


def test_shuffles_are_dropped_in_the_steps_alone(spark, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, before = [], spark.conf.get(name, None)

    def watched(df, table, write=passages.materialize):
        seen.append((table, spark.conf.get(name)))
        return write(df, table)

    monkeypatch.setattr(passages, "materialize", watched)
    passage = prose(96_000, 60)
    rows = [(i, f"{prose(96_010 + i, 30)} {passage}", "en", "s", 0) for i in range(6)]
    found = passages.repeated_passages(documents(spark, rows))
    assert spark.conf.get(name, None) == before
    assert {on for _, on in seen} == {"true"}
    # The pairs are compared in turns.
    assert sum(table.startswith("passage-checked-") for table, _ in seen) == passages.TURNS > 1
    # The result can be read more than once.
    assert sorted(found.collect()) == sorted(found.collect()) and found.count() == 6
