from __future__ import annotations

import re

from pyspark.sql import functions as F

from sparkingest.llm.decontaminate import (
    _windowed,
    contaminated_texts,
    decontaminate,
    rarest_windows,
    window_hashes,
)
from tests.llm.fixtures import awkward_rows, documents, no_documents, prose, with_extras

ITEM = "item_id bigint, text string"


def items(spark, rows):
    return with_extras(spark.createDataFrame(rows, ITEM))


QUESTION = (
    "A train leaves the old station at 9:30 and travels 120 km with Anna while a second train, "
    "slower, covers 80 km before Anna waves and both trains stop after 3 hours near the river."
)


def changed(text, **values):
    for old, new in values.items():
        text = re.sub(rf"\b{old.lstrip('_')}\b", new, text)
    return text


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_parameters_may_change_but_only_consistently(spark):
    before, after = prose(1, 40), prose(2, 40)
    other = changed(QUESTION, _120="250", _80="95", Anna="Bertram", _3="7")
    mixed_up = other.replace("Bertram waves", "Clara waves").replace("250", "1", 1)
    # One asked value given in two ways among few: not the same question.
    two = "We saw Anna come and Anna go and Anna stay and Anna leave and Anna sing all day long."
    torn = "We saw Rob come and Tim go and Eva stay and Max leave and Ida sing all day long."
    rows = [
        (1, f"{before}. {QUESTION} {after}", "en", "s", 0),
        (2, f"{before}. {other} {after}", "en", "s", 0),
        (3, f"{before} {after}", "en", "s", 0),
        (4, f"{before}. {QUESTION[:60]} {after}", "en", "s", 0),
        (5, f"{before}. {torn} {after}", "en", "s", 0),
        (6, f"{before}. {changed(two, Anna='Rob')} {after}", "en", "s", 0),
        (7, f"{before}. {mixed_up} {after}", "en", "s", 0),
    ]
    bench = items(spark, [(10, QUESTION), (11, prose(50, 30)), (12, two), (10, QUESTION)])
    got = by_id(decontaminate(documents(spark, rows), bench))
    assert got[1].items == [10] and got[1].changed_slots == 0
    assert got[2].items == [10] and got[2].changed_slots >= 3
    assert got[6].items == [12] and got[6].changed_slots == 1
    assert not any(got[i].contaminated for i in (3, 4, 5))
    assert got[1].coverage >= 0.9 and got[3].coverage is None


def test_awkward_rows(spark):
    bench = items(spark, [(1, None), (2, ""), (3, "too short"), (4, "1 2 3 4 5 6 7"), (None, prose(3, 80))])
    got = decontaminate(documents(spark), bench).collect()
    assert len(got) == len(awkward_rows())
    assert [r.doc_id for r in got if r.contaminated] == [None]
    assert decontaminate(no_documents(spark), bench).collect() == []
    clean = decontaminate(documents(spark), items(spark, [])).collect()
    assert len(clean) == len(awkward_rows()) and not any(r.contaminated for r in clean)


def test_whole_table_against_containment(spark, sf_dir):
    """Items of the tables hold no numbers or names, so windows of their words decide."""
    from sparkingest.llm.queries import QUERIES

    def grams(text):
        words = [re.sub(r"[^\w<>]+|_", "", w) for w in re.split(r"\s", text.lower())]
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    bench = {r.item_id: grams(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = by_id(QUERIES["op4_decontamination"](spark, sf_dir))
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        have = set(grams(row.text))
        wanted = sorted(
            i for i, g in bench.items() if sum(x in have for x in g) >= 0.8 * len(g)
        )
        assert sorted(got[row.doc_id].items) == wanted, row.doc_id


def test_reflowed_items_are_found(spark):
    """Double blanks, blank lines, indents and dashes between short sentences."""
    sentences = [prose(300 + i, 10) for i in range(5)]
    rows = [
        (i, f"{prose(1, 40)} {gap.join(sentences)} {prose(2, 40)}", "en", "s", 0)
        for i, gap in enumerate((" ", "  ", "\n\n", "\n    ", " - ", "\t\r\n"))
    ]
    got = by_id(decontaminate(documents(spark, rows), items(spark, [(1, " ".join(sentences))])))
    assert all(got[i].items == [1] and got[i].coverage == 1.0 for i in range(6))
    got = by_id(decontaminate(documents(spark, rows), items(spark, [(1, "\n\n - ".join(sentences))])))
    assert all(got[i].items == [1] and got[i].coverage == 1.0 for i in range(6))


def test_names_that_open_sentences_may_change(spark):
    problem = "Tom has 5 apples. Tom eats 2. How many has Tom left?"
    other = "Ann has 7 apples. Ann eats 3. How many has Ann left?"
    torn = "Ann has 7 apples. Bob eats 3. How many has Eve left?"
    short = "\nMaria buys 3 pens and pays 12 dollars. Ben gives 4 to a friend. Maria wants more pens now."
    rows = [
        (1, f"{prose(1, 40)}. {other} {prose(2, 40)}", "en", "s", 0),
        (2, f"{prose(3, 40)}\n{problem} {prose(4, 40)}", "en", "s", 0),
        (3, f"{prose(5, 40)}. {torn} {prose(6, 40)}", "en", "s", 0),
        (4, f"{prose(7, 40)}. {changed(short, Maria='Eva', Ben='Ida', _3='5')} {prose(8, 40)}", "en", "s", 0),
        (5, f"{prose(9, 40)}. He has no apples. She eats two. How many are left?", "en", "s", 0),
    ]
    got = by_id(decontaminate(documents(spark, rows), items(spark, [(1, problem), (2, short)])))
    assert [got[i].items for i in range(1, 6)] == [[1], [1], [], [2], []]
    assert got[1].changed_slots >= 3 and got[2].changed_slots == 0


def test_searched_windows_are_those_that_are_compared(spark):
    texts = [t for _, t, *_ in awkward_rows()] + [
        QUESTION,
        "  Tom has 5 apples.\n\nTom - eats 2. \t How many has <Tom> left? ",
        "A\x0bB\x0cC\x1cD\u00a0E\u2003F \x02G\x03 H I J",
        "ÀÉ Straße İstanbul Maria’s 3,5 km/h - - x-Ray, Y/Z 7 kg. Ende der Zeile",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    rows = rows.select("n", F.coalesce("text", F.lit("")).alias("text"))
    slow = {(r.n, r.hash) for r in _windowed(rows, "n").where("hash IS NOT NULL").collect()}
    assert {tuple(r) for r in window_hashes(rows, "n").collect()} == slow


def test_a_beginning_that_all_items_share_makes_no_candidates(spark):
    stem = prose(700, 13)
    own = {i: prose(800 + i, 20) for i in range(40)}
    bench = items(spark, [(i, f"{stem} {own[i]}") for i in own])
    windows = _windowed(bench.select(F.col("item_id").alias("item"), "text"), "item").select(
        "item", F.col("place").alias("at"), "hash"
    )
    taken = rarest_windows(windows, 0.8)
    # 29 places each, 24 to be covered: any 6 places do, none of them of the beginning.
    assert taken.count() == 6 * len(own)
    assert taken.groupBy("hash").count().where("count > 1").count() == 0
    rows = [(i, f"{prose(900 + i, 30)} {stem} {own[i % 40]}", "en", "s", 0) for i in range(80)]
    rows += [(100 + i, f"{stem} {prose(990 + i, 30)}", "en", "s", 0) for i in range(40)]
    got = by_id(decontaminate(documents(spark, rows), bench))
    assert all(got[i].items == [i % 40] for i in range(80))
    assert not any(got[100 + i].contaminated for i in range(40))


def _shuffled(spark) -> int:
    """Bytes that the session's stages have written to shuffles so far."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(
        spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_without_a_hit_are_not_shuffled(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(i, prose(1000 + i, 4000), "en", "s", 0) for i in range(40)]
    rows.append((40, f"{prose(7, 30)}. {QUESTION} {prose(8, 30)}", "en", "s", 0))
    whole = sum(len(r[1]) for r in rows)
    docs, bench = documents(spark, rows).coalesce(2), items(spark, [(10, QUESTION)])
    before = _shuffled(spark)
    found = contaminated_texts(docs, bench, "item_id", "text", 0.8).collect()
    assert [r.item for r in found] == [10]
    assert _shuffled(spark) - before < whole / 10
