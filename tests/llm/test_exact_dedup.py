from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from sparkingest.llm.exact_dedup import exact_dedup
from tests.llm.fixtures import awkward_rows, documents, no_documents


def brute(rows) -> list[tuple]:
    groups: dict[str, list] = {}
    for n, (i, t, *_) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(norm, []).append((-len(t or ""), i is None, i or 0, n, i))
    out = []
    for norm, members in groups.items():
        members.sort()
        digest = hashlib.sha256(norm.encode()).hexdigest()
        for rank, member in enumerate(members):
            out.append((member[4], members[0][4], len(members), rank == 0, digest))
    return sorted(out, key=repr)


def result(df) -> list[tuple]:
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr
    )


def test_awkward_rows(spark):
    assert result(exact_dedup(documents(spark))) == brute(awkward_rows())
    assert exact_dedup(no_documents(spark)).collect() == []


def test_a_hot_text_fills_many_partitions(spark, conf):
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rows = [(i, "hot text" if i % 3 else f"text {i % 90}", "en", "s", 0) for i in range(3000)]
    rows += [(10_000 + i, f"hot  text{' ' * (i % 4)}", "en", "s", 0) for i in range(200)]
    df = documents(spark, rows)
    assert result(exact_dedup(df)) == brute(rows)


def test_texts_that_differ_late_are_kept(spark):
    base = "same beginning " * 2000
    rows = [(i, base + str(i // 2), "en", "s", 0) for i in range(20)]
    kept = exact_dedup(documents(spark, rows)).where("kept")
    assert kept.count() == 10
    assert kept.agg(F.max("group_size")).first()[0] == 2
