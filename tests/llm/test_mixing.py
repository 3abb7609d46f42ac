from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sparkingest.llm import mixing
from tests.llm.fixtures import awkward_rows, documents, no_documents, with_extras


def labels(spark, ids):
    return with_extras(spark.createDataFrame([(i,) for i in ids], "doc_id bigint"))


def test_expected_tokens_meet_the_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marked = spark.read.parquet(f"{sf_dir}/labels.parquet")
    wanted = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}
    rows = mixing.mix(docs, marked, targets=wanted).collect()
    totals = [sum(r.n_tokens * r.rate * r.posterior[k] for r in rows) for k in range(4)]
    for name, total in zip(("de", "en", "es", "fr"), totals, strict=True):
        assert total / sum(totals) == pytest.approx(wanted[name], abs=0.002)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    assert all(math.isclose(sum(r.posterior), 1.0) for r in rows)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert sum(truth[r.doc_id] == r.domain for r in rows) >= 0.9 * len(rows)


def test_most_tokens_from_the_rarest_domain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marked = spark.read.parquet(f"{sf_dir}/labels.parquet")
    wanted = {"en": 0.01, "de": 0.01, "es": 0.97, "fr": 0.01}
    rows = mixing.mix(docs, marked, targets=wanted).collect()
    totals = [sum(r.n_tokens * r.rate * r.posterior[k] for r in rows) for k in range(4)]
    shares = dict(zip(("de", "en", "es", "fr"), (t / sum(totals) for t in totals), strict=True))
    assert shares == pytest.approx(wanted, abs=0.002)
    assert all(r.met for r in rows)
    # With every document at least once and the most wanted domain missing, it cannot be met.
    rows = mixing.mix(docs, marked, targets={"xx": 1.0, "es": 0.0, "en": 1.0}, floor=1.0).collect()
    assert not all(r.met for r in rows)


def test_descent_is_that_of_a_plain_loop(spark):
    parts = [[64, 0], [0, 64], [32, 32], [48, 16]]
    tokens = [1000, 300, 200, 150]
    natural = [sum(t * p[k] / 64 for t, p in zip(tokens, parts, strict=True)) for k in (0, 1)]
    targets = [800.0, 1600.0]
    profiles = spark.createDataFrame(
        list(zip(parts, tokens, strict=True)), "parts array<int>, n_tokens bigint"
    )
    # More steps than one table of rates holds.
    fitted, reached = mixing.fit_rates(profiles, targets, natural, 0.2, 60)
    got = fitted.collect()
    rates = [1.0] * 4
    for _ in range(60):
        misses = [
            sum(t * r * p[k] / 64 for t, r, p in zip(tokens, rates, parts, strict=True)) - targets[k]
            for k in (0, 1)
        ]
        if all(abs(m) <= mixing.TOLERANCE * targets[k] for k, m in enumerate(misses)):
            break
        gradient = [m / natural[k] for k, m in enumerate(misses)]
        rates = [
            max(
                0.2,
                r - mixing.STEP * (sum(p[k] * gradient[k] for k in (0, 1)) / 64 + mixing.RIDGE * (r - 1)),
            )
            for r, p in zip(rates, parts, strict=True)
        ]
    assert {tuple(r.parts): r.rate for r in got} == pytest.approx(
        {tuple(p): r for p, r in zip(parts, rates, strict=True)}
    )
    met = [sum(t * r * p[k] / 64 for t, r, p in zip(tokens, rates, parts, strict=True)) for k in (0, 1)]
    assert met == pytest.approx(targets, rel=0.01) and reached == pytest.approx(met)


def test_awkward_rows(spark):
    got = mixing.mix(documents(spark), labels(spark, [])).collect()
    assert len(got) == len(awkward_rows())
    assert {(r.rate, r.copies, r.domain) for r in got} == {(1.0, 1, "all")}
    got = mixing.mix(documents(spark), labels(spark, [1, 2, 2, 5, None, 7, 12, 77])).collect()
    assert len(got) == len(awkward_rows())
    assert all(r.n_tokens == len((t or "").split()) for r, t in
               zip(sorted(got, key=lambda r: (repr(r.doc_id), r.n_tokens)),
                   [t for i, t, *_ in sorted(awkward_rows(), key=lambda x: (repr(x[0]), len((x[1] or "").split())))],
                   strict=True))
    assert mixing.mix(no_documents(spark), labels(spark, [1])).collect() == []


def test_mixed_documents_keep_every_row_and_all_columns(spark, sf_dir):
    docs = documents(spark).unionByName(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), allowMissingColumns=True
    )
    marked = spark.read.parquet(f"{sf_dir}/labels.parquet")
    mixed = mixing.mixed_documents(docs, marked)
    assert mixed.columns == docs.columns
    before = {(r.doc_id, r.text) for r in docs.collect()}
    assert {(r.doc_id, r.text) for r in mixed.collect()} == before
    gained = mixed.groupBy("lang").agg(F.count("*").alias("n")).collect()
    had = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    assert all(r.n >= had[r.lang] for r in gained)
