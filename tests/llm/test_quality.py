from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkingest.llm import quality
from tests.llm.fixtures import awkward_rows, documents, no_documents, prose, with_extras

LABELS = "doc_id bigint, quality int, toxic int"


def no_labels(spark, rows=()):
    return with_extras(spark.createDataFrame(list(rows), LABELS))


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


def test_held_out_accuracy_and_calibration(spark, larger):
    from sparkingest.llm.queries import QUERIES

    scored = QUERIES["op6_quality"](spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.quality).mean() >= 0.95
    good, bad = rows.score[rows.quality == 1], rows.score[rows.quality == 0]
    assert np.mean([(g > bad).mean() for g in good]) >= 0.97
    assert abs(rows.score.mean() - rows.quality.mean()) < 0.08
    assert scored.count() == spark.read.parquet(f"{larger}/documents.parquet").count()
    for row in scored.limit(200).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)


def test_held_out_labels_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = quality.fold("doc_id") == quality.HELD_OUT
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    first = quality.score_quality(docs.drop("source"), labels).toPandas()
    second = quality.score_quality(docs.withColumn("source", F.lit("x")), flipped).toPandas()
    assert first.sort_values("doc_id").score.tolist() == second.sort_values("doc_id").score.tolist()


def test_context_vectors_do_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = quality.context_vectors(docs.coalesce(1))
    many = quality.context_vectors(docs.repartition(9))
    # Documents are kept apart by gaps, so their order does not matter either.
    assert np.array_equal(one, many)


def test_awkward_rows(spark):
    got = quality.score_quality(documents(spark), no_labels(spark)).collect()
    assert len(got) == len(awkward_rows()) and {r.score for r in got} == {0.5}
    labels = no_labels(
        spark, [(1, 1, 0), (1, 0, 0), (2, 1, None), (3, None, 0), (None, 1, 1), (99, 0, 0), (7, 5, 0)]
    )
    got = quality.score_quality(documents(spark), labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert quality.score_quality(no_documents(spark), labels).collect() == []


def test_accepted_rows_are_those_that_score_high(spark):
    rows = [(i, prose(i, 60), "en", "s", 0) for i in range(60)]
    rows += [(100 + i, "BUY!! NOW!! " * 30 + str(i), "en", "s", 0) for i in range(60)]
    rows += [(None, None, None, None, None)]
    labels = no_labels(spark, [(i, int(i < 100), 0) for i, *_ in rows[:-1]])
    docs = documents(spark, rows)
    scored = quality.score_quality(docs, labels).toPandas()
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == (scored.predicted == 1).sum()
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= set(range(60))
    assert kept.where("doc_id >= 100").count() <= 1
