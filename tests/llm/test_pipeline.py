from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from sparkingest.llm import decontaminate, near_dedup, quality
from tests.llm.fixtures import documents, no_documents


def test_stages_apply_their_operators(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], sf_dir).write.parquet(f"{tmp_path}/{name}")
        seen.append(spark.read.parquet(f"{tmp_path}/{name}"))
    for df in seen[1:-1]:
        assert df.columns == docs.columns

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert ids(seen[1]) == ids(quality.score_quality(seen[0], labels).where("predicted = 1"))
    assert ids(seen[2]) == ids(near_dedup.near_duplicates(seen[1]).where("kept"))
    assert ids(seen[3]) == ids(
        decontaminate.decontaminate(seen[2], benchmark).where("NOT contaminated")
    )
    assert sorted(set(ids(seen[4]))) == ids(seen[3])
    assert ids(seen[5]) == ids(seen[4])
    assert seen[5].agg(F.max("shard")).first()[0] == 23


def test_every_stage_bears_awkward_and_empty_tables(spark, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents(spark), sf_dir).collect() == [], name
        got = stage(spark, documents(spark), sf_dir)
        assert got.count() > 0, name
    kept = near_dedup.one_of_each_class(documents(spark))
    wanted = near_dedup.near_duplicates(documents(spark)).where("kept").select("class_id").distinct()
    assert kept.count() == wanted.count()


def test_run_returns_the_last_stage(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert set(got.columns) >= {"doc_id", "shard", "slot"} and got.count() > 0


def test_columns_with_dots(spark, sf_dir):
    """Names that Spark would read as a path stay as they are through all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).withColumn("a.b", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert "a.b" in docs.columns
    assert docs.select("`a.b`").distinct().count() == 1
