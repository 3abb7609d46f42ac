"""The corpus pipeline: quality, near duplicates, benchmark leaks, mixing, shards.

Each stage gets what its predecessor kept and returns the columns of documents, but for the
last, which returns the shards. All stages handle nulls, empty texts, repeated rows and empty
tables as the operators that they call say in their docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkingest.llm import decontaminate, mixing, near_dedup, quality, sharding
from sparkingest.llm.words import SIMILARITY, text_key
from sparkingest.session import work_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest identifier; of
    repeated rows one."""
    return near_dedup.one_of_each_class(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    items = _table(spark, sf_dir, "benchmark").dropDuplicates(["item_id"])
    found = decontaminate.contaminated_texts(docs, items, "item_id", "text", SIMILARITY)
    # A shuffle at every size: the leaked texts grow with the documents.
    keys = found.select("key").distinct().hint("merge")
    packed = docs.select(F.struct("*").alias("doc"), text_key("text").alias("key"))
    return packed.join(keys, "key", "left_anti").select("doc.*")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, and those of rarer languages as often as the target weights ask."""
    return mixing.mixed_documents(docs, _table(spark, sf_dir, "labels"))


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("mixing", mixed_documents),
    ("sharding", sharded_documents),
]

# Classifiers, min-hashes and differencing are not SQL; tests hold the stages against
# brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
