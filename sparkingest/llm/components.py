"""Connected components of links between keys, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkingest.session import materialize


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("high", "low")).alias("h")
    ).first()
    return row.n, row.h


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``key, root`` for every key in ``links(a, b)``; ``root`` is the least key reached.

    Each round joins every key to the least of its neighbours, first among larger ones, then
    among smaller ones; the number of rounds grows with the logarithm of the longest path.
    Links are written between rounds, so a lost executor repeats one round at most. A key
    with very many links only has its minimum taken before rows move.
    """
    current = materialize(
        links.where("a != b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        name,
    )
    before = _fingerprint(current)
    while True:
        # Large stars: the larger neighbours of a key move to its least neighbour.
        both = current.union(current.select("low", "high"))
        least = both.groupBy(F.col("high").alias("key")).agg(F.min("low").alias("near"))
        least = least.select("key", F.least("key", "near").alias("least"))
        large = (
            current.join(least, current.low == least.key)
            .select("high", F.col("least").alias("low"))
            .distinct()
        )
        # Small stars: the smaller neighbours of a key, and itself, move to the least.
        nearest = large.groupBy("high").agg(F.min("low").alias("least"))
        small = (
            large.join(nearest, "high")
            .select(F.explode(F.array("high", "low")).alias("high"), F.col("least").alias("low"))
            .where("high != low")
            .distinct()
        )
        current = materialize(small, name)
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("high").alias("key"), F.col("low").alias("root"))
    return roots.union(current.select("low", "low").distinct())
