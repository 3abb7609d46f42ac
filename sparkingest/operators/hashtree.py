"""Reconciliation by hash tree: from a digest of all rows down to the keys that differ.

Keys are hashed to 64 bits. A node of the tree is a range of these hashes, its value the lane
sums (see ``fingerprint``) of the rows whose keys fall into it, and the sums of a node are the
sum of its children's. A stored tree costs one pass over its table and is small whatever the
table's size; comparing two needs the root, then only children of nodes that differ. Rows are
read at last, and of these only the ones in differing leaves are hashed and shuffled.

The sums guard against faults. Whoever may choose rows freely can find others with the same
sums, so equal trees prove nothing against a forger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkingest.errors import ConfigurationError
from sparkingest.functions.fingerprint import (
    LANES,
    ROWS,
    digest_column,
    lane_sums,
    leaf_words,
    with_leaf_words,
)
from sparkingest.session import materialize, work_path

# Levels below the root and bits a level: 2^20 leaves, 32 children a node.
LEVELS, BITS = 4, 5


def key_range(keys: Sequence[str], bits: int) -> Column:
    """The number of the range, of ``2 ** bits``, that a key falls into; null is a value."""
    return F.shiftrightunsigned(F.xxhash64(*(F.col(f"`{key}`") for key in keys)), 64 - bits)


def _check(levels: int, bits: int) -> None:
    if levels < 1 or bits < 1 or levels * bits > 40:
        raise ConfigurationError("levels", "levels and bits must be positive, together 40 at most")


def hash_tree(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    levels: int = LEVELS,
    bits: int = BITS,
) -> DataFrame:
    """``level, top, range, _rows, lanes`` for every node with rows; level 0 is the root.

    ``top`` is the node's ancestor of level 1 (0 for the root). One pass over the rows with
    sums per task, so a key with a third of all rows costs no more than another; upper levels
    are sums of the leaves' sums. No rows, no nodes.
    """
    _check(levels, bits)
    depth = levels * bits
    content = list(dict.fromkeys([*keys, *columns]))
    ranged = df.select(*(F.col(f"`{c}`") for c in content)).withColumn(
        "_range", key_range(keys, depth)
    )
    leaves = with_leaf_words(ranged, content).groupBy("_range").agg(*lane_sums())
    shift = F.expr(f"{depth} - level * {bits}")
    nodes = leaves.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    ).select(
        "level",
        F.expr(f"IF(level = 0, 0, _range >> {depth - bits})").cast("int").alias("top"),
        F.call_function("shiftright", "_range", shift).alias("range"),
        ROWS,
        *LANES,
    )
    return nodes.groupBy("level", "top", "range").agg(
        *(F.sum(name).alias(name) for name in [ROWS, *LANES])
    )


def store_tree(tree: DataFrame, path: str | None = None) -> DataFrame:
    """The tree as a table in folders by level and top, so that a walk opens few of them.

    Without ``path`` it is a scratch copy of the application. An existing path is an error.
    """
    spark: SparkSession = tree.sparkSession
    path = path or work_path(spark, "hash-tree")
    (
        tree.repartition("level", "top")
        .sortWithinPartitions("level", "top", "range")
        .write.partitionBy("level", "top")
        .parquet(path)
    )
    return spark.read.schema(tree.schema).parquet(path)


def differing_ranges(
    source: DataFrame, target: DataFrame, levels: int = LEVELS, bits: int = BITS
) -> DataFrame:
    """``top, range`` of the leaves in which two trees of one shape differ.

    Level by level: the children of nodes that differ are compared, nothing else is. The open
    nodes of a level are a stored table; only whether there are any reaches the driver.
    """
    _check(levels, bits)

    def differing(level: int, parents: DataFrame | None) -> DataFrame:
        sides = []
        for tree in (source, target):
            nodes = tree.where(F.col("level") == level)
            if parents is not None:
                # Below level 2 the parent's folder is the child's, which prunes folders.
                same = [F.shiftright("range", bits) == F.col("_parent")]
                if level > 1:
                    same.append(F.col("top") == F.col("_top"))
                nodes = nodes.join(parents, same, "left_semi")
            sides.append(nodes.select("top", "range", digest_column().alias("digest")))
        return (
            sides[0]
            .unionAll(sides[1])
            .groupBy("top", "range")
            .agg(F.count(F.lit(1)).alias("sides"), F.count_distinct("digest").alias("digests"))
            .where("sides < 2 OR digests > 1")
            .select("top", "range")
        )

    nodes = materialize(differing(0, None), "tree-level-0")
    for level in range(1, levels + 1):
        if nodes.isEmpty():
            break
        parents = nodes.select(F.col("top").alias("_top"), F.col("range").alias("_parent"))
        nodes = materialize(differing(level, parents), f"tree-level-{level}")
    return nodes


def reconcile_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    source_tree: DataFrame | None = None,
    target_tree: DataFrame | None = None,
    levels: int = LEVELS,
    bits: int = BITS,
) -> DataFrame:
    """One row per key whose rows differ: ``keys, source_rows, target_rows, only_source,
    only_target, verdict``.

    Rows are compared over ``keys`` and ``columns`` as multisets: ``only_source`` counts rows
    that the source has more often. The verdict is MISSING_IN_TARGET, MISSING_IN_SOURCE,
    COUNT_MISMATCH or CONTENT_MISMATCH. Equal tables give no row and, given their trees, read
    none of the tables. Null keys are a key; repeated rows count; a tree that is not given is
    made first, and one that is given must be of the table's present state.

    Equal rows of a key are counted together before they move, and the different rows of a hot
    key are spread by their digest and joined as counts.
    """
    keys, columns = list(keys), list(dict.fromkeys([*keys, *columns]))
    trees = [
        store_tree(hash_tree(df, keys, columns, levels, bits)) if tree is None else tree
        for df, tree in ((source, source_tree), (target, target_tree))
    ]
    ranges = differing_ranges(*trees, levels, bits).select(F.col("range").alias("_range"))

    if ranges.isEmpty():
        source, target = source.where("false"), target.where("false")

    def rows(df: DataFrame, in_source: int) -> DataFrame:
        within = (
            df.select(*(F.col(f"`{c}`") for c in columns))
            .withColumn("_range", key_range(keys, levels * bits))
            .join(ranges, "_range", "left_semi")
        )
        return with_leaf_words(within, columns).select(
            *(F.col(f"`{key}`") for key in keys),
            *leaf_words(),
            F.lit(in_source).cast("bigint").alias("_in_source"),
        )

    quoted = [f"`{key}`" for key in keys]
    counted = (
        rows(source, 1)
        .unionAll(rows(target, 0))
        .groupBy(*quoted, *leaf_words())
        .agg(
            F.sum("_in_source").alias("_source"),
            F.sum(F.lit(1).cast("bigint") - F.col("_in_source")).alias("_target"),
        )
    )
    more = F.col("_source") - F.col("_target")
    by_key = counted.groupBy(*quoted).agg(
        F.sum("_source").alias("source_rows"),
        F.sum("_target").alias("target_rows"),
        F.sum(F.greatest(more, F.lit(0).cast("bigint"))).alias("only_source"),
        F.sum(F.greatest(-more, F.lit(0).cast("bigint"))).alias("only_target"),
    )
    verdict = (
        F.when(F.col("target_rows") == 0, F.lit("MISSING_IN_TARGET"))
        .when(F.col("source_rows") == 0, F.lit("MISSING_IN_SOURCE"))
        .when(F.col("source_rows") != F.col("target_rows"), F.lit("COUNT_MISMATCH"))
        .otherwise(F.lit("CONTENT_MISMATCH"))
    )
    return by_key.where("only_source + only_target > 0").withColumn("verdict", verdict)
