"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Groups of equal texts cannot be divided. Blocks of groups are differenced side by side,
each into a partial partition of ``shards`` sums; the partial partitions are differenced
again, level by level, until one is left.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.llm.words import text_key, whole_text
from sparkingest.session import materialize

# Bytes that a row takes besides its text.
ROW_BYTES = 8


def difference(vectors: list[list[int]]) -> list[list[int]]:
    """Combine partial partitions; for each, the final place of each of its sums.

    The two with the largest spread are added again and again, the larger sums of one to
    the smaller sums of the other. Ties go by position, so the result is fixed.
    """
    width = len(vectors[0])
    orders, nodes, heap = [], [], []
    for i, vector in enumerate(vectors):
        order = sorted(range(width), key=lambda j, v=vector: -v[j])
        orders.append(order)
        nodes.append(None)
        sums = [vector[j] for j in order]
        heap.append((sums[-1] - sums[0], i, sums))
    heapq.heapify(heap)
    places = range(width)
    while len(heap) > 1:
        _, left, high = heapq.heappop(heap)
        _, right, low = heapq.heappop(heap)
        added = [a + b for a, b in zip(high, reversed(low), strict=True)]
        order = sorted(places, key=added.__getitem__, reverse=True)
        sums = [added[j] for j in order]
        nodes.append((left, right, order))
        heapq.heappush(heap, (sums[-1] - sums[0], len(nodes) - 1, sums))
    final: list = [None] * len(nodes)
    final[-1] = list(places)
    for node in range(len(nodes) - 1, len(vectors) - 1, -1):
        left, right, order = nodes[node]
        mine, final[node] = final[node], None
        to_left, to_right = [0] * width, [0] * width
        for place, slot in zip(mine, order, strict=True):
            to_left[slot] = place
            to_right[width - 1 - slot] = place
        final[left], final[right] = to_left, to_right
    out = []
    for i, order in enumerate(orders):
        places_of = [0] * width
        for place, slot in zip(final[i], order, strict=True):
            places_of[slot] = place
        out.append(places_of)
    return out


def _sums(vectors: list[list[int]], places: list[list[int]]) -> list[int]:
    total = [0] * len(vectors[0])
    for vector, place in zip(vectors, places, strict=True):
        for value, at in zip(vector, place, strict=True):
            total[at] += value
    return total


def _block_function(shards: int):
    def assign(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["load", "key"], ascending=[False, True])
        vectors = [[int(load)] + [0] * (shards - 1) for load in block["load"]]
        places = difference(vectors)
        sums = [None] * len(block)
        sums[0] = _sums(vectors, places)
        return pd.DataFrame(
            {
                "key": block["key"],
                "block": block["block"],
                "bin": [place[0] for place in places],
                "sums": sums,
            }
        )

    return assign


def _level_function(children: pd.DataFrame) -> pd.DataFrame:
    children = children.sort_values("block")
    vectors = [[int(x) for x in sums] for sums in children["sums"]]
    places = difference(vectors)
    sums = [None] * len(children)
    sums[0] = _sums(vectors, places)
    return pd.DataFrame(
        {
            "block": children["block"],
            "parent": children["parent"],
            "places": places,
            "sums": sums,
        }
    )


def balanced_groups(
    groups: DataFrame, n_groups: int, shards: int, block_groups: int, fan_in: int
) -> DataFrame:
    """``key, shard`` for groups with ``key`` (binary) and ``load`` (bigint).

    No task gets more than about ``block_groups`` groups or ``fan_in`` partial partitions.
    """
    blocks = max(1, math.ceil(n_groups / block_groups))
    leaves = materialize(
        groups.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(
            _block_function(shards), "key binary, block bigint, bin int, sums array<bigint>"
        ),
        "shard-blocks",
    )
    partial = leaves.where(F.col("sums").isNotNull()).select("block", "sums")
    levels = []
    while blocks > 1:
        blocks = math.ceil(blocks / fan_in)
        level = materialize(
            partial.withColumn("parent", F.pmod("block", F.lit(blocks)))
            .groupBy("parent")
            .applyInPandas(
                _level_function,
                "block bigint, parent bigint, places array<int>, sums array<bigint>",
            ),
            "shard-level",
        )
        levels.append(level.select("block", "parent", "places"))
        partial = level.where(F.col("sums").isNotNull()).select(
            F.col("parent").alias("block"), "sums"
        )
    if not levels:
        return leaves.select("key", F.col("bin").alias("shard"))
    to_root = levels[-1].select("block", "places")
    for level in reversed(levels[:-1]):
        above = to_root.select(F.col("block").alias("parent"), F.col("places").alias("onward"))
        to_root = level.join(above, "parent").select(
            "block", F.expr("transform(places, p -> onward[p])").alias("places")
        )
    return leaves.join(to_root, "block").select("key", F.expr("places[bin]").alias("shard"))


def shard_documents(
    docs: DataFrame,
    shards: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_groups: int = 20_000,
    fan_in: int = 1_024,
    cell_rows: int = 20_000,
) -> DataFrame:
    """One row per input row: ``id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: the sums of ``size`` (bytes of the text and eight more) are nearly
    equal. Rows with equal texts share a shard; a null text equals an empty one. A group
    larger than a fair share fills a shard by itself. ``slot`` counts the rows of a shard
    from 0 without gaps, repeated rows too. An empty table gives no rows. Other columns
    are not read.
    """
    rows = materialize(
        docs.select(
            F.col(id_column).cast("bigint").alias("id"),
            (F.octet_length(whole_text(text_column)) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
            F.crc32(whole_text(text_column).cast("binary")).alias("crc"),
            text_key(text_column).alias("key"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("load"))
    n_rows = rows.count()
    placed_groups = balanced_groups(groups, n_rows, shards, block_groups, fan_in)
    # A shard's rows are counted in cells, so that no task numbers a whole shard.
    cells = max(1, math.ceil(n_rows / (shards * cell_rows)))
    placed = materialize(
        rows.join(placed_groups, "key").select(
            "id", "size", "crc", "shard", F.pmod(F.xxhash64("id", "key"), F.lit(cells)).alias("cell")
        ),
        "shard-placed",
    )
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "cell").orderBy("id", "size", "crc")
    return placed.join(offsets, ["shard", "cell"]).select(
        F.col("id").alias(id_column),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.row_number().over(within) - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
