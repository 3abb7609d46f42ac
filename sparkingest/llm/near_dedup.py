"""Near-duplicate documents: weighted min-hashing, banding and verified multiset overlap.

The weights of a document's five-word shingles are their numbers of occurrences. A Poisson
process over (0, weight] for each shingle throws points at the registers; the first point of
each register is the signature. Intervals are split only as far as points are needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.llm.components import components
from sparkingest.llm.words import (
    SIMILARITY,
    HashedWords,
    bag,
    mixed,
    seeded,
    shingles,
    signed,
    text_blocks,
    text_key,
    whole_text,
    word_hashes,
)
from sparkingest.session import materialize, scratch_table

# At similarity 0.8 a pair shares no band with probability (1 - 0.8 ** 4) ** 16 = 0.0002.
BANDS, ROWS = 16, 4
REGISTERS = BANDS * ROWS

# Each register is also kept as so many bits, one plane of all registers a bit. At similarity
# 0.8 more than DIFFERING registers differ with a probability under 0.000005, far below that of
# sharing no band; texts that have half of their shingles in common mostly differ in more.
PLANES, DIFFERING = 4, 28
# A bucket is dealt out where it needs more comparisons than this, and then not into tiles of
# fewer members than that.
WORK, TILE = 1 << 22, 256
# Leaders that a bucket has one after the other, a round each.
ROUNDS = 4
# Shared shingles that go along with a rare one, so that a pair is not made for each.
BEFORE = 4

_FIRST, _REGISTER, _SIDE, _BAND, _PLANE = 1, 2, 3, 4, 1 << 20


def _exponential(keys: np.ndarray) -> np.ndarray:
    """Standard exponential variates, one for each key."""
    return -np.log(((seeded(keys, _FIRST) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)


def _node_keys(element: np.ndarray, low: np.ndarray, size: np.ndarray, nth) -> np.ndarray:
    """Keys of a point: element, interval (low, low + size] and the number of the point."""
    place = mixed(low.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    return mixed(mixed(element ^ place) ^ mixed(size.astype(np.uint64)) + np.uint64(nth))


def signatures(
    document: np.ndarray, element: np.ndarray, weight: np.ndarray, count: int
) -> np.ndarray:
    """Registers of ``count`` documents, given as distinct ``(document, element, weight)``.

    Weights are whole numbers from 1. The processes of (0, 1], (1, 2], (2, 4], (4, 8] ... are
    independent, with one point a unit of time and weight. An interval's first point falls
    into one of its halves; the other half has its own first point later on. Weights that
    end inside an interval thus follow the same points as larger ones. Points later than a
    document needs are never made: a limit on time is doubled until all registers are hit.
    """
    out = np.full((count, REGISTERS), np.inf)
    total = np.bincount(document, weights=weight, minlength=count)
    expected = REGISTERS * (math.log(REGISTERS) + 4)
    limit = np.where(total > 0, expected / np.maximum(total, 1), -1.0)
    open_documents = total > 0
    while open_documents.any():
        mine = open_documents[document]
        _throw(document[mine], element[mine], weight[mine], limit, out)
        # Points up to the limit are all known, so registers that are hit are final.
        open_documents &= np.isinf(out).any(axis=1)
        limit = limit * 2
    return out


def _throw(document, element, weight, limit, out) -> None:
    roots = [np.arange(len(document))]
    lows, sizes = [np.zeros(len(document), np.int64)], [np.ones(len(document), np.int64)]
    low = 1
    while True:
        reach = np.flatnonzero(weight > low)
        if not len(reach):
            break
        roots.append(reach)
        lows.append(np.full(len(reach), low))
        sizes.append(np.full(len(reach), low))
        low *= 2
    at = np.concatenate(roots)
    low, size = np.concatenate(lows), np.concatenate(sizes)
    key = _node_keys(element[at], low, size, 0)
    time = _exponential(key) / size
    nth = 0
    while True:
        kept = time <= limit[document[at]]
        at, low, size, key, time = at[kept], low[kept], size[kept], key[kept], time[kept]
        if not len(at):
            return
        # A point counts if its whole interval lies within the weight; a point that a half
        # has inherited counts again, which changes no minimum.
        inside = low + size <= weight[at]
        register = (seeded(key[inside], _REGISTER) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(out, (document[at[inside]], register), time[inside])
        nth += 1
        unit = size == 1
        # Units go on with their own next point.
        u_key = _node_keys(element[at[unit]], low[unit], size[unit], nth)
        u_time = time[unit] + _exponential(u_key)
        # Larger intervals are split; one half inherits the point.
        s_at, s_low, half = at[~unit], low[~unit], size[~unit] // 2
        s_key, s_time = key[~unit], time[~unit]
        right = (seeded(s_key, _SIDE) & np.uint64(1)).astype(bool)
        other_low = np.where(right, s_low, s_low + half)
        other_key = _node_keys(element[s_at], other_low, half, nth)
        other_time = s_time + _exponential(other_key) / half
        heir_low = np.where(right, s_low + half, s_low)
        at = np.concatenate([at[unit], s_at, s_at])
        low = np.concatenate([low[unit], heir_low, other_low])
        size = np.concatenate([size[unit], half, half])
        key = np.concatenate([u_key, s_key, other_key])
        time = np.concatenate([u_time, s_time, other_time])
        within = low < weight[at]
        at, low, size, key, time = at[within], low[within], size[within], key[within], time[within]


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature; bands do not share keys."""
    bits = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), BANDS, ROWS)
    out = np.empty((len(registers), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        value = seeded(bits[:, band, 0], _BAND + band)
        for row in range(1, ROWS):
            value = mixed(value ^ bits[:, band, row])
        out[:, band] = value
    return out


def register_planes(registers: np.ndarray) -> np.ndarray:
    """``PLANES`` 64-bit words for each signature: bit ``r`` of a word is a bit of register ``r``."""
    bits = np.ascontiguousarray(registers).view(np.uint64)
    hashed = seeded(bits.ravel(), _PLANE).reshape(bits.shape)
    out = np.zeros((len(registers), PLANES), dtype=np.uint64)
    for plane in range(PLANES):
        for register in range(REGISTERS):
            bit = (hashed[:, register] >> np.uint64(60 + plane)) & np.uint64(1)
            out[:, plane] |= bit << np.uint64(register)
    return out


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = HashedWords()
    for part, texts in text_blocks(batches, "text", 2_000_000):
        documents, elements, weights = [], [], []
        for i, text in enumerate(texts):
            values, counts = np.unique(
                shingles(word_hashes(text, memory)), return_counts=True
            )
            documents.append(np.full(len(values), i))
            elements.append(values)
            weights.append(counts)
        sizes = [len(x) for x in elements]
        registers = signatures(
            np.concatenate(documents), np.concatenate(elements), np.concatenate(weights), len(texts)
        )
        keys = signed(band_keys(registers))
        planes = signed(register_planes(registers))
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                part.column(1),
                pa.array(
                    [k.tolist() if n else [] for k, n in zip(keys, sizes, strict=True)],
                    pa.list_(pa.int64()),
                ),
                pa.array(planes.tolist(), pa.list_(pa.int64())),
            ],
            names=["id", "key", "bands", "planes"],
        )


def _bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = HashedWords()
    for part, texts in text_blocks(batches, "text"):
        bags = [signed(bag(shingles(word_hashes(t, memory)))) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.LargeListArray.from_arrays(
                    pa.array(offsets, pa.int64()), pa.array(np.concatenate(bags), pa.int64())
                ).cast(pa.list_(pa.int64())),
            ],
            names=["key", "bag"],
        )


def similar_pairs(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs(a, b, ...)`` of keys whose whole bags have that weighted Jaccard."""
    left = bags.select(F.col("key").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("key").alias("b"), F.col("bag").alias("bag_b"))
    shared = F.size(F.array_intersect("bag_a", "bag_b"))
    either = F.size("bag_a") + F.size("bag_b") - shared
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(shared >= F.lit(similarity) * either)
        .select(*pairs.columns)
    )


def banded_classes(nodes: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """``key, root`` of ``nodes(key, bands, planes)``: classes of verified links between nodes
    that share a band.

    The members of a bucket are compared with its leader, so a bucket of copies costs one
    comparison a member, and members that are of one class already are not compared. Leader
    is the member whose buckets are largest in sum: among edited copies that is the text they
    were made from, or what is nearest to it. Where a bucket holds further classes, the first
    member by that order that is not of a leader's class leads the next round, so that two
    large classes are joined by some of their members. A round has a row for each band of a
    node at most. A member may resemble others of a class than its leaders only, so at last
    those that are still of different classes in a bucket are searched for pairs: see
    ``apart_pairs``.
    """
    labels = materialize(nodes.select("key", F.col("key").alias("root")), "near-labels")
    current = nodes.select("key", F.explode("bands").alias("bucket"))
    sizes = current.groupBy("bucket").agg(F.count("*").alias("size"))
    popular = current.join(sizes, "bucket").groupBy("key").agg((-F.sum("size")).alias("rank"))
    ranked = materialize(nodes.select("key", "bands").join(popular, "key"), "near-ranked")
    current = ranked.select("key", "rank", F.explode("bands").alias("bucket"), F.lit(False).alias("led"))
    with ExitStack() as copies:
        for level in range(ROUNDS):
            rooted = current.join(labels, "key")
            least = F.min(F.when(~F.col("led"), F.struct("rank", "key", "root"))).alias("least")
            mixed = _mixed_buckets(rooted, least).where("least IS NOT NULL")
            members = copies.enter_context(
                scratch_table(rooted.join(mixed, "bucket"), f"near-members-{level}")
            )
            pairs = (
                members.where("root != least.root")
                .select(
                    F.col("least.key").alias("a"),
                    F.col("key").alias("b"),
                    F.col("least.root").alias("root_a"),
                    F.col("root").alias("root_b"),
                )
                .distinct()
            )
            similar = copies.enter_context(
                scratch_table(similar_pairs(pairs, bags, similarity), f"near-similar-{level}")
            )
            if similar.isEmpty():
                break
            labels = _joined(labels, similar)
            leaders = labels.select(F.col("key").alias("leader"), F.col("root").alias("leading"))
            led = F.col("led") | (F.col("root") == F.col("leading"))
            current = (
                members.select("bucket", "key", "rank", "led", F.col("least.key").alias("leader"))
                .join(labels, "key")
                .join(leaders, "leader")
                .select("bucket", "key", "rank", led.alias("led"))
            )
    found = similar_pairs(apart_pairs(nodes, labels, bags, similarity), bags, similarity)
    with scratch_table(found, "near-similar") as similar:
        return labels if similar.isEmpty() else _joined(labels, similar)


def _joined(labels: DataFrame, similar: DataFrame) -> DataFrame:
    """``labels(key, root)`` after the links of ``similar(root_a, root_b)`` between classes."""
    joined = components(similar.selectExpr("root_a AS a", "root_b AS b"), "near-links")
    joined = joined.select(F.col("key").alias("root"), F.col("root").alias("joined"))
    return materialize(
        labels.join(joined, "root", "left").select(
            "key", F.coalesce("joined", "root").alias("root")
        ),
        "near-labels",
    )


def rarest_shingles(bags: DataFrame, similarity: float) -> DataFrame:
    """``node, size, shared, place, before, shingle`` of ``bags(node, bag)``: of each bag the
    shingles that are rarest among all ``bags``, so many that two bags of that similarity have
    one of them in common. Those that no other bag has are counted, but are no rows.

    Two bags of that similarity share at least that part of either. If all but a smaller part of a
    bag is left out, in one order for all bags, some shared shingle remains on both sides, the
    first that they share. Texts that only have a passage in common share no rare one.
    ``shared`` is how many of a bag's shingles any other bag has, ``place`` the place of the
    shingle in the order of its bag, from 1, and ``before`` holds the last few rows before it.
    """
    rows = bags.select("node", F.size("bag").alias("size"), F.explode("bag").alias("shingle"))
    seen = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    order = Window.partitionBy("node").orderBy("n", "shingle")
    # What no other bag has comes first in the order.
    ranked = (
        rows.join(seen, "shingle")
        .withColumn("shared", F.count("*").over(Window.partitionBy("node")))
        .where(F.col("shared") >= F.col("size") * F.lit(similarity) - F.lit(1e-9))
        .withColumns(
            {
                "place": F.row_number().over(order) + F.col("size") - F.col("shared"),
                "before": F.collect_list("shingle").over(order.rowsBetween(-BEFORE, -1)),
            }
        )
    )
    # Rounding that takes a little too many shingles is harmless, too few would lose pairs.
    taken = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - F.lit(1e-9)) + 1
    return ranked.where(F.col("place") <= taken).select(
        "node", "size", "shared", "place", "before", "shingle"
    )


def apart_pairs(
    nodes: DataFrame, labels: DataFrame, bags: DataFrame, similarity: float
) -> DataFrame:
    """``a, b, root_a, root_b`` of nodes of different classes that may be similar.

    Searched are the nodes that share a band with one of another class, unless a bucket's two
    members have met as leader and member. Two of them meet if
    they have one of their rarest shingles in common, which every pair of that similarity
    has, and if their sizes, the number of shingles that others have at all, the places of that
    shingle and their registers allow it. The first shingle that they share has no more of
    either bag behind it than they may have in common. Nodes that also share one of the few
    before it have met there. So in a bucket neither the members of its largest class need to meet
    each other, nor those that have the same shingle just before it; whichever are more only
    meet the other members. All are dealt out over the bucket's tiles, these others go into each.
    """
    rooted = nodes.select("key", F.explode("bands").alias("bucket")).join(labels, "key")
    larger = _mixed_buckets(rooted, F.count("*").alias("n")).where("n > 2").select("bucket")
    apart = rooted.join(larger, "bucket").select("key", "root").distinct()
    # A number instead of the 32 bytes of a key goes with each shingle.
    apart = apart.join(nodes.select("key", "planes"), "key").withColumn(
        "node", F.monotonically_increasing_id()
    )
    with scratch_table(apart, "near-apart") as searched:
        numbered = bags.join(searched.select("key", "node"), "key").select("node", "bag")
        with scratch_table(rarest_shingles(numbered, similarity), "near-rarest") as rare:
            rooted = rare.withColumnRenamed("shingle", "bucket").join(searched, "node")
            members = materialize(_dealt(rooted), "near-apart-members")

    def side(name: str, rows: DataFrame, tile: Column) -> DataFrame:
        return rows.select(
            "bucket",
            tile.alias("tile"),
            F.col("common").alias(f"common_{name}"),
            F.col("key").alias(name),
            F.col("root").alias(f"root_{name}"),
            F.col("size").alias(f"size_{name}"),
            F.col("shared").alias(f"shared_{name}"),
            F.col("place").alias(f"place_{name}"),
            F.col("before").alias(f"before_{name}"),
            *(F.col("planes")[p].alias(f"{name}_{p}") for p in range(PLANES)),
        )

    left = side("a", members, F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    right = side("b", members.where("NOT common"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    differing = F.lit(0).cast("bigint")
    for p in range(PLANES):
        differing = differing.bitwiseOR(left[f"a_{p}"].bitwiseXOR(right[f"b_{p}"]))
    both = left["size_a"] + right["size_b"]
    # What they share is among what others have: at most the lesser of the two numbers.
    overlap = F.least(left["shared_a"], right["shared_b"])
    # And from the first that they share on, so is the rest of either bag.
    behind = 1 + F.least(left["size_a"] - left["place_a"], right["size_b"] - right["place_b"])
    met = [
        left["bucket"] == right["bucket"],
        left["tile"] == right["tile"],
        # Two of the others meet twice.
        (left["root_a"] < right["root_b"])
        | (left["common_a"] & (left["root_a"] > right["root_b"])),
        left["size_a"] >= right["size_b"] * F.lit(similarity) - F.lit(1e-9),
        right["size_b"] >= left["size_a"] * F.lit(similarity) - F.lit(1e-9),
        overlap * F.lit(1 + similarity) >= both * F.lit(similarity) - F.lit(1e-9),
        behind * F.lit(1 + similarity) >= both * F.lit(similarity) - F.lit(1e-9),
        F.bit_count(differing) <= DIFFERING,
        ~F.arrays_overlap("before_a", "before_b"),
    ]
    one, other = (
        F.struct(F.col(f"root_{x}").alias("root"), F.col(x).alias("key")) for x in ("a", "b")
    )
    ends = F.least(one, other).alias("low"), F.greatest(one, other).alias("high")
    return (
        left.join(right, met)
        .select(*ends)
        .selectExpr("low.key AS a", "high.key AS b", "low.root AS root_a", "high.root AS root_b")
        .distinct()
    )


def _dealt(rooted: DataFrame) -> DataFrame:
    """``rooted(bucket, root, before, ...)`` of the buckets with pairs to search, ``tiles`` of the
    bucket and ``common``: no two of these members need to meet, see ``apart_pairs``."""
    last = F.try_element_at("before", F.lit(-1))
    counts = [
        rooted.select("bucket", value.alias("value"))
        .where("value IS NOT NULL")
        .groupBy("bucket", "value")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.max(F.struct("n", "value")).alias(name))
        for name, value in (("class", F.col("root")), ("after", last))
    ]
    sizes = _mixed_buckets(rooted, F.count("*").alias("n"))
    by_class = F.col("class.n") >= F.coalesce("after.n", F.lit(0))
    others = F.col("n") - F.greatest("class.n", "after.n")
    tiles = F.least(F.ceil(F.col("n") / TILE), F.ceil(F.col("n") * others / WORK)).cast("int")
    buckets = (
        sizes.join(counts[0], "bucket")
        .join(counts[1], "bucket", "left")
        .where(others > 0)
        .select(
            "bucket",
            tiles.alias("tiles"),
            F.when(by_class, F.col("class.value")).alias("_class"),
            F.when(~by_class, F.col("after.value")).alias("_after"),
        )
    )
    common = F.coalesce(F.col("root") == F.col("_class"), F.lit(False)) | F.coalesce(
        last == F.col("_after"), F.lit(False)
    )
    return rooted.join(buckets, "bucket").withColumn("common", common).drop("_class", "_after")


def _mixed_buckets(rooted: DataFrame, *more: Column) -> DataFrame:
    """Buckets whose members belong to several classes."""
    ends = [F.min("root").alias("_low"), F.max("root").alias("_high")]
    grouped = rooted.groupBy("bucket").agg(*ends, *more)
    return grouped.where("_low != _high").drop("_low", "_high")


def _classes(
    docs: DataFrame, id_column: str, text_column: str, similarity: float
) -> tuple[DataFrame, DataFrame]:
    """``id, key`` of every row, and ``key, class_id, class_size`` of every distinct text."""
    signed_rows = materialize(
        docs.select(
            F.col(id_column).cast("bigint").alias("id"),
            text_key(text_column).alias("key"),
            whole_text(text_column).alias("text"),
        ).mapInArrow(_sign, "id bigint, key binary, bands array<bigint>, planes array<bigint>"),
        "near-signatures",
    )
    nodes = materialize(
        signed_rows.groupBy("key").agg(
            F.min("id").alias("node_id"),
            F.count("*").alias("copies"),
            F.first("bands").alias("bands"),
            F.first("planes").alias("planes"),
        ),
        "near-nodes",
    )
    banded = nodes.select("key", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = banded.join(shared, "bucket").select("key").distinct()
    # One row of each text is asked for by its identifier, so copies are not dealt together.
    wanted = members.join(nodes.select("key", "node_id"), "key").select(
        F.col("key").alias("_key"), "node_id"
    )
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        text_key(text_column).alias("key"),
        whole_text(text_column).alias("text"),
    )
    same = (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("node_id"))
    bags = materialize(
        texts.join(wanted, same, "left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
        .mapInArrow(_bags, "key binary, bag array<bigint>"),
        "near-bags",
    )
    candidates = nodes.join(bags.select("key"), "key", "left_semi")
    roots = banded_classes(candidates, bags, similarity)
    grouped = (
        nodes.drop("bands", "planes")
        .join(roots, "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    classes = grouped.groupBy("root").agg(
        F.min("node_id").alias("class_id"), F.sum("copies").alias("class_size")
    )
    return signed_rows.select("id", "key"), grouped.join(classes, "root").select(
        "key", "node_id", "class_id", "class_size"
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per input row: ``id, class_id, class_size, kept``.

    Classes are the connected groups of texts whose shingle multisets have a weighted Jaccard
    similarity of at least ``similarity``; equal texts are one node, whatever their number.
    ``class_id`` is the smallest identifier of the class (null only if all are null), the row
    that is kept; of repeated rows of that identifier all are marked. Words are lower-cased
    runs of letters and digits; texts of one to four words have one shingle, texts without
    words (null, empty, signs only) resemble only equal texts. Other columns are not read.

    Candidate pairs are those that share a band. Pairs of one bucket are not all made: see
    ``banded_classes``.
    """
    rows, classes = _classes(docs, id_column, text_column, similarity)
    return rows.join(classes, "key").select(
        F.col("id").alias(id_column),
        "class_id",
        "class_size",
        F.col("id").eqNullSafe(F.col("class_id")).alias("kept"),
    )


def one_of_each_class(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row of each class of ``near_duplicates``, with all its columns: that of the
    smallest identifier (a null one only if all are null); of repeated rows any one."""
    _, classes = _classes(docs, id_column, text_column, similarity)
    # A class has one text of its smallest identifier, unless identifiers repeat.
    kept = classes.groupBy("class_id").agg(
        F.min(F.when(F.col("node_id").eqNullSafe(F.col("class_id")), F.col("key"))).alias("key")
    )
    packed = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_column).cast("bigint").alias("id"),
        text_key(text_column).alias("key"),
    )
    return (
        packed.join(kept, "key")
        .where(F.col("id").eqNullSafe(F.col("class_id")))
        .groupBy("key")
        .agg(F.first("doc").alias("doc"))
        .select("doc.*")
    )
