"""Exact deduplication by content sort.

Sampled splitters range-partition the normalised texts, Spark's external sort puts equal
texts next to each other, and each row is compared in full with its neighbour.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.llm.words import whole_text
from sparkingest.session import materialize

# Fixed: the characters of [\x20\x09-\x0D].
IGNORED = " \t\n\x0b\f\r"

# Leading code points of a text that take part in the splitters; what ties beyond them is
# ordered by digest, length and identifier, so splitters stay short however long texts are.
HEAD = 16

_RUN_SCHEMA = (
    "id bigint, digest string, keep_id bigint, n bigint, first boolean, edge bigint, "
    "length bigint, content string"
)
_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("digest", pa.string()),
        ("keep_id", pa.int64()),
        ("n", pa.int64()),
        ("first", pa.bool_()),
        ("edge", pa.int64()),
        ("length", pa.int64()),
        ("content", pa.large_string()),
    ]
)


def normalised(column: str) -> Column:
    text = whole_text(column)
    for character in IGNORED:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


class _Run:
    """Equal neighbours that have been read so far; only their identifiers are held."""

    def __init__(self, content, digest: str, length: int, edge: int | None):
        self.content, self.digest, self.length, self.edge = content, digest, length, edge
        self.ids: list[pa.Array] = []

    def batch(self) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        n = len(ids)
        first = np.arange(n) == 0
        is_edge = self.edge is not None
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.repeat(pa.scalar(self.digest, pa.string()), n),
                pa.repeat(ids[0], n),
                pa.repeat(pa.scalar(n, pa.int64()), n),
                pa.array(first),
                pa.repeat(pa.scalar(self.edge, pa.int64()), n),
                pa.repeat(pa.scalar(self.length, pa.int64()), n),
                pa.array(
                    [self.content if is_edge else None] + [None] * (n - 1), pa.large_string()
                ),
            ],
            schema=_ARROW,
        )


def _neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition, each with its run of equal neighbours.

    The first and the last run may go on in other partitions: their rows carry an edge
    number, and the first row of each also carries the text.
    """
    partition = TaskContext.get().partitionId()
    run: _Run | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        content, length, ids, digest = (
            batch.column(batch.schema.get_field_index(c))
            for c in ("norm", "length", "id", "digest")
        )
        equal = np.zeros(batch.num_rows, dtype=bool)
        equal[1:] = pc.equal(content[1:], content[:-1]).to_numpy(zero_copy_only=False)
        equal[0] = run is not None and run.content == content[0].as_py()
        starts = np.flatnonzero(~equal)
        bounds = np.append(starts, batch.num_rows)
        if starts.size == 0 or starts[0] > 0:
            run.ids.append(ids.slice(0, int(bounds[0])))
        if not starts.size:
            continue
        if run is not None:
            yield run.batch()
        # Runs that begin and end in this batch, at once.
        inner = slice(0, len(starts) - 1)
        if run is None and len(starts) > 1:
            inner = slice(1, len(starts) - 1)
            opening = _Run(content[0].as_py(), digest[0].as_py(), length[0].as_py(), 2 * partition)
            opening.ids.append(ids.slice(0, int(bounds[1])))
            yield opening.batch()
        at, counts = starts[inner], np.diff(bounds)[inner]
        if len(at):
            rows = np.arange(at[0], at[0] + counts.sum())
            picked = np.repeat(at, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(rows)),
                    digest.take(pa.array(picked)).cast(pa.string()),
                    ids.take(pa.array(picked)),
                    pa.array(np.repeat(counts, counts), pa.int64()),
                    pa.array(rows == picked),
                    pa.nulls(len(rows), pa.int64()),
                    length.take(pa.array(picked)),
                    pa.nulls(len(rows), pa.large_string()),
                ],
                schema=_ARROW,
            )
        last, only = int(starts[-1]), run is None and len(starts) == 1
        run = _Run(
            content[last].as_py(),
            digest[last].as_py(),
            length[last].as_py(),
            2 * partition if only else None,
        )
        run.ids.append(ids.slice(last))
    if run is not None:
        if run.edge is None:
            run.edge = 2 * partition + 1
        yield run.batch()


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical without ``[\\x20\\x09-\\x0D]``; a null text is
    empty. The longest original (in code points) of a group stays, then the smallest
    identifier; a null identifier comes last. Of fully repeated rows one is kept. Equal
    empty texts are a group like any other. Other columns are not read.

    Rows are dealt by (leading characters, digest, length, identifier), which is unique up
    to repeated rows: a text that a third of the rows share fills many partitions. The runs
    at the edges of partitions, at most two for each, are joined by their full texts.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.length(whole_text(text_column)).cast("bigint").alias("length"),
        normalised(text_column).alias("norm"),
    ).select(
        "*", F.substring("norm", 1, HEAD).alias("head"), F.sha2("norm", 256).alias("digest")
    )
    order = [F.col("length").desc(), F.col("id").asc_nulls_last()]
    runs = (
        rows.repartitionByRange(partitions, "head", "digest", *order)
        .sortWithinPartitions("head", "digest", "norm", *order)
        .select("id", "length", "norm", "digest")
        .mapInArrow(_neighbours, _RUN_SCHEMA)
    )
    runs = materialize(runs, "content-sort")

    same = Window.partitionBy("content")
    best = same.orderBy(F.col("length").desc(), F.col("id").asc_nulls_last(), "edge")
    edges = runs.where(F.col("content").isNotNull()).select(
        "edge",
        F.sum("n").over(same).alias("all_n"),
        F.first("id").over(best).alias("all_keep"),
        F.first("edge").over(best).alias("keep_edge"),
    )
    # At most two rows for each partition, whatever the rows.
    joined = runs.drop("content").join(F.broadcast(edges), "edge", "left")
    inside = F.col("edge").isNull()
    return joined.select(
        F.col("id").alias(id_column),
        F.when(inside, F.col("keep_id")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.when(inside, F.col("n")).otherwise(F.col("all_n")).alias("group_size"),
        (F.col("first") & (inside | (F.col("edge") == F.col("keep_edge")))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
