"""Periodic runs: stretches of words that repeat with a period, by a dictionary of basic factors.

Every place of a text is named by the words that stand there, for lengths 1, 2, 4 and so on;
the names of one length follow from pairs of names of the length before. Places with one name
that follow each other within twice the length form arithmetic progressions, and these
propose periods. A proposal is extended both ways by the names, longest first, and equal
stretches are merged.

Why the proposals are complete: a run of period q and at least 2q words holds, for the power
of two L with L <= q < 2L, one factor of length L at two places q apart. Places of a factor
that lie at most L/2 apart differ by its least period and form one progression, so a window
of 2L meets few progressions. Of two that a run joins, the last place of the one and some
place of the other lie q apart, or some place of the one and the first of the other: their
periodic stretches end within the run, or else they overlap by less than a period. Periods
below the shortest length used are met as distances of neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkingest.llm.words import text_blocks, whole_text

# Words that a run has at least.
LEAST = 12
# Bytes of texts that are searched together.
BLOCK_BYTES = 2_000_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Level:
    """One length of the dictionary: a name for each place, and the places of names that
    occur more than once, by name, then place."""

    def __init__(self, length: int, names: np.ndarray):
        self.length, self.names = length, names
        self.repeated = np.bincount(names, minlength=len(names))[names] > 1
        places = np.flatnonzero(self.repeated)
        self.places = places[np.argsort(names[places], kind="stable")]

    def doubled(self, size: int) -> Level:
        """The level of twice the length. A factor occurs once if one of its halves does; it
        then keeps its own place as its name, as every name is the first place it has."""
        count = max(0, size - 2 * self.length + 1)
        ahead = slice(self.length, self.length + count)
        both = np.flatnonzero(self.repeated[:count] & self.repeated[ahead])
        names = np.arange(count)
        if len(both):
            keys = self.names[both] * np.int64(size) + self.names[both + self.length]
            _, first, group = np.unique(keys, return_index=True, return_inverse=True)
            names[both] = both[first][group]
        return Level(2 * self.length, names)


def dictionary(names: np.ndarray) -> list[Level]:
    """Levels up to the last one at which a factor occurs twice."""
    levels = [Level(1, names)]
    while len(levels[-1].places):
        levels.append(levels[-1].doubled(len(names)))
    return levels[:-1]


def proposals(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that the progressions of one level give."""
    places, length = level.places, level.length
    names = level.names[places]
    gaps = np.diff(places)
    linked = (names[1:] == names[:-1]) & (2 * gaps <= length)
    opens = np.flatnonzero(np.concatenate(([True], ~linked)))
    closes = np.append(opens[1:], len(places)) - 1
    first, last = places[opens], places[closes]
    chain = np.repeat(np.arange(len(opens)), closes - opens + 1)
    inner = closes > opens
    at, period = [first[inner]], [gaps[opens[inner]]]
    for hop in range(1, len(opens)):
        # Each place with the nearest end of a progression before it, and of one after it.
        later, earlier = np.flatnonzero(chain >= hop), np.flatnonzero(chain < len(opens) - hop)
        end, begin = chain[later] - hop, chain[earlier] + hop
        found = 0
        for a, b, same in (
            (last[end], places[later], names[opens[end]] == names[later]),
            (places[earlier], first[begin], names[earlier] == names[opens[begin]]),
        ):
            near = same & (b - a <= 2 * length)
            at.append(a[near])
            period.append((b - a)[near])
            found += near.sum()
        if not found:
            break
    return np.concatenate(at), np.concatenate(period)


def extended(
    levels: list[Level], at: np.ndarray, period: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the widest stretch around each place that keeps the period.

    No factor of twice the last level's length occurs twice, so each level is asked once.
    """
    after, before = np.zeros_like(at), np.zeros_like(at)
    for level in reversed(levels):
        width, top = level.length, size - level.length
        place = at + after
        open_ = place + period <= top
        same = level.names[np.where(open_, place, 0)] == level.names[np.where(open_, place + period, 0)]
        after += width * (open_ & same)
        place = at - before - width
        open_ = (place >= 0) & (place + period <= top)
        same = level.names[np.where(open_, place, 0)] == level.names[np.where(open_, place + period, 0)]
        before += width * (open_ & same)
    return at - before, before + after + period


def find_runs(names: np.ndarray, least: int = LEAST) -> np.ndarray:
    """``start, length, period`` of all runs of ``least`` words or more, by start, then period.

    ``names`` gives each word the first place it has. Of stretches with several periods the
    smallest period counts: a stretch of two periods or more that has a smaller period
    is the run of the smaller one.
    """
    size = len(names)
    levels = dictionary(names)
    found = [
        proposals(level) for level in levels if 4 * level.length > least and 2 * level.length <= size
    ]
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)], axis=1), axis=0)
    start, length = extended(levels, pairs[:, 0], pairs[:, 1], size)
    runs = np.stack([start, length, pairs[:, 1]], axis=1)
    runs = runs[length >= np.maximum(least, 2 * pairs[:, 1])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.any(runs[1:, :2] != runs[:-1, :2], axis=1)
    runs = runs[np.concatenate((np.ones(min(1, len(runs)), dtype=bool), new))]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def block_runs(texts: list[list[bytes]], least: int = LEAST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs and kept words of each text, searched together: words of different texts have
    different names, so no factor that crosses from one text into the next occurs twice."""
    names: list[int] = []
    ends = []
    for words in texts:
        seen: dict[bytes, int] = {}
        names.extend(seen.setdefault(word, i) for i, word in enumerate(words, len(names)))
        ends.append(len(names))
    runs = find_runs(np.array(names, dtype=np.int64), least)
    dropped = np.zeros(len(names) + 1, dtype=np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(dropped)[:-1] == 0
    cuts = np.searchsorted(runs[:, 0], ends)
    begin = first = 0
    for end, cut in zip(ends, cuts, strict=True):
        yield runs[first:cut] - np.array([begin, 0, 0]), kept[begin:end]
        begin, first = end, cut


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST
) -> DataFrame:
    """``id, n_words, runs array<struct<start, length, period>>, collapsed`` for each row.

    Words are what stands between ASCII blanks. ``collapsed`` is the text, its words joined by
    one blank, without the words that a run holds after its first period. A null text counts
    as empty: no words, no runs, an empty text. Null and repeated identifiers pass through
    row by row, rows of equal texts get equal runs, a table without rows gives none, and no
    other column is read. A text is one task's work; it takes eight bytes a word for each
    power of two up to its longest repeated stretch.
    """
    schema = pa.schema(
        [("row", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())]
    )

    def search(batches):
        for part, texts in text_blocks(batches, "text", BLOCK_BYTES):
            split = [text.split() for text in texts]
            found, collapsed = [], []
            for words, (runs, kept) in zip(split, block_runs(split, least), strict=True):
                found.append([dict(zip(("start", "length", "period"), run, strict=True)) for run in runs.tolist()])
                rest = words if kept.all() else [words[i] for i in np.flatnonzero(kept)]
                collapsed.append(b" ".join(rest))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(map(len, split), pa.int64()),
                    pa.array(found, pa.list_(RUN)),
                    pa.array(collapsed, pa.string()),
                ],
                schema=schema.set(0, pa.field("row", part.column(0).type)),
            )

    # The text as bytes: their split without arguments is at the six ASCII blanks alone.
    slim = docs.select(F.col(id_column).alias("row"), whole_text(text_column).cast("binary").alias("text"))
    id_type = slim.schema["row"].dataType.simpleString()
    return slim.mapInArrow(
        search,
        f"row {id_type}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
    ).withColumnRenamed("row", id_column)


def planted(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth turn periodic from some word on, as a test of the
    search: ``doc_id`` decides which, from where and with what period. A null identifier
    leaves the text alone."""
    blank = r"[\x20\x09-\x0D]+"
    rows = docs.select(
        "doc_id", whole_text("text").alias("text"), F.crc32(F.col("doc_id").cast("string")).alias("h")
    ).withColumn("g", F.expr("h div 10"))
    words = F.when(
        F.col("h") % 10 == 0, F.filter(F.split("text", blank), lambda w: w != "")
    )
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr(
        "array_join(concat(slice(words, 1, int(a)), "
        "transform(sequence(0, int(n - a) - 1), i -> words[int(a + i % p)])), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each row and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
