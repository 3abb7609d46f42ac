"""Passages that repeat across documents: compact windows, interval joins, verification.

For each of a few hashes, the Cartesian tree over a text's shingle hashes groups all long
subsequences by their minimum: one compact window (left, centre, right) stands for all that
have their minimum at the centre. Texts with a passage in common have windows with the same
minimum; joined windows are extended to the passage and verified.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.llm.components import components
from sparkingest.llm.words import (
    SHINGLE,
    SIMILARITY,
    HashedWords,
    block_hashes,
    mixed,
    seeded,
    shingles,
    signed,
    text_blocks,
    text_key,
    whole_text,
    word_hashes,
)
from sparkingest.session import materialize, option, scratch_table

# Least passage, in words.
LENGTH = 50
# Passages of similarity s have one minimum under a hash with probability s, so three hashes
# miss a pair at 0.8 with 0.008.
HASHES = 3
# A passage of LENGTH words that holds a centre has this many shingles on one side of it.
SIDE = (LENGTH - SHINGLE) // 2
# Hashes whose minimum on a side must agree as well, where a minimum alone says too little.
SIDE_HASHES = 4
# Extension from the centre: a shingle that the other passage lacks costs so many that it
# has, and a passage ends where the sum falls so far below its best. Low costs are tried
# where high ones give no passage.
MISSES, DROP = (4.0, 1.0, 0.5), 30
PIECE = 512

# Parts of the pairs, by their first text, that are compared one after the other.
TURNS = 3
# Shuffle files go when the step that made them has been written.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SIDE_SEED, _WHOLE_SEED = 101, 102
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Bytes of texts, and of packed ones, that are hashed at once.
BLOCK, PACKED_BLOCK = 1_000_000, 300_000


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the first minimum of some ``width`` neighbours, in order."""
    low = np.uint64((1 << 24) - 1)
    packed = (values & ~low) | (np.arange(len(values), dtype=np.uint64) & low)
    span, least = 1, packed
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        gap = width - span
        least = np.minimum(least[:-gap], least[gap:])
    # Within 2 ** 24 places of a window the low bits tell the place apart.
    starts = np.arange(len(least))
    places = (least & low).astype(np.int64)
    base = starts - (starts & int(low))
    places = np.where(places + base < starts, places + base + int(low) + 1, places + base)
    # The place of the minimum never moves back.
    return places[np.concatenate(([True], places[1:] != places[:-1]))]


def compact_windows(values: np.ndarray, width: int) -> np.ndarray:
    """``(left, centre, right)``, inclusive, for every centre whose window has ``width`` or
    more: all subsequences between left and right with the centre have their minimum there.

    Ties go to the left. The nearest smaller value on either side of such a centre is such a
    centre itself, so the tree is built over these alone, with one stack.
    """
    if len(values) < width:
        return np.zeros((0, 3), np.int32)
    found = window_minima(values, width)
    centres, at = found.tolist(), values[found].tolist()
    left = [0] * len(centres)
    right = [len(values) - 1] * len(centres)
    stack: list[int] = []
    for i, value in enumerate(at):
        while stack and at[stack[-1]] > value:
            right[stack.pop()] = centres[i] - 1
        left[i] = centres[stack[-1]] + 1 if stack else 0
        stack.append(i)
    windows = np.array((left, centres, right), dtype=np.int32).T
    return windows[windows[:, 2] - windows[:, 0] + 1 >= width]


def _rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` values: sums of them times powers of a base, by
    differences of the sums from the beginning."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(len(values), _BASE), dtype=np.uint64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(seeded(values, _WHOLE_SEED) * powers, out=sums[1:])
    # The powers of the inverse move each run to the same place.
    back = np.cumprod(np.full(len(values) - width + 1, _INVERSE), dtype=np.uint64)
    return mixed((sums[width:] - sums[:-width]) * back)


def _blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int
) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray, np.ndarray]]:
    """Slices of the batches with their texts, the hashes of all words, and where each text's
    begin and the last one's end."""
    memory: dict[int, int] = {}
    for part, texts in text_blocks(batches, column, limit):
        texts = list(map(_text, texts))
        yield part, texts, *block_hashes(texts, memory)


def _windows(least: int):
    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each compact window: its minimum, left end, centre and right end."""
        for part, texts, words, bounds in _blocks(batches, "text", BLOCK):
            owners, values, places = [], [], []
            # A text that is shorter than a shingle is one.
            sizes = np.diff(bounds).astype(np.int32)
            sizes = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
            joined = shingles(words)
            seeds = [seeded(joined, f) for f in range(HASHES)]
            for i in range(len(texts)):
                if sizes[i] < least:
                    continue
                for f in range(HASHES):
                    if bounds[i + 1] - bounds[i] >= SHINGLE:
                        hashed = seeds[f][bounds[i] : bounds[i] + sizes[i]]
                    else:
                        hashed = seeded(shingles(words[bounds[i] : bounds[i + 1]]), f)
                    found = compact_windows(hashed, least)
                    places.append(found)
                    values.append(hashed[found[:, 1]])
                    owners.append(np.full(len(found), i))
            # A row without value for each text that is long enough: its number of shingles.
            long = np.flatnonzero(sizes >= least)
            found = signed(np.concatenate([np.zeros(0, np.uint64), *values]))
            ends = np.concatenate([np.repeat(sizes[long], 3).reshape(-1, 3), *places])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(np.concatenate([long, *owners]).astype(np.int64))),
                    pa.concat_arrays([pa.nulls(len(long), pa.int64()), pa.array(found)]),
                    *(pa.array(np.ascontiguousarray(ends[:, k], np.int32)) for k in (1, 0, 2)),
                ],
                names=["key", "value", "centre", "left", "right"],
            )

    return windows


def side_minima(own: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centre, side of it and hash: the shingle there with the minimum of the ``SIDE``
    shingles on that side, as one value. Sides that the text's end cuts short have none."""
    values, places = [], []
    for side, offset in enumerate((-SIDE, 1)):
        at = centres[(centres + offset >= 0) & (centres + offset + SIDE <= len(own))]
        blocks = own[(at + offset)[:, None] + np.arange(SIDE)]
        seeds = [_SIDE_SEED + 1000 * (g + 1) + side for g in range(SIDE_HASHES)]
        # All hashes at once, as ``seeded`` makes them one by one.
        offsets = mixed(np.array(seeds, dtype=np.uint64))[:, None]
        least = mixed(blocks ^ offsets[:, :, None]).min(axis=2)
        values.append(mixed(least ^ mixed(own[at] ^ offsets)).ravel())
        places.append(np.tile(at, SIDE_HASHES))
    return np.concatenate(values), np.concatenate(places)


def _finer(least: int):
    def finer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each centre, its side minima and all runs of ``least`` shingles that hold it."""
        for part, texts, words, bounds in _blocks(batches, "packed", PACKED_BLOCK):
            owners, values, places, ends = [], [], [], []
            for i in range(len(texts)):
                own = shingles(words[bounds[i] : bounds[i + 1]])
                at = part.column(2)[i].values.to_numpy().astype(np.int64)
                whole = _rolling(own, least)
                # Runs that hold a centre: from the first start for one to the last.
                held = np.zeros(len(whole) + 1, np.int64)
                np.add.at(held, np.maximum(at - least + 1, 0), 1)
                np.add.at(held, np.minimum(at + 1, len(whole)), -1)
                starts = np.flatnonzero(held.cumsum()[:-1])
                minima, beside = side_minima(own, at)
                values += whole[starts], minima
                places += starts, beside
                owners.append(np.full(len(starts) + len(minima), i))
                ends.append(np.full(len(starts) + len(minima), len(own) - 1, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(np.concatenate(owners))),
                    pa.array(signed(np.concatenate(values))),
                    pa.array(np.concatenate(places).astype(np.int32)),
                    pa.array(np.zeros(sum(map(len, ends)), np.int32)),
                    pa.array(np.concatenate(ends)),
                ],
                names=["key", "value", "centre", "left", "right"],
            )

    return finer


def _numbered(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of both as numbers from 0: equal values have equal numbers."""
    numbers = np.unique(np.concatenate([x, y]), return_inverse=True)[1]
    return numbers[: len(x)], numbers[len(x) :]


def _held(numbers: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which numbers stand among the others."""
    there = np.zeros(max(int(numbers.max(initial=0)), int(others.max(initial=0))) + 1, dtype=bool)
    there[others] = True
    return there[numbers]


def _among(short: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which 16-bit numbers stand among the others."""
    there = np.zeros(1 << 16, dtype=bool)
    there[others] = True
    return there[short]


def _sums(hits: np.ndarray, miss: float) -> np.ndarray:
    """The scores of all beginnings, from the empty one."""
    sums = np.zeros(len(hits) + 1)
    np.cumsum(hits * (1 + miss) - miss, out=sums[1:])
    return sums


def _reach(sums: np.ndarray, sign: int) -> int:
    """How many places from the first on score best; ``sums`` are the scores up to each, times
    ``sign``, and begin before the first."""
    # Most stretches end soon, so a first piece is tried alone.
    for size in (PIECE + 1, len(sums)):
        score = (sums[:size] - sums[0]) * sign
        over = np.maximum.accumulate(score) - score > DROP
        end = int(over.argmax())
        if end or len(sums) <= size:
            return int((score[:end] if end else score).argmax())
    return 0


def _extend(hits: np.ndarray, at: int, miss: float, sums: np.ndarray | None = None) -> tuple[int, int]:
    """The best-scoring stretch around ``at``, both ends inclusive. ``sums`` are those of
    ``hits`` if they are known."""
    if sums is None:
        sums = _sums(hits, miss)
    return at - _reach(sums[at::-1], -1), at + _reach(sums[at + 1 :], 1)


class Comparison:
    """Two texts as shingles, with what comparisons around several places share:
    which shingles stand in the other text, or in a stretch of it, and similarities."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.x, self.y = x, y
        self.numbers: tuple[np.ndarray, np.ndarray] | None = None
        self.hits: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        self.sums: dict[tuple, np.ndarray] = {}
        self.ends: dict[tuple, tuple[int, int]] = {}
        self.known: dict[tuple, float] = {}
        self.whole = (0, len(x), 0, len(y))
        # What stands in the other text by 16 bits of it: all that does, and a little more.
        short = [(v >> np.uint64(48)).astype(np.uint16) for v in (x, y)]
        self.hits[()] = tuple(_among(v, w) for v, w in zip(short, reversed(short), strict=True))

    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """Both texts as numbers, equal where the shingles are."""
        if self.numbers is None:
            self.numbers = _numbered(self.x, self.y)
        return self.numbers

    def stretch(self, part: tuple, side: int, at: int, miss: float) -> tuple[int, int]:
        """The stretch around a place of one text, by what stands in both of two parts (from,
        to, and from, to in the other text), or seems to stand in both texts if there is none."""
        if (found := self.ends.get((part, side, at, miss))) is not None:
            return found
        if part not in self.hits:
            if len(self.hits) > 8:
                self.hits = {k: v for k, v in self.hits.items() if k in ((), self.whole)}
                self.sums = {k: v for k, v in self.sums.items() if k[0] in ((), self.whole)}
            x, y = self.numbered()
            x, y = x[part[0] : part[1]], y[part[2] : part[3]]
            self.hits[part] = _held(x, y), _held(y, x)
        hits, start, key = self.hits[part][side], part[2 * side] if part else 0, (part, side, miss)
        if key not in self.sums:
            self.sums[key] = _sums(hits, miss)
        low, high = _extend(hits, at - start, miss, self.sums[key])
        self.ends[part, side, at, miss] = low + start, high + start
        return low + start, high + start

    def similarity(self, x_low: int, x_high: int, y_low: int, y_high: int) -> float:
        """The weighted Jaccard of two stretches, ends inclusive."""
        ends = (x_low, x_high, y_low, y_high)
        if ends not in self.known:
            x, y = self.numbered()
            x, y = np.sort(x[x_low : x_high + 1]), np.sort(y[y_low : y_high + 1])
            # The n-th of equal numbers has as many equal ones before it in the other, or lacks.
            nth = np.arange(len(x)) - np.searchsorted(x, x)
            both = int((nth < np.searchsorted(y, x, "right") - np.searchsorted(y, x)).sum())
            self.known[ends] = both / (len(x) + len(y) - both)
        return self.known[ends]

    def room(self, at_x: int, at_y: int, least: int) -> bool:
        """Whether the longest stretches that any of the costs allows, with the words next to
        them, reach ``least``. Fewer hits or higher costs never make a stretch longer."""
        for part in ((), self.whole):
            for side, at in ((0, at_x), (1, at_y)):
                low, high = self.stretch(part, side, at, min(MISSES))
                if least - 1 - (high - low) > least // 4:
                    return False
        return True


def _padded(low: int, high: int, size: int, before: int, after: int) -> tuple[int, int]:
    return max(0, low - before), min(size - 1, high + after)


def shared_passage(
    texts: Comparison, at_x: int, at_y: int, miss: float, least: int
) -> tuple[int, int, int, int, float]:
    """The passages around two places with one shingle, and their weighted Jaccard, 0 if one
    is shorter than ``least``.

    Passages that are a little shorter than ``least`` because their ends were edited get the
    words next to them. Where surroundings that are alike in parts spoil it,
    ``equal_stretch`` decides.
    """
    n_x, n_y = len(texts.x), len(texts.y)
    x_low, x_high = texts.stretch(texts.whole, 0, at_x, miss)
    y_low, y_high = texts.stretch(texts.whole, 1, at_y, miss)
    # A stretch cannot reach further than the other text's stretch with room for edits.
    room_low = int(1.25 * max(at_x - x_low, at_y - y_low)) + 1
    room_high = int(1.25 * max(x_high - at_x, y_high - at_y)) + 1
    part = (
        max(0, at_x - room_low),
        min(n_x, at_x + room_high + 1),
        max(0, at_y - room_low),
        min(n_y, at_y + room_high + 1),
    )
    x_low, x_high = texts.stretch(part, 0, at_x, miss)
    y_low, y_high = texts.stretch(part, 1, at_y, miss)
    lacks = least - 1 - min(x_high - x_low, y_high - y_low)
    if 0 < lacks <= least // 4:
        before = min(lacks, x_low, y_low)
        x_low, x_high = _padded(x_low, x_high, n_x, before, lacks - before)
        y_low, y_high = _padded(y_low, y_high, n_y, before, lacks - before)
    ends = (x_low, x_high, y_low, y_high)
    short = min(x_high - x_low, y_high - y_low) + 1 < least
    return *ends, 0.0 if short else texts.similarity(*ends)


def equal_stretch(x: np.ndarray, y: np.ndarray, at_x: int, at_y: int) -> tuple[int, int]:
    """How far the texts are equal before and after two places."""
    n = min(at_x, at_y)
    before = x[at_x - n : at_x] != y[at_y - n : at_y]
    back = n - 1 - int(np.flatnonzero(before)[-1]) if before.any() else n
    n = min(len(x) - at_x, len(y) - at_y)
    after = x[at_x : at_x + n] != y[at_y : at_y + n]
    return back, (int(np.flatnonzero(after)[0]) if after.any() else n) - 1


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by key, compressed, and the first halves of their words' hashes: these go along
    with each pair that a text is in. Five of them tell shingles apart."""
    for part, texts, words, bounds in _blocks(batches, "text", BLOCK):
        packed = [zlib.compress(text.encode("utf-8", "surrogatepass"), 6) for text in texts]
        halves = (words >> np.uint64(32)).astype("<u4")
        prints = [
            zlib.compress(halves[low:high].tobytes(), 1)
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(packed, pa.binary()), pa.array(prints, pa.binary())],
            names=["key", "packed", "prints"],
        )


def _text(packed: str | bytes) -> str:
    return packed if isinstance(packed, str) else zlib.decompress(packed).decode("utf-8", "surrogatepass")


def _compared(prints: str | bytes, memory: HashedWords) -> np.ndarray:
    """The shingles of a text, or of its words' hashes."""
    if isinstance(prints, str):
        return shingles(word_hashes(prints, memory))
    words = mixed(np.frombuffer(zlib.decompress(prints), "<u4").astype(np.uint64))
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1 if width else 0
    out = words[:count].copy()
    for i in range(1, width):
        out *= _BASE
        out += words[i : i + count]
    return out


_WINDOW = "key binary, value bigint, centre int, left int, right int"
_VERIFIED = "a binary, b binary, at_a int, at_b int, a_low int, a_high int, b_low int, b_high int, similar boolean"


def _verify(least: int, similarity: float):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = HashedWords()
        held: tuple[str | bytes, np.ndarray] = ("", np.zeros(0, np.uint64))
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if held[0] != row["text_a"]:
                    held = (row["text_a"], _compared(row["text_a"], memory))
                texts = Comparison(held[1], _compared(row["text_b"], memory))
                known: list[tuple] = []
                for place in row["places"]:
                    at_a, at_b = place["at_a"], place["at_b"]
                    # Places inside a passage that is known give it again, others that failed
                    # only on their diagonal.
                    found = next(
                        (
                            k
                            for k in known
                            if k[0] <= at_a <= k[1]
                            and k[2] <= at_b <= k[3]
                            and (k[4] or k[5] == at_a - at_b)
                        ),
                        None,
                    )
                    if found is None:
                        good = False
                        for miss in MISSES if texts.room(at_a, at_b, least) else ():
                            ends = shared_passage(texts, at_a, at_b, miss, least)
                            good = min(ends[1] - ends[0], ends[3] - ends[2]) + 1 >= least
                            good = good and ends[4] >= similarity
                            if good:
                                break
                        if not good:
                            back, on = equal_stretch(texts.x, texts.y, at_a, at_b)
                            good = back + on + 1 >= least
                            ends = (at_a - back, at_a + on, at_b - back, at_b + on)
                        found = (*ends[:4], good, at_a - at_b)
                        known.append(found)
                    rows.append((row["a"], row["b"], at_a, at_b, *found[:5]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
            kinds = [pa.binary(), pa.binary(), *[pa.int32()] * 6, pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["a", "b", "at_a", "at_b", "a_low", "a_high", "b_low", "b_high", "similar"],
            )

    return verify


def _with_least(windows: DataFrame) -> DataFrame:
    """Each window of a value that several texts share, with the one it is compared with: that
    of the least text, or of the greatest one for further places in the least text."""
    # Most values stand in one text, so a first search only needs a number for each text.
    ends = [f(F.xxhash64("key")).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    several = windows.groupBy("value").agg(*ends).where("low != high").select("value")
    window, of_value = F.struct("key", "centre", "left", "right"), Window.partitionBy("value")
    shared = (
        windows.join(several, "value", "left_semi")
        .withColumns({"least": F.min(window).over(of_value), "most": F.max(window).over(of_value)})
    )
    partner = F.when(F.col("key") == F.col("least.key"), F.col("most")).otherwise(F.col("least"))
    return (
        shared.withColumn("first", (F.col("key") == F.col("least.key")) & (F.col("centre") == F.col("least.centre")))
        .select("value", "key", "centre", "left", "right", "first", partner.alias("other"))
    )


def _overlap() -> Column:
    """How many places the intervals of two windows have in common with centres laid upon
    each other."""
    before = F.least(F.col("centre") - F.col("left"), F.col("other.centre") - F.col("other.left"))
    after = F.least(F.col("right") - F.col("centre"), F.col("other.right") - F.col("other.centre"))
    return before + after + 1


def _pairs(windows: DataFrame) -> DataFrame:
    return windows.where("NOT first").select(
        "value",
        F.col("other.key").alias("a"),
        F.col("key").alias("b"),
        F.col("other.centre").alias("at_a"),
        F.col("centre").alias("at_b"),
        _overlap().alias("overlap"),
    )


def _verified(
    windows: DataFrame, texts: DataFrame, least: int, similarity: float, name: str
) -> DataFrame:
    """Each window against the one it is compared with, where their intervals leave room. The
    words of a text go along with each of its pairs, so pairs are compared in turns: only those
    of one are on disk with them."""
    # Passages of x and y places with a similarity of s share s / (1 + s) * (x + y) of them.
    room = math.ceil(2 * least * similarity / (1 + similarity))
    pairs = (
        _pairs(windows)
        .where(F.col("overlap") >= room)
        .groupBy("a", "b")
        .agg(F.sort_array(F.collect_set(F.struct("at_a", "at_b"))).alias("places"))
    )
    left = texts.select(F.col("key").alias("a"), F.col("prints").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("prints").alias("text_b"))
    done = []
    with scratch_table(pairs, f"{name}-pairs") as pairs:
        for turn in range(TURNS):
            own = pairs.where(F.pmod(F.xxhash64("a"), F.lit(TURNS)) == turn)
            compared = (
                own.join(right, "b")
                .join(left, "a")
                .select("a", "b", "places", "text_a", "text_b")
                .mapInArrow(_verify(least, similarity), _VERIFIED)
            )
            done.append(materialize(compared, f"{name}-{turn}"))
    return reduce(DataFrame.unionByName, done)


def repeated_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document and passage: ``id, passage_id, first_word, last_word, n_words,
    passage_docs``; documents without a repeated passage have none.

    A passage is a stretch of at least ``length`` words that stands in another document too,
    up to a weighted Jaccard similarity of ``similarity`` over its five-word shingles. Words
    are lower-cased runs of letters and digits, counted from 0; overlapping stretches of a
    document are one, and a stretch that a document holds twice is found at both places.
    Passages are classes of linked stretches: ``passage_id`` is the smallest identifier among
    their documents, ``passage_docs`` the number of these rows. Of equal minima in a window
    the first is the centre. Equal texts, repeated rows too, are one node, and repeat as a
    whole if they are long enough; texts are told apart by 128 bits of their digest. Null,
    empty and shorter texts have no passage; rows with a null identifier count as documents
    and are returned with it. An empty table gives no rows. Other columns are not read.

    Windows are joined on hash and minimum, each with the least text of the group, so a
    passage in a third of all documents costs one comparison a document; pairs whose
    intervals leave no room for a passage are not compared. Groups with a window that is not
    explained that way, because what all share is shorter than a passage, are joined once
    more with all members, on further hashes' minima on either side of the centre and on
    whole runs of ``length`` words. Of the latter every group is a match, so no exact repeat
    is lost; a near copy around a line that very many texts share may be.
    """
    least = length - SHINGLE + 1
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.substring(text_key(text_column), 1, 16).alias("key"),
        whole_text(text_column).alias("text"),
    )
    # Whole texts are shuffled more than once, and Spark keeps shuffle files until the driver
    # collects its garbage.
    with option(docs.sparkSession, _DROP_SHUFFLES, "true"):
        members = materialize(rows.select("id", "key"), "passage-members")
        found_windows = rows.select("key", "text").mapInArrow(_windows(least), _WINDOW)
        with scratch_table(found_windows, "passage-windows") as windows:
            grouped = materialize(
                _with_least(windows.where("value IS NOT NULL")).distinct(), "passage-groups"
            )
            long = materialize(
                windows.where("value IS NULL").select("key", (F.col("centre") - 1).alias("high")),
                "passage-long",
            )
        needed = grouped.select("key").distinct()
        texts = materialize(
            rows.select("key", "text")
            .join(needed, "key", "left_semi")
            .groupBy("key")
            .agg(F.first("text").alias("text"))
            .mapInArrow(_packed, "key binary, packed binary, prints binary"),
            "passage-texts",
        )
        checked = _verified(grouped, texts, least, similarity, "passage-checked")
        # Where a window is not explained, its text may still hold a passage of another member,
        # so all members of the group are joined by finer values.
        explained = checked.where("similar").select("a", "b", "at_a", "at_b")
        torn = (
            _pairs(grouped).join(explained, ["a", "b", "at_a", "at_b"], "left_anti").select("value").distinct()
        )
        left_over = (
            grouped.join(torn, "value", "left_semi")
            .groupBy("key")
            .agg(F.sort_array(F.collect_set("centre")).alias("centres"))
        )
        finer = (
            texts.join(left_over, "key")
            .select("key", "packed", "centres")
            .mapInArrow(_finer(least), _WINDOW)
        )
        with scratch_table(finer, "passage-finer") as windows:
            again = _verified(_with_least(windows), texts, least, similarity, "passage-rechecked")
        links = checked.unionByName(again).where("similar")

        copied = members.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")
        whole = (
            long.join(copied, "key", "left_semi")
            .select("key", F.lit(0).alias("low"), "high")
            .distinct()
        )
        found = (
            links.select(F.col("a").alias("key"), F.col("a_low").alias("low"), F.col("a_high").alias("high"))
            .union(links.select("b", "b_low", "b_high"))
            .union(whole)
            .distinct()
        )
        in_text = Window.partitionBy("key").orderBy("low", "high")
        before = in_text.rowsBetween(Window.unboundedPreceding, -1)
        spans = materialize(
            found.withColumn(
                "opens", (F.col("low") > F.coalesce(F.max("high").over(before), F.lit(-1))).cast("int")
            )
            .withColumn("span", F.sum("opens").over(in_text))
            .groupBy("key", "span")
            .agg(F.min("low").alias("low"), F.max("high").alias("high")),
            "passage-spans",
        )

        def node(prefix: str) -> DataFrame:
            return spans.select(
                F.col("key").alias(prefix),
                F.col("low").alias(f"{prefix}_from"),
                F.col("high").alias(f"{prefix}_to"),
                F.struct("key", "span").alias(f"{prefix}_node"),
            )

        joined = (
            links.select("a", "b", "a_low", "b_low")
            .distinct()
            .join(node("a"), "a")
            .where(F.col("a_low").between(F.col("a_from"), F.col("a_to")))
            .join(node("b"), "b")
            .where(F.col("b_low").between(F.col("b_from"), F.col("b_to")))
            .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        )
        roots = components(joined, "passage-links")
    classed = spans.withColumn("node", F.struct("key", "span")).join(
        roots.withColumnRenamed("key", "node"), "node", "left"
    )
    classed = classed.withColumn("root", F.coalesce("root", "node")).select(
        "key", "low", "high", "root"
    )
    placed = members.join(classed, "key")
    classes = placed.groupBy("root").agg(
        F.min("id").alias("passage_id"), F.count("*").alias("passage_docs")
    )
    return placed.join(classes, "root").select(
        F.col("id").alias(id_column),
        "passage_id",
        F.col("low").cast("bigint").alias("first_word"),
        (F.col("high") + SHINGLE - 1).cast("bigint").alias("last_word"),
        (F.col("high") - F.col("low") + SHINGLE).cast("bigint").alias("n_words"),
        "passage_docs",
    )
