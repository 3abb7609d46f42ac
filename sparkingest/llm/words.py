"""Words, their hashes and bounded batches, for functions that run inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
SHINGLE = 5
SIMILARITY = 0.8

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY_1 = np.uint64(0xBF58476D1CE4E5B9)
_MULTIPLY_2 = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0xD1342543DE82EF95)


def whole_text(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str) -> Column:
    """Texts with one key are equal: 256 bits of SHA-2 over the whole text."""
    return F.unhex(F.sha2(whole_text(column), 256))


class HashedWords(dict):
    """Word -> 64-bit hash, remembered; forgotten when the vocabulary gets large."""

    LIMIT = 1_000_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes(text: str, memory: HashedWords, pattern: re.Pattern = WORD) -> np.ndarray:
    """Hashes of the lower-cased words, in order."""
    words = pattern.findall(text.lower())
    return np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))


@cache
def _word_codes() -> np.ndarray:
    """Whether ``WORD`` takes a code point."""
    return np.fromiter((c == 95 or chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@cache
def _powers(count: int) -> np.ndarray:
    return np.cumprod(np.full(count, _BASE), dtype=np.uint64)


def block_hashes(texts: list[str], memory: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of many texts, one after the other, and where each text begins and the
    last one ends. ``memory`` holds hashes by a first hash, for which no string is made."""
    lower = [text.lower() for text in texts]
    joined = "\n".join(lower)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = _word_codes()[codes]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    texts_end = np.cumsum([len(text) + 1 for text in lower], dtype=np.int64)
    bounds = np.concatenate(([0], np.searchsorted(starts, texts_end)))
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    # Sums of code points times powers of a base, over the characters of words alone.
    firsts = np.cumsum(sizes) - sizes
    nth = np.arange(firsts[-1] + sizes[-1]) - np.repeat(firsts, sizes)
    longest = 1 << int(sizes.max()).bit_length()
    terms = mixed(codes[inside].astype(np.uint64)) * _powers(longest)[nth]
    first = mixed(np.add.reduceat(terms, firsts) ^ mixed(sizes.astype(np.uint64)))
    values, at, places = np.unique(first, return_index=True, return_inverse=True)
    if len(memory) + len(values) > HashedWords.LIMIT:
        memory.clear()
    hashes = list(map(memory.get, values.tolist()))
    for i, known in enumerate(hashes):
        if known is None:
            word = joined[starts[at[i]] : starts[at[i]] + sizes[at[i]]]
            value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
            memory[int(values[i])] = hashes[i] = value
    return np.array(hashes, dtype=np.uint64)[places], bounds


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        values = values + _MIX
        values ^= values >> np.uint64(30)
        values *= _MULTIPLY_1
        values ^= values >> np.uint64(27)
        values *= _MULTIPLY_2
        values ^= values >> np.uint64(31)
        return values


@cache
def _offset(seed: int) -> np.uint64:
    return mixed(np.array([seed], dtype=np.uint64))[0]


def seeded(values: np.ndarray, seed: int) -> np.ndarray:
    """Independent hashes of the same values, one for each seed."""
    return mixed(values ^ _offset(seed))


def shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """A hash for each run of ``width`` words; one for the whole text if it is shorter."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    out = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        out = mixed(out ^ words[i : i + count])
    return out


def bag(values: np.ndarray) -> np.ndarray:
    """A multiset as a set: the n-th occurrence of a value becomes a value of its own.

    Sizes of intersections of two such sets are multiset overlaps.
    """
    ordered = np.sort(values)
    if not len(ordered):
        return ordered
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    lengths = np.diff(np.append(starts, len(ordered)))
    nth = np.arange(len(ordered)) - np.repeat(starts, lengths)
    return np.where(nth == 0, ordered, mixed(ordered ^ mixed(nth.astype(np.uint64))))


def text_blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = 4_000_000
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose texts hold about ``limit`` bytes, with these texts.

    One text may exceed the limit; it then has a slice of its own.
    """
    for batch in batches:
        start = 0
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, texts.slice(start, stop - start).to_pylist()
            start = stop


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's BIGINT."""
    return values.view(np.int64)
