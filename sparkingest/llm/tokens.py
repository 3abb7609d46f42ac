"""Token counts of whole texts, with overlap resynchronisation for very long ones.

A long text is encoded in overlapping chunks, with the offsets of their tokens. Two
neighbouring chunks are spliced where a token of each ends at one place that no context can
change; where the overlap holds no such place, it is widened.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkingest.llm.words import text_blocks, whole_text

VOCABULARY = "byte_bpe_50k.json"
CHUNK_CHARS = 50_000
OVERLAP_CHARS = 200

# Fixed: the word pattern of byte-level BPE files that ask for "use_regex".
BYTE_LEVEL_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def _letters_to_bytes() -> dict[str, int]:
    """Byte-level files write printable bytes as themselves, others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def load(path: str):
    """An encoder with the vocabulary, merges and special strings of a tokenizer file.

    tiktoken encodes such files several times faster than the library they are made for, and
    to the same tokens if merges rank as their results are numbered, which is checked here.
    Files with a normaliser, a prefix space or special strings that hold or swallow blanks
    are refused, as chunks of theirs could not be spliced.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    words, model = described.get("pre_tokenizer") or {}, described["model"]
    special = described.get("added_tokens") or []
    if (
        described.get("normalizer") is not None
        or words.get("type") != "ByteLevel"
        or words.get("add_prefix_space")
        or not words.get("use_regex", True)
        or any(model.get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix"))
        or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in special)
        or any(c.isspace() for t in special for c in t["content"])
    ):
        raise ValueError(f"{path}: chunks of this kind of tokenizer cannot be spliced")
    to_byte = _letters_to_bytes()
    names = {t["content"] for t in special}
    ranks = {
        bytes(to_byte[c] for c in token): number
        for token, number in model["vocab"].items()
        if token not in names
    }
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    numbers = [model["vocab"]["".join(m)] for m in merges]
    if numbers != sorted(numbers) or len(ranks) != 256 + len(merges):
        raise ValueError(f"{path}: merges do not rank as their tokens are numbered")
    return tiktoken.Encoding(
        path,
        pat_str=BYTE_LEVEL_PATTERN,
        mergeable_ranks=ranks,
        special_tokens={t["content"]: t["id"] for t in special},
    )


def _encoded(encoder, text: str) -> np.ndarray:
    return encoder.encode_to_numpy(text, allowed_special="all")


def _token_ends(encoder, chunk: str) -> np.ndarray:
    """Bytes from the beginning of the chunk to the end of each of its tokens."""
    pieces = encoder.decode_tokens_bytes(_encoded(encoder, chunk).tolist())
    return np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))


def _stable_places(chunk: str) -> np.ndarray:
    """Bytes to each place where a blank follows another character.

    No word of the byte-level pattern and no special string goes on from a character that is
    not blank to one that is, so a word ends there whatever stands before or after.
    """
    data = chunk.encode("utf-8")
    values = np.frombuffer(data, dtype=np.uint8)
    blank = (values == 32) | ((values >= 9) & (values <= 13))
    return np.flatnonzero(blank[1:] & ~blank[:-1] & (values[:-1] < 128)) + 1


def count_tokens(
    text: str, encoder, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> int:
    """Tokens of the text, exactly as if it were encoded in one piece.

    Each chunk begins within the one before. They are spliced at their last common token
    end that is stable. If the overlap holds none, it doubles, at most to the whole chunk
    before; then that chunk itself doubles.
    """
    if len(text) <= chunk + overlap:
        return len(_encoded(encoder, text))
    total, start, size = 0, 0, chunk
    first = text[:size]
    ends = _token_ends(encoder, first)
    while start + size < len(text):
        stop, width, spliced = start + size, overlap, None
        while spliced is None:
            begin = max(stop - width, start)
            other = text[begin : begin + max(chunk, 2 * width)]
            other_ends = _token_ends(encoder, other)
            shift = len(text[start:begin].encode("utf-8"))
            stable = _stable_places(text[begin:stop])
            common = np.intersect1d(np.intersect1d(stable, other_ends), ends - shift)
            if len(common):
                spliced = int(common[-1])
            elif begin == start:
                break
            width *= 2
        if spliced is None:
            size *= 2
            ends = _token_ends(encoder, text[start : start + size])
            continue
        total += int(np.searchsorted(ends, spliced + shift, side="right"))
        # The next chunk goes on from the splice.
        start = begin + len(other.encode("utf-8")[:spliced].decode("utf-8"))
        size = len(other) - (start - begin)
        ends = other_ends[other_ends > spliced] - spliced
    return total + len(ends)


def _counter(path: str, chunk: int, overlap: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for part, texts in text_blocks(batches, "text"):
            counts = [count_tokens(text, encoder, chunk, overlap) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    return count


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_tokens, over_limit``.

    Counts are those of the tokenizer file at ``path`` (the same on every executor) for the
    whole text, without added special tokens; special strings inside a text are read as the
    file says. A null text is empty and has no tokens. Repeated rows stay repeated. An empty
    table gives no rows. Other columns are not read. Rows are neither shuffled nor held.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.octet_length(whole_text(text_column)).cast("bigint").alias("n_bytes"),
        whole_text(text_column).alias("text"),
    )
    counted = rows.mapInArrow(
        _counter(path, chunk_chars, overlap_chars), "id bigint, n_bytes bigint, n_tokens bigint"
    )
    return counted.select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
