"""Language identification: each text as a mixture of languages, inferred by expectation-maximisation.

Three-letter sequences of all labelled texts are counted for each language, in hashed
buckets with the same prior for each. A text's words are the draws: each comes from one
language with the text's own proportions, and its likelihood under a language is that of its
sequences. Proportions are found by expectation-maximisation, and the languages by penalised
likelihood: starting with the best one, the next in order of the full mixture joins
as long as the likelihood grows by more than its parameter costs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkingest.llm.words import mixed, text_blocks, whole_text

GRAM = 3
BUCKET_BITS = 16
# What is added to each bucket's count.
PRIOR = 0.1
# Rounds of expectation-maximisation for each set of languages.
ROUNDS = 20
# Cells (letters times languages) that are held at once.
BLOCK_CELLS = 8_000_000
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def letters_table() -> np.ndarray:
    """For each code point whether it is a letter; made once in a worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all sequences, where each word begins among them, and each text's word count.

    A word is a stretch of letters, in lower case, with a blank on both sides; it has as many
    sequences as letters.
    """
    points = np.frombuffer(" ".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = letters_table()[points]
    points = np.where(letter, points, 0).astype(np.uint64)
    # A sequence is centred on a letter; 21 bits hold a code point.
    code = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    centre = letter[1:-1]
    buckets = (mixed(code[centre]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    begins = centre & ~letter[:-2]
    words = np.flatnonzero(begins[centre])
    # Lower case may change a text's length, so ends are taken from the lowered texts.
    ends = np.cumsum([len(text.lower()) + 1 for text in texts])
    per_text = np.diff(np.searchsorted(np.flatnonzero(begins), ends, side="left"), prepend=0)
    return buckets, words, per_text


def gram_counts(docs: DataFrame, label: str, text_column: str) -> DataFrame:
    """``language, bucket, n`` over all rows; each task adds up its own rows first."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part, texts in text_blocks(batches, "text", BLOCK_CELLS // 8):
            languages = part.column(0).dictionary_encode()
            for number, language in enumerate(languages.dictionary.to_pylist()):
                mine = np.flatnonzero(pc.equal(languages.indices, number).to_numpy(zero_copy_only=False))
                buckets, _, _ = grams([texts[i] for i in mine])
                total = totals.setdefault(language, np.zeros(1 << BUCKET_BITS, dtype=np.int64))
                total += np.bincount(buckets, minlength=1 << BUCKET_BITS)
        for language, total in totals.items():
            met = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(met), pa.string()), pa.array(met), pa.array(total[met])],
                names=["language", "bucket", "n"],
            )

    rows = docs.select(F.col(label).cast("string").alias("language"), whole_text(text_column).alias("text"))
    parts = rows.mapInArrow(count, "language string, bucket bigint, n bigint")
    return parts.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and the logarithm of each bucket's share, a column for each language.

    Languages times 65 536 numbers reach the driver: the size of the model, not of the data.
    A language without a single letter stays one, with equal shares.
    """
    table = counts.toArrow()
    languages = sorted(set(table.column("language").to_pylist()))
    place = {language: i for i, language in enumerate(languages)}
    totals = np.full((1 << BUCKET_BITS, len(languages)), PRIOR)
    column = [place[x] for x in table.column("language").to_pylist()]
    totals[table.column("bucket").to_numpy(), column] += table.column("n").to_numpy()
    return languages, np.log(totals / totals.sum(axis=0)).astype(np.float32)


def _sums(values: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Sums over each text's words; every text has some."""
    return np.add.reduceat(values, np.cumsum(per_text) - per_text, axis=0)


def proportions(
    likelihood: np.ndarray, per_text: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages in each text and the logarithm of its likelihood.

    ``likelihood`` has a row for each word, its greatest value being 1.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = likelihood * np.repeat(share, per_text, axis=0)
        joint /= np.maximum(joint.sum(axis=1, keepdims=True), np.finfo(float).tiny)
        share = _sums(joint, per_text)
        share /= np.maximum(share.sum(axis=1, keepdims=True), np.finfo(float).tiny)
    joint = (likelihood * np.repeat(share, per_text, axis=0)).sum(axis=1)
    return share, _sums(np.log(np.maximum(joint, np.finfo(float).tiny)), per_text)


def mixtures(word_logs: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Proportions of each text's languages, zero for those that its penalised likelihood
    leaves out. ``word_logs``: a row for each word, a column for each language."""
    highest = word_logs.max(axis=1, keepdims=True)
    likelihood = np.exp((word_logs - highest).astype(np.float64))
    languages = word_logs.shape[1]
    full, _ = proportions(likelihood, per_text, np.ones((len(per_text), languages)))
    # Best alone first: with proportions of 1 its likelihood is a plain sum.
    alone = _sums(np.maximum(word_logs - highest, -700.0), per_text)
    first = alone.argmax(axis=1)
    order = np.argsort(-full, axis=1, kind="stable")
    text = np.arange(len(per_text))
    allowed = np.zeros((len(per_text), languages))
    allowed[text, first] = 1
    share, best = allowed.copy(), alone[text, first]
    # A language's cost: half the logarithm of the number of draws.
    cost = 0.5 * np.log(per_text)
    growing = text
    tried = allowed.copy()
    for rank in range(languages):
        # The next language by the full mixture that is not in the set yet.
        added = order[growing, rank]
        fresh = tried[growing, added] == 0
        mine = growing[fresh]
        if len(mine):
            tried[mine, added[fresh]] = 1
            chosen = np.repeat(np.isin(text, mine), per_text)
            wider, likely = proportions(likelihood[chosen], per_text[mine], tried[mine])
            better = likely > best[mine] + cost[mine]
            share[mine[better]], best[mine[better]] = wider[better], likely[better]
            growing = np.setdiff1d(growing, mine[~better], assume_unique=True)
        if not len(growing):
            break
    return share


def block_mixtures(texts: list[str], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions for each text and its number of words; zeros where it has no letter.

    Sequences overlap, each letter takes part in three: the likelihood of a word is the
    third root of their product.
    """
    buckets, words, per_text = grams(texts)
    share = np.zeros((len(texts), logs.shape[1]))
    some = per_text > 0
    if some.any() and logs.shape[1]:
        share[some] = mixtures(_word_logs(buckets, words, logs), per_text[some])
    return share, per_text


def _word_logs(buckets: np.ndarray, words: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """A row for each word; sequences are looked up some words at a time."""
    out = np.empty((len(words), logs.shape[1]), dtype=np.float32)
    ends = np.append(words[1:], len(buckets))
    step, first = BLOCK_CELLS // logs.shape[1], 0
    while first < len(words):
        last = max(first + 1, int(np.searchsorted(ends, words[first] + step, side="right")))
        part = logs[buckets[words[first] : ends[last - 1]]]
        out[first:last] = np.add.reduceat(part, words[first:last] - words[first], axis=0) / GRAM
        first = last
    return out


def identify(
    docs: DataFrame, languages: list[str], logs: np.ndarray, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, language, score, mixture`` of each row's whole text.

    ``language`` has the greatest proportion of the chosen languages (ties: the first by
    name), ``score`` is that proportion and ``mixture`` holds all chosen ones. A text
    that is null or without a letter is ``und`` with score 0 and an empty mixture, as is
    every text if nothing was learned. Null and repeated identifiers pass through, and a
    table without rows gives none. A text is scored whole, in one task.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((languages, logs))
    mixture = pa.map_(pa.string(), pa.float64())

    def score(batches) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for part, texts in text_blocks(batches, "text", max(100_000, BLOCK_CELLS // max(1, len(names)))):
            share, _ = block_mixtures(texts, table)
            best = share.argmax(axis=1) if len(names) else np.zeros(len(texts), dtype=int)
            top = share.max(axis=1, initial=0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([names[b] if t > 0 else UNDETERMINED for b, t in zip(best, top, strict=True)], pa.string()),
                    pa.array(np.minimum(top, 1.0)),
                    pa.array(
                        [[(names[i], float(row[i])) for i in np.flatnonzero(row)] for row in share], mixture
                    ),
                ],
                names=["row", "language", "score", "mixture"],
            )

    slim = docs.select(F.col(id_column).alias("row"), whole_text(text_column).alias("text"))
    id_type = slim.schema["row"].dataType.simpleString()
    return slim.mapInArrow(
        score, f"row {id_type}, language string, score double, mixture map<string,double>"
    ).withColumnRenamed("row", id_column)


def fold(id_column: str, folds: int):
    """The rest of the identifier's checksum; null for a null identifier."""
    return F.crc32(F.col(id_column).cast("string")) % folds


def predict_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, mixture``: learned from the documents outside the
    held-out fifth that have a language, applied to all.

    A row with a null identifier is in no fold: it is neither learned from nor held out.
    Repeated rows are learned from as often as they occur.
    """
    known = docs.where((fold("doc_id", 5) != 0) & F.col("lang").isNotNull())
    languages, logs = language_model(gram_counts(known, "lang", "text"))
    return identify(docs, languages, logs).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("language").alias("lang_pred"),
        "score",
        "mixture",
    )
