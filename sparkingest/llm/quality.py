"""Quality scores from random-indexing word vectors and a small network.

Every word has a sparse random index vector; its context vector sums the index vectors of
its neighbours over the whole corpus. A document is the mean of its words' vectors. A
two-layer network maps it to a score whose temperature is set on rows kept out of the fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkingest.llm.words import text_blocks, whole_text

BUCKETS = 8192
DIMENSIONS = 64
NONZERO = 2
WINDOW = 2
BLOCK = 256
SALTS = 64
HIDDEN = 32
EPOCHS = 200
BATCH = 256
# Most labelled rows that a fit uses, chosen by the hash of their identifier.
TRAIN_LIMIT = 20_000
# One labelled row in so many sets the temperature instead of the weights.
CALIBRATION = 5
HELD_OUT_FOLDS, HELD_OUT = 3, 1

_FEATURES = 2 * DIMENSIONS + 2


def index_vectors() -> np.ndarray:
    """``NONZERO`` entries of +1 or -1 for each bucket; the last row is a gap without any."""
    random = np.random.default_rng(20_240_101)
    vectors = np.zeros((BUCKETS + 1, DIMENSIONS), dtype=np.float32)
    for k in range(NONZERO):
        places = random.integers(0, DIMENSIONS // NONZERO, BUCKETS) + k * (DIMENSIONS // NONZERO)
        vectors[np.arange(BUCKETS), places] = random.choice([-1.0, 1.0], BUCKETS)
    return vectors


def _bucket(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % BUCKETS


class Vocabulary(dict):
    """Word -> bucket of its letters times ``BUCKETS`` plus bucket of its shape.

    The shape is the case of the letters and the signs around them.
    """

    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        core = "".join(c for c in word if c.isalnum())
        if not core:
            case = "none"
        elif core.isdigit():
            case = "digits"
        elif core.isupper() and len(core) > 1:
            case = "upper"
        elif core.islower():
            case = "lower"
        else:
            case = "title" if core[0].isupper() and not core[1:].isupper() else "mixed"
        signs = "".join(c for c in word if not c.isalnum())[:4]
        value = self[word] = _bucket(core.lower()) * BUCKETS + _bucket(f"{case} {signs}")
        return value


def word_buckets(text: str, vocabulary: Vocabulary) -> np.ndarray:
    """Buckets of letters and shapes of the words between blanks, alternating, in order."""
    words = text.split()
    joint = np.fromiter((vocabulary[w] for w in words), dtype=np.int64, count=len(words))
    out = np.empty(2 * len(words), dtype=np.int64)
    out[0::2], out[1::2] = joint // BUCKETS, joint % BUCKETS
    return out


# ---------------------------------------------------------------- context vectors


def _count_contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of buckets: the sums of this task, as bytes of int32."""
    index = index_vectors()
    places = np.argsort(-np.abs(index), axis=1, kind="stable")[:, :NONZERO]
    signs = np.take_along_axis(index, places, axis=1)
    vocabulary = Vocabulary()
    total = np.zeros((BUCKETS + 1) * DIMENSIONS)
    gap = np.full(WINDOW, BUCKETS, dtype=np.int64)
    for _, texts in text_blocks(batches, "text", 1_000_000):
        row = np.concatenate([x for t in texts for x in (word_buckets(t, vocabulary), gap)])
        for step in range(1, WINDOW + 1):
            for own, other in ((row[:-step], row[step:]), (row[step:], row[:-step])):
                for k in range(NONZERO):
                    total += np.bincount(
                        own * DIMENSIONS + places[other, k],
                        weights=signs[other, k],
                        minlength=len(total),
                    )
    sums = total.reshape(-1, DIMENSIONS)[:BUCKETS].astype(np.int64)
    salt = TaskContext.get().partitionId() % SALTS
    yield _blocks({b: sums[b * BLOCK : (b + 1) * BLOCK] for b in range(BUCKETS // BLOCK)}, salt)


def _blocks(sums: dict[int, np.ndarray], salt: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()),
            pa.array([salt] * len(sums), pa.int32()),
            pa.array([x.astype(np.int64).tobytes() for x in sums.values()], pa.binary()),
        ],
        names=["block", "salt", "sums"],
    )


def _add_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the rows of a partition by block; one array for each block is held."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(
            batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True
        ):
            sums = np.frombuffer(data, dtype=np.int64)
            held[block] = held[block] + sums if block in held else sums.copy()
    yield _blocks(held, 0)


_BLOCK_SCHEMA = "block int, salt int, sums binary"


def context_vectors(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Context vectors of all buckets over all texts, each scaled to length 1.

    Tasks sum whole numbers, so the result does not depend on the partitions. The sums are
    added in two steps: no task reads more than ``tasks / SALTS`` arrays of a block, and the
    driver gets ``BUCKETS x DIMENSIONS`` numbers.
    """
    counted = docs.select(whole_text(text_column).alias("text")).mapInArrow(
        _count_contexts, _BLOCK_SCHEMA
    )
    blocks = BUCKETS // BLOCK
    salted = counted.repartition(blocks, "block", "salt").mapInArrow(_add_blocks, _BLOCK_SCHEMA)
    summed = salted.repartition(blocks, "block").mapInArrow(_add_blocks, _BLOCK_SCHEMA)
    out = np.zeros((BUCKETS + 1, DIMENSIONS), dtype=np.float32)
    for row in summed.collect():
        part = np.frombuffer(row.sums, dtype=np.int64).reshape(BLOCK, DIMENSIONS)
        norm = np.maximum(np.sqrt((part.astype(float) ** 2).sum(axis=1, keepdims=True)), 1.0)
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = part / norm
    return out


def pooled(text: str, vectors: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The mean vector of the words, the share of distinct words and the log of their number."""
    row = word_buckets(text, vocabulary)
    out = np.zeros(_FEATURES, dtype=np.float32)
    if not len(row):
        return out
    values, counts = np.unique(row, return_counts=True)
    out[: 2 * DIMENSIONS] = counts.astype(np.float32) @ vectors[values] / len(row)
    out[-2] = len(values) / len(row)
    out[-1] = math.log1p(len(row))
    return out


# ------------------------------------------------------------------------ network


@dataclass
class Network:
    """``sigmoid(tanh(x w1 + b1) w2 + b2) / temperature`` over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((features - self.mean) / self.scale) @ self.w1 + self.b1)
        return (hidden @ self.w2 + self.b2) / self.temperature

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(features), -40, 40)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def fit_network(features: np.ndarray, labels: np.ndarray, calibrate: np.ndarray) -> Network:
    """Fit on rows outside ``calibrate``, then the temperature on those inside.

    Without rows of both classes the score is the share of label 1, or 0.5 without rows.
    """
    random = np.random.default_rng(7)
    width = features.shape[1]
    fitted = features[~calibrate].astype(np.float64)
    wanted = labels[~calibrate].astype(np.float64)
    if not len(wanted) or wanted.min() == wanted.max():
        share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
        return Network(
            np.zeros(width),
            np.ones(width),
            np.zeros((width, 1)),
            np.zeros(1),
            np.zeros(1),
            math.log(share / (1 - share)),
        )
    network = Network(
        fitted.mean(axis=0),
        fitted.std(axis=0) + 1e-6,
        random.normal(0, 1 / math.sqrt(width), (width, HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN),
        0.0,
    )
    x = (fitted - network.mean) / network.scale
    weights = [network.w1, network.b1, network.w2, np.array([network.b2])]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    epochs = max(20, min(EPOCHS, 400_000 // len(x)))
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            w1, b1, w2, b2 = weights
            hidden = np.tanh(x[rows] @ w1 + b1)
            error = 1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -40, 40))) - wanted[rows]
            back = np.outer(error, w2) * (1 - hidden**2)
            n = len(rows)
            slopes = [
                x[rows].T @ back / n + 1e-4 * w1,
                back.mean(axis=0),
                hidden.T @ error / n + 1e-4 * w2,
                np.array([error.mean()]),
            ]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                scaled = first[i] / (1 - 0.9**step)
                weights[i] = weights[i] - 3e-3 * scaled / (
                    np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
                )
    network.w1, network.b1, network.w2, network.b2 = *weights[:3], float(weights[3][0])
    if calibrate.any():
        logits = network.logits(features[calibrate].astype(np.float64))
        choices = np.exp(np.linspace(math.log(0.25), math.log(8.0), 60))
        network.temperature = float(
            min(choices, key=lambda t: _loss(logits / t, labels[calibrate].astype(np.float64)))
        )
    return network


# -------------------------------------------------------------------------- spark


def fold(id_column: str = "id"):
    """The remainder that decides whether a row may be learnt from; a null id counts as ''."""
    return F.pmod(
        F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")),
        F.lit(HELD_OUT_FOLDS),
    )


def _featurise(vectors: np.ndarray):
    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for part, texts in text_blocks(batches, "text"):
            rows = [pooled(text, vectors, vocabulary).tolist() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(rows, pa.list_(pa.float32()))],
                names=["id", "label", "features"],
            )

    return features


def _score(vectors: np.ndarray, network: Network):
    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for part, texts in text_blocks(batches, "text"):
            rows = np.array([pooled(text, vectors, vocabulary) for text in texts])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(network.scores(rows.astype(np.float64)), pa.float64())],
                names=["id", "score"],
            )

    return scores


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    train_limit: int = TRAIN_LIMIT,
) -> tuple[np.ndarray, Network]:
    """Word vectors of all texts, and the network fitted on labelled rows that may be learnt
    from. Labels that are null, not 0 or 1 or contradictory are not used, nor are those
    without a document; repeated rows are learnt from once."""
    vectors = np.concatenate([context_vectors(docs, text_column), index_vectors()], axis=1)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"), whole_text(text_column).alias("text")
    )
    usable = (
        labels.select(
            F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("int").alias("y")
        )
        .where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min("y").alias("label"), F.max("y").alias("other"))
        .where((F.col("label") == F.col("other")) & (fold() != HELD_OUT))
        .select("id", "label")
        .orderBy(F.xxhash64("id"), "id")
        .limit(train_limit)
    )
    # At most ``train_limit`` rows are broadcast, and as many come back.
    learnt = (
        rows.join(F.broadcast(usable), "id")
        .select("id", "label", "text")
        .mapInArrow(_featurise(vectors), "id bigint, label int, features array<float>")
        .groupBy("id", "label")
        .agg(F.min("features").alias("features"))
        .orderBy("id")
        .toArrow()
    )
    ids = learnt.column("id").to_pylist()
    features = np.array(learnt.column("features").to_pylist(), dtype=np.float32)
    calibrate = np.array(
        [xxhash.xxh3_64_intdigest(str(i).encode()) % CALIBRATION == 0 for i in ids], dtype=bool
    )
    network = fit_network(
        features.reshape(-1, _FEATURES), np.array(learnt.column("label").to_pylist()), calibrate
    )
    return vectors, network


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    train_limit: int = TRAIN_LIMIT,
) -> DataFrame:
    """One row per input row: ``id, held_out, score, predicted``.

    The score is the probability of label 1. Word vectors come from all texts; the network
    from at most ``train_limit`` labelled rows outside the held-out fold (see
    ``fit_quality``). A null or empty text has the zero vector and gets a score like any
    other. Repeated rows stay repeated. An empty table gives no rows; without usable labels
    every score is 0.5. Only the text reaches the score; other columns are not read.
    """
    vectors, network = fit_quality(
        docs, labels, label_column, id_column, text_column, train_limit
    )
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"), whole_text(text_column).alias("text")
    )
    scored = rows.mapInArrow(_score(vectors, network), "id bigint, score double")
    return scored.select(
        F.col("id").alias(id_column),
        (fold() == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose score is 0.5 or more, with all their columns. Rows are
    scored as by ``score_quality`` and not moved."""
    vectors, network = fit_quality(docs, labels, label_column, id_column, text_column)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for part, texts in text_blocks(batches, text):
            rows = np.array([pooled(text or "", vectors, vocabulary) for text in texts])
            yield part.filter(pa.array(network.scores(rows.astype(np.float64)) >= 0.5))

    # By number, since a name may hold a dot or come twice.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_column)}"
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
