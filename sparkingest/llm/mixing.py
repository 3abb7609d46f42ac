"""Mixing to target weights with soft domain membership.

A word classifier, counted on labelled rows, gives every document posterior probabilities of
the domains. Projected gradient descent then fits nonnegative document rates under which the
expected tokens of each domain match the targets.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkingest.llm.words import whole_text
from sparkingest.session import materialize

log = logging.getLogger(__name__)

BUCKETS = 4096
# Most labelled rows that the classifier counts, chosen by the hash of their identifier.
TRAIN_LIMIT = 20_000
# Posteriors are whole parts of this number, so documents of like membership share a rate.
# Profiles number at most 47 905 with four domains.
PARTS = 64
# Words are not independent; a text counts as this many that are.
EVIDENCE = 16.0
# Weight of the squared distance of rates from 1, against that of the domains' shares.
RIDGE = 1e-4
STEP = 1.0 / (1.0 + RIDGE)
# Most steps, and how many of them the plan of one table of rates holds.
STEPS, STRETCH = 400, 25
# The descent ends when every domain's tokens miss its target by less than this part of it, or
# when a stretch of steps lowers the sum of squares by less than this part, as where no rates
# reach the targets.
TOLERANCE, STALLED = 1e-3, 0.01
# A domain's share counts as met within this distance.
MET = 0.002
# Exponent of the natural shares that gives the default targets: below 1, small domains gain.
SMOOTHING = 0.7
MAX_DOMAINS = 64


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s"), lambda w: w != "")


def _log_likelihood(buckets: str, log_word: list[float]) -> Column:
    """Sum of the log probabilities of the buckets; the model is a constant of the plan."""
    model = F.lit(np.array(log_word))
    return F.aggregate(buckets, F.lit(0.0), lambda total, bucket: total + F.get(model, bucket))


def train_classifier(
    docs: DataFrame,
    labelled: DataFrame,
    domain_column: str,
    id_column: str,
    text_column: str,
    train_limit: int,
) -> tuple[list[str], list[float], list[list[float]]]:
    """Domains, their log priors and, for each, the log probability of every word bucket.

    At most ``train_limit`` labelled rows are counted; the driver gets one number for each
    domain and bucket.
    """
    chosen = (
        labelled.select(F.col(id_column).cast("bigint").alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
        .orderBy(F.xxhash64("id"), "id")
        .limit(train_limit)
    )
    rows = (
        docs.select(
            F.col(id_column).cast("bigint").alias("id"),
            F.col(domain_column).cast("string").alias("domain"),
            whole_text(text_column).alias("text"),
        )
        .where(F.col("domain").isNotNull())
        .join(F.broadcast(chosen), "id")
    )
    counted = (
        rows.select(
            "domain",
            F.explode(
                F.transform(
                    _words(F.col("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS))
                )
            ).alias("bucket"),
        )
        .groupBy("domain", "bucket")
        .agg(F.count("*").alias("n"))
    )
    priors = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if len(priors) > MAX_DOMAINS:
        raise ValueError(f"{len(priors)} domains; at most {MAX_DOMAINS} can be mixed")
    domains = sorted(priors)
    counts = {d: [0] * BUCKETS for d in domains}
    for row in counted.collect():
        counts[row.domain][row.bucket] = row.n
    everything = sum(priors.values())
    log_prior = [math.log(priors[d] / everything) for d in domains]
    log_word = [
        [math.log((n + 0.1) / (sum(counts[d]) + 0.1 * BUCKETS)) for n in counts[d]] for d in domains
    ]
    return domains, log_prior, log_word


def memberships(
    rows: DataFrame, log_prior: list[float], log_word: list[list[float]]
) -> DataFrame:
    """``doc, n_tokens, parts`` for ``rows(doc, text)``: words of each text and its posterior
    in ``PARTS``. ``doc`` is carried along. A text without words has the prior.
    """
    width = len(log_prior)
    buckets = F.transform(
        _words(F.col("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")
    )
    scored = rows.select("doc", buckets.alias("buckets")).select(
        "doc",
        F.size("buckets").cast("bigint").alias("n_tokens"),
        *(
            _log_likelihood("buckets", model).alias(f"sum_{k}")
            for k, model in enumerate(log_word)
        ),
    )
    evidence = F.least(F.lit(EVIDENCE) / F.greatest("n_tokens", F.lit(1)), F.lit(1.0))
    logits = [F.lit(log_prior[k]) + F.col(f"sum_{k}") * evidence for k in range(width)]
    top = F.greatest(*logits) if width > 1 else logits[0]
    scored = scored.select(
        "doc", "n_tokens", *(F.exp(x - top).alias(f"e_{k}") for k, x in enumerate(logits))
    )
    total = sum((F.col(f"e_{k}") for k in range(width)), F.lit(0.0))
    floors = F.array(*(F.floor(F.col(f"e_{k}") / total * PARTS).cast("int") for k in range(width)))
    rest = F.lit(PARTS) - F.aggregate("floors", F.lit(0), lambda a, b: a + b)
    best = F.array_position("floors", F.array_max("floors")) - 1
    # The most likely domain takes what rounding leaves over.
    parts = F.transform(
        "floors", lambda p, i: p + F.when(i == F.col("best"), F.col("rest")).otherwise(0)
    )
    return (
        scored.select("doc", "n_tokens", floors.alias("floors"))
        .select("doc", "n_tokens", "floors", rest.alias("rest"), best.alias("best"))
        .select("doc", "n_tokens", parts.alias("parts"))
    )


def _moved(rate: Column, history: list[list[float]], floor: float) -> Column:
    """The rate of a profile after the gradients of ``history``: one fold over constants."""
    if not history:
        return rate
    gradients = F.array(*(F.array(*(F.lit(x) for x in step)) for step in history))

    def moved(rate, gradient):
        pull = F.aggregate(
            F.zip_with("parts", gradient, lambda p, e: p * e), F.lit(0.0), lambda a, b: a + b
        ) / F.lit(float(PARTS))
        return F.greatest(F.lit(floor), rate - F.lit(STEP) * (pull + F.lit(RIDGE) * (rate - 1.0)))

    return F.aggregate(gradients, rate, moved)


def fit_rates(
    profiles: DataFrame, targets: list[float], natural: list[float], floor: float, steps: int
) -> tuple[DataFrame, list[float]]:
    """``parts, n_tokens, rate`` by projected descent, and every domain's tokens at these rates.

    Minimises the squared misses of the domains' tokens, each divided by the tokens the domain
    has, plus ``RIDGE`` times the squared distance of rates from 1, over rates of at least
    ``floor``. In that scale a step of one cannot overshoot and how far a target lies from
    what is there does not slow the descent. Every step is an aggregation over the profiles;
    the driver holds the misses only. Rates are written after each ``STRETCH`` steps.
    """
    rated = profiles.withColumn("rate", F.lit(max(1.0, floor)))
    width = len(targets)
    stretch: list[list[float]] = []
    squares: list[float] = []
    for step in range(steps + 1):
        if len(stretch) == STRETCH:
            rated = materialize(
                rated.withColumn("rate", _moved(F.col("rate"), stretch, floor)), "mix-rates"
            )
            stretch = []
        row = (
            rated.withColumn("rate", _moved(F.col("rate"), stretch, floor))
            .agg(
                *(
                    F.sum(F.col("n_tokens") * F.col("rate") * F.col("parts")[k] / PARTS).alias(f"t{k}")
                    for k in range(width)
                )
            )
            .first()
        )
        tokens = [row[k] or 0.0 for k in range(width)]
        misses = [t - wanted for t, wanted in zip(tokens, targets, strict=True)]
        met = all(abs(m) <= TOLERANCE * t for m, t in zip(misses, targets, strict=True))
        gradient = [m / n if n > 0 else 0.0 for m, n in zip(misses, natural, strict=True)]
        squares.append(sum(m * g for m, g in zip(misses, gradient, strict=True)))
        stalled = step >= STRETCH and squares[-1] >= (1 - STALLED) * squares[-1 - STRETCH]
        if met or stalled or step == steps:
            break
        stretch.append(gradient)
    return rated.withColumn("rate", _moved(F.col("rate"), stretch, floor)), tokens


def _rated(
    docs: DataFrame,
    labelled: DataFrame,
    domain_column: str,
    targets: dict[str, float] | None,
    floor: float,
    id_column: str,
    text_column: str,
    train_limit: int,
    steps: int,
    carried: list[str],
) -> tuple[list[str], list[bool], DataFrame]:
    """Domains, whether each one's share is met, and ``doc, n_tokens, parts, rate`` with the
    carried columns in ``doc``."""
    domains, log_prior, log_word = train_classifier(
        docs, labelled, domain_column, id_column, text_column, train_limit
    )
    if not domains:
        domains, log_prior, log_word = ["all"], [0.0], [[0.0] * BUCKETS]
    texts = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc"), whole_text(text_column).alias("text"))
    rows = memberships(texts, log_prior, log_word)
    slim = rows.select("n_tokens", "parts")
    profiles = materialize(
        slim.groupBy("parts").agg(F.sum("n_tokens").alias("n_tokens")), "mix-profiles"
    )
    width = len(domains)
    sums = profiles.agg(
        *(F.sum(F.col("n_tokens") * F.col("parts")[k]).alias(f"t{k}") for k in range(width))
    ).first()
    natural = [(x or 0) / PARTS for x in sums]
    if targets is None:
        weights = [n**SMOOTHING for n in natural]
    else:
        weights = [float(targets.get(d, 0.0)) for d in domains]
    scale = sum(weights) or 1.0
    weights = [w / scale for w in weights]
    total = max((n / w for n, w in zip(natural, weights, strict=True) if w > 0), default=0.0)
    fitted, tokens = fit_rates(profiles, [w * total for w in weights], natural, floor, steps)
    rated = fitted.select("parts", "rate")
    reached = sum(tokens) or 1.0
    met = [abs(t / reached - w) <= MET or not total for t, w in zip(tokens, weights, strict=True)]
    for name, good, t, w in zip(domains, met, tokens, weights, strict=True):
        if not good:
            log.warning("domain %s gets %.4f of the tokens instead of %.4f", name, t / reached, w)
    # Profiles are bounded by PARTS and the number of domains, not by the rows.
    return domains, met, rows.join(rated, "parts")


def _copies(identifier: str) -> Column:
    chance = F.pmod(F.xxhash64(identifier, F.lit("mix")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    whole = F.floor("rate")
    return whole + (chance < F.col("rate") - whole).cast("bigint")


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    domain_column: str = "lang",
    targets: dict[str, float] | None = None,
    floor: float = 0.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    train_limit: int = TRAIN_LIMIT,
    steps: int = STEPS,
) -> DataFrame:
    """One row per input row: ``id, n_tokens, domain, posterior, rate, copies, met``.

    ``rate`` is how often the document is wanted on average, at least ``floor``; ``copies``
    is that number, rounded up or down by a hash of the identifier. ``targets`` are weights
    of the domains' expected tokens (words between blanks); by default the natural shares to
    the power ``SMOOTHING``. The total is the least at which no domain falls below what it
    has, so rates are 1 or more where the targets can be met that way. ``met`` says whether
    the share of the row's domain comes within ``MET`` of its target; targets that no rates
    can reach, as of a domain without documents, are logged too. The domain column is read on labelled rows only; rows
    without label or domain teach nothing. A null text is empty, has the prior and no tokens.
    Without labelled rows there is one domain, ``all``, and every rate is 1. An empty table
    gives no rows; repeated rows stay repeated. Other columns are not read.
    """
    domains, met, rated = _rated(
        docs, labelled, domain_column, targets, floor, id_column, text_column, train_limit, steps,
        [id_column],
    )
    names = F.array(*(F.lit(d) for d in domains))
    best = F.array_position("parts", F.array_max("parts")).cast("int") - 1
    return rated.select(
        F.col(f"doc.`{id_column}`").cast("bigint").alias(id_column),
        "n_tokens",
        F.get(names, best).alias("domain"),
        F.transform("parts", lambda p: p / float(PARTS)).alias("posterior"),
        "rate",
        _copies(f"doc.`{id_column}`").alias("copies"),
        F.get(F.array(*(F.lit(m) for m in met)), best).alias("met"),
    )


def mixed_documents(
    docs: DataFrame,
    labelled: DataFrame,
    domain_column: str = "lang",
    targets: dict[str, float] | None = None,
    floor: float = 1.0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` says, with all their columns. With the
    default ``floor`` no document is lost. Rows are not moved."""
    *_, rated = _rated(
        docs, labelled, domain_column, targets, floor, id_column, text_column, TRAIN_LIMIT, STEPS,
        docs.columns,
    )
    times = F.sequence(F.lit(1).cast("bigint"), F.col("copies"))
    return (
        rated.select("doc", _copies(f"doc.`{id_column}`").alias("copies"))
        .where("copies > 0")
        .select("doc", F.explode(times).alias("time"))
        .select("doc.*")
    )
