"""Secret scan by grammar inference.

Fixed patterns label credentials in the corpus. Their prefix trees are folded into
probabilistic automata by merging states whose statistics agree; every candidate is scored
by how much likelier its format is under an automaton than under ordinary tokens.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.llm.words import text_blocks, whole_text

# Fixed: kinds in the order of listing, their patterns and the least length of a hit.
KINDS = ("assign", "access", "hex", "grammar")
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
# A text without any of these holds no assignment.
ASSIGN_WORDS = ("token", "passw", "secret", "apikey", "api_key")

# Every maximal run of credential characters of at least this length is a candidate.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]+")
CANDIDATE_LEAST = 16

# Bounds of the fit, in distinct strings of each kind; the scan itself has none.
LABELLED_LIMIT = 400
ORDINARY_LIMIT = 4_000
SAMPLE_SLOTS = 1 << 14
MERGE_ALPHA = 0.05
# Probability of a step that the automaton has never seen.
UNSEEN = 1e-4

def symbols(text: str) -> str:
    """Characters as classes: a-f ``h``, g-z ``l``, A-F ``H``, G-Z ``U``, digits ``d``."""
    return text.translate(_CLASSES)


_CLASSES = {
    ord(c): name
    for name, members in (
        ("h", "abcdef"),
        ("l", "ghijklmnopqrstuvwxyz"),
        ("H", "ABCDEF"),
        ("U", "GHIJKLMNOPQRSTUVWXYZ"),
        ("d", "0123456789"),
    )
    for c in members
}


def long_words(text: str) -> list[tuple[int, str]]:
    """Words between blanks that are long enough for a candidate, with their places.

    All patterns but the assignment match within such a word.
    """
    out, at = [], 0
    for word in text.split():
        if len(word) >= CANDIDATE_LEAST:
            at = text.index(word, at)
            out.append((at, word))
            at += len(word)
    return out


def base_spans(text: str, words: list[tuple[int, str]]) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, credential)`` of the fixed patterns, in code points.

    A pattern is matched from left to right without overlap; matches that are too short are
    dropped afterwards, so they still use up their characters. ``words`` are the text's
    ``long_words``.
    """
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                found.append((m.start(), 0, m.end(), m[2]))
    for at, word in words:
        if "AKIA" in word:
            for m in ACCESS.finditer(word):
                if len(m[0]) >= ACCESS_LEAST:
                    found.append((at + m.start(), 1, at + m.end(), m[0]))
        if len(word) >= HEX_LEAST:
            for m in HEX.finditer(word):
                if len(m[0]) >= HEX_LEAST:
                    found.append((at + m.start(), 2, at + m.end(), m[0]))
    return sorted(found)


# ---------------------------------------------------------------------- automata


@dataclass
class Automaton:
    """States by number; ``steps[s]`` maps a symbol to (next state, log probability)."""

    steps: list[dict[str, tuple[int, float]]]
    stops: list[float]

    def score(self, text: str) -> float:
        """Log probability of the class string; impossible steps cost ``UNSEEN`` each."""
        state, total = 0, 0.0
        for symbol in text:
            step = self.steps[state].get(symbol)
            if step is None:
                total += _LOG_UNSEEN
                continue
            state = step[0]
            total += step[1]
        return total + self.stops[state]


_LOG_UNSEEN = math.log(UNSEEN)


def _differ(f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
    """Hoeffding's test: are two observed frequencies too far apart to be one?"""
    return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


def infer_automaton(strings: list[str], alpha: float = MERGE_ALPHA) -> Automaton:
    """Fold the prefix tree of ``strings`` by merging compatible states.

    Red states are final; each blue state, a child of a red one, is merged into the first
    red state that agrees with it, subtrees included, or else becomes red.
    """
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    arrive, end, child = [0], [0], [{}]
    for string in strings:
        state = 0
        arrive[0] += 1
        for symbol in string:
            following = child[state].get(symbol)
            if following is None:
                following = len(arrive)
                child[state][symbol] = following
                arrive.append(0)
                end.append(0)
                child.append({})
            state = following
            arrive[state] += 1
        end[state] += 1

    def compatible(a: int, b: int) -> bool:
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            if _differ(end[a], arrive[a], end[b], arrive[b], bound):
                return False
            for symbol in child[a].keys() | child[b].keys():
                x, y = child[a].get(symbol), child[b].get(symbol)
                n_x = arrive[x] if x is not None and x not in red_set else seen[a].get(symbol, 0)
                n_y = arrive[y] if y is not None else 0
                if _differ(n_x, arrive[a], n_y, arrive[b], bound):
                    return False
                if x is not None and y is not None:
                    pending.append((x, y))
        return True

    # How often a symbol left a state; after merges a child's arrivals hold more than that.
    seen = [{s: arrive[c] for s, c in children.items()} for children in child]

    def fold(a: int, b: int) -> None:
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            arrive[a] += arrive[b]
            end[a] += end[b]
            for symbol, y in child[b].items():
                seen[a][symbol] = seen[a].get(symbol, 0) + seen[b][symbol]
                x = child[a].get(symbol)
                if x is None:
                    child[a][symbol] = y
                else:
                    pending.append((x, y))

    red, red_set = [0], {0}
    while True:
        blue = next(
            ((r, s, child[r][s]) for r in red for s in sorted(child[r]) if child[r][s] not in red_set),
            None,
        )
        if blue is None:
            break
        parent, symbol, state = blue
        target = next((r for r in red if compatible(r, state)), None)
        if target is None:
            red.append(state)
            red_set.add(state)
        else:
            child[parent][symbol] = target
            fold(target, state)
    number = {state: i for i, state in enumerate(red)}
    steps, stops = [], []
    for state in red:
        total = sum(seen[state].values()) + end[state]
        steps.append(
            {
                s: (number[c], math.log(seen[state][s] / total))
                for s, c in child[state].items()
            }
        )
        stops.append(math.log(end[state] / total) if end[state] else _LOG_UNSEEN)
    return Automaton(steps, stops)


def ordinary_model(strings: list[str]) -> dict[tuple[str, str], float]:
    """Smoothed log probabilities of a class after a class, from ordinary tokens."""
    counts: dict[tuple[str, str], int] = {}
    totals: dict[str, int] = {}
    alphabet = {"h", "l", "H", "U", "d", "$", *(s for x in strings for s in x)}
    for string in strings:
        for pair in zip("^" + string, string + "$", strict=True):
            counts[pair] = counts.get(pair, 0) + 1
            totals[pair[0]] = totals.get(pair[0], 0) + 1
    size = len(alphabet)
    return {
        (a, b): math.log((counts.get((a, b), 0) + 1) / (totals.get(a, 0) + size))
        for a in {"^", *alphabet}
        for b in alphabet
    }


@dataclass
class Grammar:
    automata: list[Automaton]
    ordinary: dict[tuple[str, str], float]
    threshold: float = 0.0

    def score(self, text: str) -> float:
        """Log likelihood ratio of the best automaton against ordinary tokens, a character."""
        classes = symbols(text)
        plain = sum(
            self.ordinary.get(pair, _LOG_UNSEEN)
            for pair in zip("^" + classes, classes + "$", strict=True)
        )
        best = max((a.score(classes) for a in self.automata), default=-math.inf)
        return (best - plain) / (len(classes) + 1)


def fit_grammar(labelled: dict[str, list[str]], ordinary: list[str]) -> Grammar:
    """One automaton for each kind of labelled credential.

    A candidate must be likelier as a credential than as an ordinary token and score more
    than the least twentieth of the labelled credentials. No share of the ordinary tokens is
    set apart, as there may be any number of credentials among them that no pattern names.
    """
    grammar = Grammar(
        [infer_automaton([symbols(x) for x in labelled[k]]) for k in sorted(labelled) if labelled[k]],
        ordinary_model([symbols(x) for x in ordinary]),
    )
    if grammar.automata:
        known = sorted(grammar.score(x) for k in labelled for x in labelled[k])
        grammar.threshold = max(0.0, known[len(known) // 20])
    return grammar


# -------------------------------------------------------------------------- spark


def candidates(
    words: list[tuple[int, str]], covered: list[tuple[int, int]]
) -> Iterator[tuple[int, int, str]]:
    """Runs of credential characters that no base span overlaps."""
    at = 0
    for place, word in words:
        for match in CANDIDATE.finditer(word):
            if len(match[0]) < CANDIDATE_LEAST:
                continue
            start, end = place + match.start(), place + match.end()
            while at < len(covered) and covered[at][1] <= start:
                at += 1
            if at == len(covered) or covered[at][0] >= end:
                yield start, end, match[0]


def _merged(base: list[tuple[int, int, int, str]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, _, end, _ in base:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled credentials and ordinary candidates of each text, distinct within a slice."""
    for _, texts in text_blocks(batches, "text"):
        found: set[tuple[str, str]] = set()
        for text in texts:
            words = long_words(text)
            base = base_spans(text, words)
            found.update((KINDS[kind], secret) for _, kind, _, secret in base)
            found.update(("ordinary", x) for _, _, x in candidates(words, _merged(base)))
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["kind", "value"]
        )


def learn(
    docs: DataFrame,
    text_column: str = "text",
    labelled_limit: int = LABELLED_LIMIT,
    ordinary_limit: int = ORDINARY_LIMIT,
) -> Grammar:
    """Infer the automata from at most ``labelled_limit`` distinct credentials of each kind
    and ``ordinary_limit`` ordinary tokens, chosen by hash from the whole corpus."""
    found = (
        docs.select(whole_text(text_column).alias("text"))
        .mapInArrow(_label, "kind string, value string")
        .select("kind", "value", F.xxhash64("value").alias("hash"))
    )
    # One value for each slot of the hash, kept in every task before anything moves; the
    # window then orders at most SAMPLE_SLOTS rows of a kind.
    slots = found.groupBy("kind", F.pmod("hash", F.lit(SAMPLE_SLOTS)).alias("slot")).agg(
        F.min(F.struct("hash", "value")).alias("least")
    )
    limit = F.when(F.col("kind") == "ordinary", ordinary_limit).otherwise(labelled_limit)
    by_hash = Window.partitionBy("kind").orderBy("least")
    sample: dict[str, list[str]] = {}
    for row in (
        slots.select("kind", "least.value", F.row_number().over(by_hash).alias("rank"))
        .where(F.col("rank") <= limit)
        .orderBy("kind", "rank")
        .collect()
    ):
        sample.setdefault(row.kind, []).append(row.value)
    ordinary = sample.pop("ordinary", [])
    return fit_grammar(sample, ordinary)


def spans_of(text: str, grammar: Grammar) -> tuple[list, list]:
    """Base spans, and all spans with those that the grammar adds, as ``(start, kind, end)``."""
    words = long_words(text)
    base = base_spans(text, words)
    added = []
    if grammar.automata:
        for start, end, value in candidates(words, _merged(base)):
            if grammar.score(value) > grammar.threshold:
                added.append((start, 3, end))
    plain = [x[:3] for x in base]
    return plain, sorted(plain + added)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scanner(grammar: Grammar):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text"):
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for text in texts:
                base, every = spans_of(text, grammar)
                for kind in range(3):
                    counts[kind].append(sum(1 for x in base if x[1] == kind))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return scan


def scan_secrets(
    docs: DataFrame,
    grammar: Grammar | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``id, n_assign, n_access, n_hex, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` by start and kind in code points, end exclusive; the
    grammar adds candidates that no base span overlaps. Without a grammar one is learnt from
    the same rows. A null text is empty; an empty text has no spans and the digest of the
    empty list. Where nothing is labelled, nothing is added. Repeated rows stay repeated; an
    empty table gives no rows. Other columns are not read. Rows are not shuffled.
    """
    if grammar is None:
        grammar = learn(docs, text_column)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"), whole_text(text_column).alias("text")
    )
    scanned = rows.mapInArrow(
        _scanner(grammar),
        "id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )
    return scanned.withColumnRenamed("id", id_column)
