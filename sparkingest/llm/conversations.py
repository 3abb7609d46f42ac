"""Conversation structure repair: cheapest edits to well-formed turns, least audit by path ranking.

Rows of a conversation are told blank, duplicate or truncated, and then kept, given another
role or deleted, with empty turns inserted, so that roles read ``(s?(ua)+)?`` at the least
cost. Costs are found from the last row backwards over the nodes (row, state). Among the
cheapest edits the audit, one letter an edit, shall be least: the nodes on optimal arcs are
ranked by the audits of length 1, 2, 4 and so on that begin there, each rank from two of the
length before, and the least path is read off through the doubled pointers.

Faults are found with DataFrame operations, whatever the size of a conversation; repeated
rows are counted before they move. A conversation's row codes, two bytes a row, meet in one
task, as its audit does, which is one value. Its texts do not: they stay in rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.llm.words import text_key
from sparkingest.session import materialize

# Costs of the edits, and of leaving a truncated row.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
KEEP_EDIT, RELABEL_EDIT, DELETE_EDIT, INSERT_EDIT = b"KRDI"

# States: what was written last. Ends are allowed after nothing and after an assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# State after a user's turn; and after an assistant's, for each state; -1: not allowed.
AFTER_USER = np.array([USER, USER, -1, USER])
AFTER_ASSISTANT = np.array([-1, -1, ASSISTANT, -1])
AFTER_SYSTEM = np.array([SYSTEM, -1, -1, -1])
AFTER_OTHER = np.full(STATES, -1)
# One row for each initial of a role.
KEPT = np.stack([AFTER_OTHER, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT])
INITIALS = "sua"
# A user's or an assistant's turn, wherever one of them is allowed.
TURNED = np.maximum(AFTER_USER, AFTER_ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}

SOUND, CUT, LOST = range(3)
FAR = np.int64(1) << 40

# Rows whose conversations are repaired together.
BLOCK_ROWS = 20_000


def least_paths(
    nodes: int, source: np.ndarray, target: np.ndarray, label: np.ndarray, starts: np.ndarray
) -> list[bytes]:
    """The least word that the arcs spell from each start to where no arc leaves.

    Every path must end. Ranks of all nodes by their least words of length 1, 2, 4, ...: the
    word of twice the length is the node's word and then the least word of the nodes where it
    can end. A word that ends earlier is less. ``middle`` keeps one such node for each length.
    """
    # Where nothing leaves, a silent loop goes on.
    last = np.setdiff1d(np.arange(nodes), source)
    source, target = np.concatenate((source, last)), np.concatenate((target, last))
    label = np.concatenate((label, np.zeros(len(last), dtype=label.dtype)))
    first = np.full(nodes, 255, dtype=np.int64)
    np.minimum.at(first, source, label)
    least = label == first[source]
    source, target = source[least], target[least]
    rank, middles = first, []
    while True:
        # Ends of each node's least word: those whose own least word is least.
        order = np.lexsort((target, rank[target], source))
        source, target = source[order], target[order]
        begins = np.searchsorted(source, np.arange(nodes))
        middle = target[begins]
        middles.append(middle)
        if np.all(first[middle[starts]] == 0):
            break
        least = rank[target] == rank[middle][source]
        source, target = source[least], target[least]
        # All ends of the second word, for each end of the first.
        degree = np.diff(np.append(np.searchsorted(source, np.arange(nodes)), len(source)))
        offset = np.cumsum(degree) - degree
        repeats = degree[target]
        inner = np.arange(repeats.sum()) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        following = target[np.repeat(offset[target], repeats) + inner]
        source, target = np.divmod(np.unique(np.repeat(source, repeats) * nodes + following), nodes)
        _, rank = np.unique(rank * (rank.max() + 1) + rank[middle], return_inverse=True)
    # Doubled pointers: a word of 2**k letters is the words of its node and its middle node.
    path = np.asarray(starts)[:, None]
    for middle in reversed(middles):
        path = np.stack([path, middle[path]], axis=2).reshape(len(path), -1)
    letters = first[path].astype(np.uint8)
    return [row.tobytes().rstrip(b"\0") for row in letters]


def costs_to_go(initial: np.ndarray, fault: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Least cost from each node (row, state) to the end of its conversation.

    Rows of all conversations one after another, and one node row behind the last row of
    each; all conversations step back together.
    """
    ends = np.cumsum(lengths + 1) - 1
    cost = np.full((int((lengths + 1).sum()), STATES), FAR)
    cost[ends[:, None], [NOTHING, ASSISTANT]] = 0
    cost[ends] = with_inserts(cost[ends])
    order = np.argsort(-lengths, kind="stable")
    ends, lengths = ends[order], lengths[order]
    for back in range(1, int(lengths.max(initial=0)) + 1):
        # Conversations that have this many rows; longer ones come first.
        at = ends[: np.searchsorted(-lengths, -back, side="right")] - back
        here = cost[at + 1] + DELETE
        free = fault[at] != LOST
        extra = np.where(fault[at] == CUT, TRUNCATED, 0)
        for goal, price in ((KEPT[initial[at]], 0), (np.broadcast_to(TURNED, here.shape), RELABEL)):
            reached = np.take_along_axis(cost[at + 1], np.maximum(goal, 0), axis=1)
            reached = reached + price + extra[:, None]
            allowed = (goal >= 0) & free[:, None]
            here = np.where(allowed, np.minimum(here, reached), here)
        cost[at] = with_inserts(here)
    return cost


def with_inserts(cost: np.ndarray) -> np.ndarray:
    """Costs where turns may be inserted first; more than three never pay."""
    for _ in range(STATES - 1):
        cost = np.minimum(cost, cost[:, TURNED] + INSERT)
    return cost


def optimal_arcs(
    cost: np.ndarray, initial: np.ndarray, fault: np.ndarray, is_end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arcs (source, target, letter) between nodes ``row * STATES + state`` on a cheapest path."""
    sources, targets, letters = [], [], []

    def take(row: np.ndarray, goal: np.ndarray, step: int, price: np.ndarray, letter: int) -> None:
        ahead = np.take_along_axis(cost[row + step], np.maximum(goal, 0), axis=1)
        here = cost[row]
        which, state = np.nonzero((goal >= 0) & (here < FAR) & (ahead + price == here))
        sources.append(row[which] * STATES + state)
        targets.append((row[which] + step) * STATES + goal[which, state])
        letters.append(np.full(len(which), letter, dtype=np.int64))

    every, rows = np.arange(len(cost)), np.flatnonzero(~is_end)
    same = np.broadcast_to(np.arange(STATES), (len(rows), STATES))
    free = rows[fault[rows] != LOST]
    extra = np.where(fault[free] == CUT, TRUNCATED, 0)[:, None]
    take(every, np.broadcast_to(TURNED, cost.shape), 0, np.int64(INSERT), INSERT_EDIT)
    take(rows, same, 1, np.int64(DELETE), DELETE_EDIT)
    take(free, KEPT[initial[free]], 1, extra, KEEP_EDIT)
    take(free, np.broadcast_to(TURNED, (len(free), STATES)), 1, extra + RELABEL, RELABEL_EDIT)
    return np.concatenate(sources), np.concatenate(targets), np.concatenate(letters)


def cheapest_edits(codes: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
    """Cost and least audit of each conversation; a row's code is 3 * initial + fault."""
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    padded = np.concatenate([np.append(c, 0) for c in codes]).astype(np.int64)
    initial, fault = padded // 3, padded % 3
    starts = np.cumsum(lengths + 1) - lengths - 1
    is_end = np.zeros(len(padded), dtype=bool)
    is_end[starts + lengths] = True
    cost = costs_to_go(initial, fault, lengths)
    source, target, letter = optimal_arcs(cost, initial, fault, is_end)
    audits = least_paths(len(padded) * STATES, source, target, letter, starts * STATES)
    return cost[starts, NOTHING], audits


def turns_of(audit: bytes, codes: np.ndarray) -> Iterator[tuple[int | None, str | None]]:
    """Row and new role of each turn that stays: no row for an inserted one, no role for a
    kept one."""
    state, row = NOTHING, 0
    for letter in audit:
        if letter == INSERT_EDIT:
            state = TURNED[state]
            yield None, ROLES[int(state)]
            continue
        if letter == RELABEL_EDIT:
            state = TURNED[state]
            yield row, ROLES[int(state)]
        elif letter == KEEP_EDIT:
            state = KEPT[codes[row] // 3, state]
            yield row, None
        row += 1


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows as a test of the repair, with known faults.

    The checksum of conversation and turn decides: a row is left out (``copies`` 0, so that
    its conversation stays known), emptied, cut of its stops, repeated, or given to the user.
    Nulls count as one blank there; text and role that are null become one.
    """
    filled = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn"))) % 20
    return conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fate == 4, "user").otherwise(filled("role")).alias("role"),
        F.when(fate == 1, "")
        .when(fate == 2, F.regexp_replace(filled("text"), "[.!?]", ""))
        .otherwise(filled("text"))
        .alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with ``copies``, ``fault`` of the first of them and their role's
    ``initial``; all later ones are duplicates.

    Rows of one text, role and conversation meet as counts and least turns only.
    """
    grouped = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    grouped = grouped.where("copies > 0").withColumn("key", text_key("text"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    seen = grouped.groupBy("conv_id", "role", "key").agg(F.min(place).alias("first"))
    same = (
        F.col("g.conv_id").eqNullSafe(F.col("s.conv_id"))
        & (F.col("g.role") == F.col("s.role"))
        & (F.col("g.key") == F.col("s.key"))
    )
    met = grouped.alias("g").join(seen.alias("s"), same)
    blank = ~F.col("g.text").rlike(r"[^\x20\x09-\x0D]")
    again = ~F.col("g.turn").eqNullSafe(F.col("s.first.at"))
    stopped = F.col("g.text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, "blank").when(again, "duplicate").when(~stopped, "truncated")
    initial = F.when(F.col("g.role") == "", 0).otherwise(
        F.instr(F.lit(INITIALS), F.substring("g.role", 1, 1))
    )
    return met.select("g.*", fault.alias("fault"), initial.alias("initial"))


def _codes() -> Column:
    """The code of the first of equal rows, and of the others."""
    first = F.when(F.col("fault").isin("blank", "duplicate"), LOST).when(F.col("fault") == "truncated", CUT)
    return F.col("initial") * 3 + F.coalesce(first, F.lit(SOUND))


def _key() -> Column:
    """The conversation as a key without nulls, by which partitions are sorted and cut."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _repaired_blocks(batches) -> Iterator[tuple[list, list[np.ndarray], list[np.ndarray]]]:
    """Conversations of a sorted partition: identifiers, codes and each row's number of copies."""
    names, codes, copies, rows = [], [], [], 0
    for batch in batches:
        conversation = batch.column("conversation").to_pylist()
        code = batch.column("code").to_numpy().astype(np.int16)
        copy = batch.column("copies").to_numpy()
        changes = [i for i in range(1, len(conversation)) if conversation[i] != conversation[i - 1]]
        for begin, end in zip([0, *changes], [*changes, len(conversation)], strict=True):
            if begin == end:
                continue
            if not names or names[-1] != conversation[begin]:
                if rows >= BLOCK_ROWS:
                    yield names, [np.concatenate(c) for c in codes], [np.concatenate(c) for c in copies]
                    names, codes, copies, rows = [], [], [], 0
                names.append(conversation[begin])
                codes.append([])
                copies.append([])
            codes[-1].append(code[begin:end])
            copies[-1].append(copy[begin:end])
            rows += int(copy[begin:end].sum())
    if names:
        yield names, [np.concatenate(c) for c in codes], [np.concatenate(c) for c in copies]


TURN_STRUCT = pa.struct([("position", pa.int64()), ("row", pa.int64()), ("role", pa.string())])


def _solve(batches) -> Iterator[pa.RecordBatch]:
    for names, codes, copies in _repaired_blocks(batches):
        # Further copies of a row are duplicates of its role.
        spread = []
        for code, copy in zip(codes, copies, strict=True):
            full = np.repeat(code // 3 * 3 + LOST, copy)
            full[np.cumsum(copy) - copy] = code
            spread.append(full)
        cost, audits = cheapest_edits(spread)
        illegal, turns = [], []
        for code, copy, audit in zip(spread, copies, audits, strict=True):
            initial = code // 3
            before, after = initial[:-1], initial[1:]
            legal = ((before == 1) | (before == 3)) & (after == 2) | (before == 2) & (after == 3)
            illegal.append(int((~legal).sum()))
            # From a row among all copies to the row that stands for them.
            stands = np.repeat(np.arange(len(copy)), copy)
            turns.append(
                [
                    {"position": i, "row": None if row is None else int(stands[row]), "role": role}
                    for i, (row, role) in enumerate(turns_of(audit, code))
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array(cost, pa.int64()),
                pa.array(illegal, pa.int64()),
                pa.array([a.decode() for a in audits], pa.string()),
                pa.array(turns, pa.list_(TURN_STRUCT)),
            ],
            names=["conversation", "cost", "illegal", "audit", "turns"],
        )


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired turns ``conv_id, position, role, text`` and a summary of each conversation.

    ``rows``: ``conv_id, turn, role, text, copies``, without nulls in role, text and copies.
    They are read by turn (a null turn first), rows of one turn by role, then text; equal
    rows follow each other. Only the first of equal rows of a conversation counts, and a
    role is what its first letter says; any other role, an empty one too, must be changed
    or go. The summary has
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``: zeros and an empty
    audit for a conversation whose rows all have no copies. Rows without a conversation form
    one. A table without rows gives two empty ones; extra columns are not read.
    """
    order = Window.partitionBy("conversation").orderBy("turn", "role", "text")
    found = (
        faults(rows)
        .withColumn("conversation", _key())
        .withColumn("code", _codes().cast("int"))
        .withColumn("row", F.row_number().over(order).cast("bigint") - 1)
    )
    found = materialize(found.drop("conv_id", "key", "initial"), "conversation-rows")
    ordered = (
        found.select("conversation", "row", "code", "copies")
        .repartition("conversation")
        .sortWithinPartitions("conversation", "row")
    )
    solved = materialize(
        ordered.mapInArrow(
            _solve,
            "conversation string, cost bigint, illegal bigint, audit string, "
            "turns array<struct<position:bigint,row:bigint,role:string>>",
        ),
        "conversation-edits",
    )
    count = lambda kind: F.sum(F.when(F.col("fault") == kind, 1).otherwise(0))
    more = F.sum(F.when(~F.col("fault").eqNullSafe("blank"), F.col("copies") - 1).otherwise(0))
    blanks = F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0))
    again = more + count("duplicate")
    by_turn = found.groupBy("conversation", "turn").agg(
        blanks.alias("blank"), again.alias("duplicate"), count("truncated").alias("truncated")
    )
    counts = by_turn.groupBy("conversation").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"),
        *(F.sum(kind).alias(kind) for kind in ("blank", "duplicate", "truncated")),
    )
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = rows.select("conv_id").distinct().withColumn("conversation", _key())
    summary = (
        every.join(counts, "conversation", "left")
        .join(solved.drop("turns"), "conversation", "left")
        .select(
            "conv_id",
            *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
        )
    )
    turns = solved.select("conversation", F.explode("turns").alias("t")).select(
        "conversation", "t.position", F.col("t.row").alias("row"), F.col("t.role").alias("new_role")
    )
    repaired = (
        turns.join(found.select("conversation", "row", "role", "text"), ["conversation", "row"], "left")
        .join(every, "conversation")
        .select(
            "conv_id",
            "position",
            F.coalesce("new_role", "role").alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
    )
    return repaired, summary


def _hashes(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, read in order, a batch at a time."""
    current, digest = None, None
    for batch in batches:
        names, digests = [], []
        for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name == current:
                digest.update(b"\n" + line)
                continue
            if digest is not None:
                names.append(current)
                digests.append(digest.hexdigest())
            current, digest = name, hashlib.sha256(line)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(digests, pa.string())], names=["conversation", "sha"]
        )
    if digest is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([current], pa.string()), pa.array([digest.hexdigest()], pa.string())],
            names=["conversation", "sha"],
        )


def repair_digests(rows: DataFrame) -> DataFrame:
    """The summary and ``repaired_sha256``, the digest of each conversation's repaired lines."""
    repaired, summary = repair(rows)
    lines = repaired.select(
        _key().alias("conversation"), "position", F.concat_ws(":", "role", "text").cast("binary").alias("line")
    )
    hashed = (
        lines.repartition("conversation")
        .sortWithinPartitions("conversation", "position")
        .select("conversation", "line")
        .mapInArrow(_hashes, "conversation string, sha string")
    )
    return (
        summary.withColumn("conversation", _key())
        .join(hashed, "conversation", "left")
        .drop("conversation")
        .withColumn("repaired_sha256", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())))
        .drop("sha")
    )
