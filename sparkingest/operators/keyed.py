"""Tables with one live row per key: merge-on-read, versions, tombstones, file statistics.

Layout of a table::

    log/        numbered commit records (see ``commits``)
    data/C/     data files of commit C, each with rows of one partition label
    files/C/    about each of them: label, rows, bounds of its keys, and a bitmap of the
                hashed keys it holds, in words of 64 bits

A merge never rewrites stored rows. It looks the batch's keys up in those files only whose key
range and bitmaps meet the batch, writes the winning rows as new files, and each of
these rows names the file and row number it replaces. Together these names are the delete
vectors: readers leave the named rows out. Deletes are rows too, tombstones that keep
their version, so that an older change that arrives later does not bring the key back.
Compaction rewrites files with many replaced rows.

A commit is one record in the log. Of two writers the second finds its number taken, looks
at the newer state and merges again. Readers take the files of one number, so a table can be
read as of any commit; files of crashed writers are in no record and are never read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.errors import StorageWriteError
from sparkingest.operators.commits import CommitLog
from sparkingest.session import materialize, scratch_table

PART = "part"
DELETED = "_deleted"
OLD_FILE, OLD_ROW = "_old_file", "_old_row"
DEAD_FILE, DEAD_ROW = "_dead_file", "_dead_row"
IN_FILE, IN_ROW = "_in_file", "_in_row"
FILE_NUMBER = "_file_number"
# Names that a table's own columns may not have.
RESERVED = (PART, DELETED, OLD_FILE, OLD_ROW, DEAD_FILE, DEAD_ROW, IN_FILE, IN_ROW, FILE_NUMBER, "_dir")
# Hashed keys fall on this many bits; a multiple of 64.
KEY_BITS = 1 << 20
# Blocks of neighbouring keys that describe a batch, besides one for each of its files.
RANGES = 1024

_POINTERS = [T.StructField(OLD_FILE, T.StringType()), T.StructField(OLD_ROW, T.LongType())]


@dataclass(frozen=True)
class State:
    """A table as of one commit. ``files`` and ``removed`` are folders of file lists,
    ``pointers`` folders whose rows name replaced rows."""

    number: int
    schema: T.StructType | None = None
    keys: tuple[str, ...] = ()
    files: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    pointers: tuple[str, ...] = ()
    records: tuple[dict, ...] = field(default=(), repr=False)


def commit_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/log")


def state_of(spark: SparkSession, path: str, number: int | None = None) -> State:
    """The state after ``number`` commits, of the newest one without it. Reads one snapshot
    and the records behind it."""
    log = commit_log(spark, path)
    head = log.head()
    if number is not None and not 0 <= number <= head:
        raise StorageWriteError(path, f"has commits 1 to {head}, not {number}")
    number = head if number is None else number
    at, base = log.base(number)
    records = log.tail(at, number)
    if base is not None:
        records = [{**base, "number": at}, *records]
    if not records:
        return State(0)
    folders = lambda name: tuple(f"{path}/{f}" for r in records for f in r[name])
    return State(
        number=number,
        schema=T.StructType.fromJson(json.loads(records[-1]["schema"])),
        keys=tuple(records[-1]["keys"]),
        files=folders("files"),
        removed=folders("removed"),
        pointers=folders("pointers"),
        records=tuple(records),
    )


def number_at(spark: SparkSession, path: str, moment: dt.datetime) -> int:
    """The last commit made at ``moment`` or before. Walks back over the records in between."""
    log = commit_log(spark, path)
    number, moment = log.head(), moment.astimezone(dt.UTC)
    while number and dt.datetime.fromisoformat(log.read(number)["committed_at"]) > moment:
        number -= 1
    return number


# --- files -------------------------------------------------------------------------------


def _key_struct(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{k}`") for k in keys])


def _files_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    key = T.StructType([T.StructField(k, schema[k].dataType) for k in keys])
    return T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField(PART, T.StringType()),
            T.StructField("rows", T.LongType()),
            T.StructField("replacing", T.LongType()),
            T.StructField("low", key),
            T.StructField("high", key),
            T.StructField("words", T.ArrayType(T.StructType.fromDDL("word BIGINT, bits BIGINT"))),
        ]
    )


def _listed(spark: SparkSession, state: State) -> DataFrame:
    files = spark.read.schema(_files_schema(state.schema, state.keys)).parquet(*state.files)
    if not state.removed:
        return files
    return files.join(spark.read.schema("file STRING").parquet(*state.removed), "file", "left_anti")


def live_files(spark: SparkSession, state: State) -> DataFrame:
    """``file, part, rows, low, high`` of the data files that a reader needs."""
    return _listed(spark, state).select("file", PART, "rows", "low", "high")


def replaced_rows(spark: SparkSession, state: State) -> DataFrame:
    """``_dead_file, _dead_row`` of every stored row that a later one replaced. Two columns
    are read, of files whose rows replace others."""
    schema = T.StructType(_POINTERS)
    if not state.pointers:
        return spark.createDataFrame([], schema).toDF(DEAD_FILE, DEAD_ROW)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*state.pointers)
    return rows.where(F.col(OLD_FILE).isNotNull()).toDF(DEAD_FILE, DEAD_ROW)


def _dead_counts(dead: DataFrame) -> DataFrame:
    return dead.groupBy(F.col(DEAD_FILE).alias("file")).agg(F.count(F.lit(1)).alias("dead"))


def _located(spark: SparkSession, path: str, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    """Rows of the named files with the file and their number in it."""
    rows = spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for f in files])
    return rows.select(
        "*",
        _relative(F.col("_metadata.file_path")).alias(IN_FILE),
        F.col("_metadata.row_index").alias(IN_ROW),
    )


def _relative(file_path: Column) -> Column:
    """A data file's name below ``data/``: the commit's folder, the label's and its own, all of
    plain letters, digits and signs."""
    return F.substring_index(file_path, "/", -3)


def _stored(data: T.StructType) -> T.StructType:
    return T.StructType(
        [*data.fields, T.StructField(PART, T.StringType()), T.StructField(DELETED, T.BooleanType())]
    )


def _live_rows(
    spark: SparkSession, path: str, state: State, schema: T.StructType, files: DataFrame, located: bool = False
) -> DataFrame | None:
    """Rows of ``files`` that no later row replaced; None if there are no files.

    Only files that hold replaced rows are joined with the delete vectors, the others are
    plain scans. The names of the files pass through the driver, as those of every scan do.
    """
    dead = replaced_rows(spark, state)
    files = files.select("file", "rows")
    if state.pointers:
        names = files.join(_dead_counts(dead), "file", "left").collect()
    else:
        names = files.withColumn("dead", F.lit(None)).collect()
    whole = sorted(n.file for n in names if n.dead is None)
    holed = sorted(n.file for n in names if n.dead is not None and n.dead < n.rows)
    columns = [*schema.names, IN_FILE, IN_ROW] if located else schema.names
    parts = []
    if whole:
        rows = _located(spark, path, schema, whole) if located else None
        parts.append(rows or spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for f in whole]))
    if holed:
        here = (F.col(IN_FILE) == F.col(DEAD_FILE)) & (F.col(IN_ROW) == F.col(DEAD_ROW))
        parts.append(_located(spark, path, schema, holed).join(dead, here, "left_anti").select(*_quoted(columns)))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def read(
    spark: SparkSession,
    path: str,
    data: T.StructType | None = None,
    *,
    number: int | None = None,
    parts: Sequence[str] | None = None,
) -> DataFrame:
    """Live rows and their ``part``, of the newest commit or of ``number``; ``parts`` opens
    the files of these labels only. A table without commits has no rows."""
    state = state_of(spark, path, number)
    if state.schema is None:
        return spark.createDataFrame([], T.StructType([*(data.fields if data else []), _stored(T.StructType())[PART]]))
    data = state.schema if data is None else data
    files = live_files(spark, state)
    if parts is not None:
        files = files.where(F.col(PART).isin(list(parts)))
    rows = _live_rows(spark, path, state, _stored(data), files)
    if rows is None:
        return spark.createDataFrame([], T.StructType([*data.fields, _stored(data)[PART]]))
    return rows.where(~F.col(DELETED)).select(*_quoted([*data.names, PART]))


# --- merge -------------------------------------------------------------------------------


def _hashed(keys: Sequence[str]) -> Column:
    """A key's bit: its place, counted from 0."""
    return F.pmod(F.xxhash64(*_quoted(keys)), F.lit(KEY_BITS))


def _numbered(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`").alias(f"key{i}") for i, k in enumerate(keys)]


def _bounds(keys: Sequence[str]) -> list[Column]:
    """Aggregates of numbered keys that no key of the group lies beyond, column by column: those
    of fixed width then need no sort. A null is the least value."""
    out = []
    for i in range(len(keys)):
        least = F.when(F.count(F.lit(1)) == F.count(f"key{i}"), F.min(f"key{i}"))
        out += [least.alias(f"low{i}"), F.max(f"key{i}").alias(f"high{i}")]
    return out


def _end(name: str, keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{name}{i}").alias(k) for i, k in enumerate(keys)])


def _in_blocks(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys that are sorted, in at most ``RANGES`` blocks of neighbours and one more
    for each of their files."""
    width = max(1, batch.count() // RANGES)
    return batch.select(
        *_numbered(keys),
        F.col("_metadata.file_path").alias("block_file"),
        F.floor(F.col("_metadata.row_index") / width).alias("block"),
    )


def files_to_search(spark: SparkSession, state: State, batch: DataFrame) -> DataFrame:
    """Live files that may hold keys of the batch, whose keys are stored and sorted. From
    statistics alone: first by key range, then by bitmaps that have a bit in common; no
    key of the table is read.

    A file's range either holds an end of a block, or lies
    within one block, whose keys are then looked at. The ends of the blocks are bounded and
    broadcast; so is the batch's bitmap, 16 384 words.
    """
    keys = _in_blocks(batch, state.keys)
    ends = keys.groupBy("block_file", "block").agg(*_bounds(state.keys))
    # Stored, as both joins below ask for it: a row a block.
    blocks = materialize(
        ends.select("block_file", "block", _end("low", state.keys).alias("first"), _end("high", state.keys).alias("last")),
        "merge-blocks",
    )
    within = lambda key: (F.col("low") <= F.col(key)) & (F.col(key) <= F.col("high"))
    inside = (F.col("first") < F.col("low")) & (F.col("high") < F.col("last"))
    met = live_files(spark, state).join(F.broadcast(blocks), within("first") | within("last") | inside)
    names = ["file", PART, "rows", "low", "high"]
    sure = met.where(~inside).select(*names).distinct()
    asked = met.where(inside).select(*names, "block_file", "block")
    found = asked.join(
        keys.select(
            F.col("block_file").alias("f"), F.col("block").alias("b"), _end("key", state.keys).alias("batch_key")
        ),
        (F.col("block_file") == F.col("f")) & (F.col("block") == F.col("b")) & within("batch_key"),
        "left_semi",
    )
    near = sure.unionByName(found.select(*names))
    mine = _words(batch.select(_hashed(state.keys).alias("h"))).withColumnRenamed("bits", "mine")
    held = _listed(spark, state).select("file", F.explode("words").alias("w")).select("file", "w.*")
    common = held.join(F.broadcast(mine), "word").where(F.col("bits").bitwiseAND(F.col("mine")) != 0)
    return near.join(common.select("file").distinct(), "file", "left_semi")


def _words(hashed: DataFrame, *by: str) -> DataFrame:
    """``word, bits`` of the bitmaps of hashed keys ``h``, by further columns. Sums of fixed
    width, which Spark keeps in hash tables: no row is sorted."""
    bit = F.expr("shiftleft(1L, CAST(h % 64 AS INT))")
    return hashed.groupBy(*by, F.shiftright("h", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def winners(batch: DataFrame, stored: DataFrame, keys: Sequence[str], versions: Sequence[str]) -> DataFrame:
    """Rows of the batch that are newer than the stored row of their key, and where that one
    is. Keys are plain columns of the join, nulls are equal."""
    old = stored.select(
        *[F.col(f"`{k}`").alias(f"_old_key{i}") for i, k in enumerate(keys)],
        F.struct(*_quoted(versions)).alias("_old_version"),
        F.col(IN_FILE).alias(OLD_FILE),
        F.col(IN_ROW).alias(OLD_ROW),
    )
    same = None
    for i, k in enumerate(keys):
        equal = F.col(f"`{k}`").eqNullSafe(F.col(f"_old_key{i}"))
        same = equal if same is None else same & equal
    met = batch.join(old, same, "left")
    # A null version counts as the oldest, as in the deduplication.
    newer = F.col(OLD_FILE).isNull() | (F.struct(*_quoted(versions)) > F.col("_old_version"))
    return met.where(newer).select(*_quoted(batch.columns), OLD_FILE, OLD_ROW)


def widened(known: T.StructType | None, incoming: T.StructType) -> T.StructType:
    """Stored columns, then new ones; a column that changes its type is refused."""
    if known is None:
        return T.StructType([T.StructField(f.name, f.dataType) for f in incoming.fields])
    fields = list(known.fields)
    for f in incoming.fields:
        if f.name not in known.names:
            fields.append(f)
        elif known[f.name].dataType != f.dataType:
            raise StorageWriteError(
                f.name,
                f"is {known[f.name].dataType.simpleString()} in the table and "
                f"{f.dataType.simpleString()} in the batch",
            )
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def latest_per_key(df: DataFrame, keys: Sequence[str], versions: Sequence[str]) -> DataFrame:
    """The row of every key that is greatest by the ``versions`` columns, nulls least.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle, so
    each task sends one row per key however often the key repeats.
    """
    newest = [c.desc_nulls_last() for c in _quoted(versions)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*_quoted(keys)).orderBy(*newest)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def merge(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    versions: Sequence[str],
    part: Column | str,
    *,
    deleted: Column | None = None,
    transient: Sequence[str] = (),
    batch_id: str | None = None,
) -> int:
    """Upsert ``incoming`` on ``keys``; the greatest row by ``versions`` wins, old or new.

    ``part`` computes the partition label of a row (null and '' become ``none``), ``deleted``
    says which rows delete their key: they win and lose by version like others. ``transient``
    columns serve these two and are not stored. On a tie
    the stored row stays, so a batch applied twice changes nothing; a batch with a
    ``batch_id`` that the table has seen since its last snapshot is not even looked at.
    A batch without some of the table's columns leaves them null in its own rows only, new
    columns are null in older rows, and a changed type is refused. Returns the number of the
    commit that holds the batch.
    """
    clash = sorted(set(incoming.columns) & set(RESERVED))
    if clash:
        raise StorageWriteError(path, f"columns may not be called {', '.join(clash)}")
    part = F.col(f"`{part}`") if isinstance(part, str) else part
    label = F.coalesce(F.nullif(part.cast("string"), F.lit("")), F.lit("none"))
    flag = F.lit(False) if deleted is None else F.coalesce(deleted.cast("boolean"), F.lit(False))
    # A label is a function of the row that stays, so it is not dealt out with all of them.
    newest = latest_per_key(incoming.withColumn(DELETED, flag), keys, versions)
    fresh = newest.withColumn(PART, label).drop(*transient)
    incoming = incoming.drop(*transient).schema
    log = commit_log(spark, path)
    # Stored first: dealing by range looks at its rows twice, and would sort them twice.
    with scratch_table(fresh, "merge-batch") as batch:
        if log.head() == 0:
            folder = _write(batch.select("*", *_no_pointers()), path, keys, clustered=True)
            number = log.commit(
                lambda n: None if n else _record(spark, path, folder, widened(None, incoming), keys, batch_id)
            )
            if number == 0 or log.read(1)["data"] == [folder]:
                return number
        ordered = batch.select(*_quoted(keys)).repartitionByRange(*_quoted(keys)).sortWithinPartitions(*_quoted(keys))
        with scratch_table(ordered, "merge-keys") as named:
            number = log.commit(lambda n: _merged(spark, path, n, batch, named, incoming, keys, versions, batch_id))
    if log.due(number):
        take_snapshot(spark, path, number)
    return number


def _no_pointers() -> list[Column]:
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in _POINTERS]


def _merged(spark, path, number, batch, named, incoming, keys, versions, batch_id) -> dict | None:
    """Write the rows of the batch that win against one state; the record that adds them.
    ``named`` are the batch's keys in order."""
    state = state_of(spark, path, number)
    if tuple(keys) != state.keys:
        raise StorageWriteError(path, f"has the key {', '.join(state.keys)}")
    if batch_id is not None and any(r.get("batch_id") == batch_id for r in state.records):
        return None
    schema = widened(state.schema, incoming)
    slim = T.StructType([schema[n] for n in dict.fromkeys([*keys, *versions])])
    missing = [
        F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in batch.columns
    ]
    columns = _quoted([*schema.names, PART, DELETED, OLD_FILE, OLD_ROW])
    # Names of files are longer than many a row: a number goes through the join instead.
    numbered = files_to_search(spark, state, named).withColumn(FILE_NUMBER, F.monotonically_increasing_id())
    with scratch_table(numbered, "merge-files") as near:
        stored = _live_rows(spark, path, state, slim, near, located=True)
        if stored is None:
            won = batch.select("*", *_no_pointers())
        else:
            numbers = F.broadcast(near.select(F.col("file").alias(IN_FILE), FILE_NUMBER))
            stored = stored.join(numbers, IN_FILE).drop(IN_FILE).withColumnRenamed(FILE_NUMBER, IN_FILE)
            won = winners(batch, stored, keys, versions).withColumnRenamed(OLD_FILE, FILE_NUMBER)
            won = won.join(numbers.withColumnRenamed(IN_FILE, OLD_FILE), FILE_NUMBER, "left")
        # Rows that meet no file come from a batch dealt by hash; others lie as the join dealt them.
        folder = _write(won.select("*", *missing).select(*columns), path, keys, clustered=stored is None)
    return _record(spark, path, folder, schema, keys, batch_id)


def _write(rows: DataFrame, path: str, keys: Sequence[str], clustered: bool) -> str:
    """Write data files, each with rows of one label; the folder is nobody else's.

    A first load and a compaction are range-partitioned by label and key, so that files hold
    neighbouring keys. A merge keeps to few files a label, whose keys are near each other as far as the
    batch's are; AQE splits a label with most of the rows.
    """
    folder = uuid.uuid4().hex
    rows = rows.withColumn("_dir", F.md5(PART))
    order = _quoted(["_dir", *keys])
    rows = rows.repartitionByRange(*order) if clustered else rows.hint("rebalance", F.col("_dir"))
    # Sorted as the writer wants it, which then does not sort again.
    rows.sortWithinPartitions(*order).write.partitionBy("_dir").parquet(f"{path}/data/{folder}")
    return folder


def _record(spark, path, folder, schema, keys, batch_id, removed=()) -> dict | None:
    """List the files of one folder with their statistics; None if it has no rows."""
    stored = T.StructType([*_stored(schema).fields, *_POINTERS])
    rows = spark.read.schema(stored).parquet(f"{path}/data/{folder}")
    place = F.col("_metadata.file_path")
    named = rows.select(place.alias("path"), PART, OLD_FILE, *_numbered(keys))
    # A file has one label. Its name is cut from its path once, not for every row.
    about = named.groupBy("path", PART).agg(
        F.count(F.lit(1)).alias("rows"), F.count(OLD_FILE).alias("replacing"), *_bounds(keys)
    )
    # If two paths had one hash, both would get the bits of both, which loses no key.
    words = _words(rows.select(F.xxhash64(place).alias("hash"), _hashed(keys).alias("h")), "hash")
    bitmaps = words.groupBy("hash").agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    files = about.join(bitmaps, F.xxhash64("path") == F.col("hash")).select(
        _relative(F.col("path")).alias("file"), PART, "rows", "replacing",
        _end("low", keys).alias("low"), _end("high", keys).alias("high"), "words",
    )
    seen = Observation()
    totals = [F.count("file").alias("n"), F.sum("replacing").alias("replacing")]
    files.observe(seen, *totals).write.parquet(f"{path}/files/{folder}")
    total = seen.get
    if not total["n"] and not removed:
        return None
    return {
        "schema": schema.json(),
        "keys": list(keys),
        "data": [folder],
        "files": [f"files/{folder}"],
        "pointers": [f"data/{folder}"] if total["replacing"] else [],
        "removed": list(removed),
        "batch_id": batch_id,
        "committed_at": dt.datetime.now(dt.UTC).isoformat(),
    }


# --- upkeep -------------------------------------------------------------------------------


def take_snapshot(spark: SparkSession, path: str, number: int) -> None:
    """Store the file list and the delete vectors of a state as one folder each; names of
    files that are gone are left out."""
    state = state_of(spark, path, number)
    folder = f"snapshot-{number}-{uuid.uuid4().hex}"
    _listed(spark, state).write.parquet(f"{path}/files/{folder}")
    listed = spark.read.schema(_files_schema(state.schema, state.keys)).parquet(f"{path}/files/{folder}")
    live = listed.select("file").distinct()
    dead = replaced_rows(spark, state).join(live, F.col(DEAD_FILE) == F.col("file"), "left_semi")
    dead.toDF(OLD_FILE, OLD_ROW).write.parquet(f"{path}/pointers/{folder}")
    commit_log(spark, path).save_snapshot(
        number,
        {
            "schema": state.schema.json(),
            "keys": list(state.keys),
            "data": [],
            "files": [f"files/{folder}"],
            "pointers": [f"pointers/{folder}"],
            "removed": [],
            "batch_id": None,
            "committed_at": state.records[-1]["committed_at"],
        },
    )


def compact(
    spark: SparkSession, path: str, *, replaced_share: float = 0.2, small_rows: int = 0, drop_deleted: Column | None = None
) -> int:
    """Rewrite the files of which at least ``replaced_share`` is replaced or which hold fewer
    than ``small_rows`` rows, without the replaced rows.

    Tombstones stay, or older changes could bring their keys back; ``drop_deleted`` says
    which of them nothing older can follow. Returns the number of the state that holds; a
    merge that commits meanwhile makes the compaction start anew.
    """
    log = commit_log(spark, path)

    def work(number: int) -> dict | None:
        state = state_of(spark, path, number)
        if state.schema is None:
            return None
        dead = _dead_counts(replaced_rows(spark, state))
        files = live_files(spark, state).join(dead, "file", "left").na.fill({"dead": 0})
        worn = files.where((F.col("dead") > 0) & (F.col("dead") >= F.col("rows") * replaced_share) | (F.col("rows") < small_rows))
        gone = f"removed/{uuid.uuid4().hex}"
        worn.select("file").write.parquet(f"{path}/{gone}")
        chosen = spark.read.schema("file STRING").parquet(f"{path}/{gone}")
        if chosen.isEmpty():
            return None
        rows = _live_rows(
            spark, path, state, _stored(state.schema), files.drop("dead").join(chosen, "file", "left_semi")
        )
        if rows is None:
            rows = spark.createDataFrame([], _stored(state.schema))
        if drop_deleted is not None:
            rows = rows.where(~(F.col(DELETED) & F.coalesce(drop_deleted, F.lit(False))))
        folder = _write(rows.select("*", *_no_pointers()), path, state.keys, clustered=True)
        return _record(spark, path, folder, state.schema, state.keys, None, removed=[gone])

    number = log.commit(work)
    if log.due(number):
        take_snapshot(spark, path, number)
    return number


def live_counts(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """``part, row_count`` of the labels that hold rows, tombstones among them, from the file
    list and the delete vectors."""
    state = state_of(spark, path, number)
    if state.schema is None:
        return spark.createDataFrame([], "part STRING, row_count BIGINT")
    dead = _dead_counts(replaced_rows(spark, state))
    files = live_files(spark, state).join(dead, "file", "left")
    left = F.col("rows") - F.coalesce("dead", F.lit(0))
    return files.groupBy(PART).agg(F.sum(left).alias("row_count")).where("row_count > 0")
