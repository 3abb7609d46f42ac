"""Session helpers: shared scratch space, literals and files."""

from __future__ import annotations

import datetime as dt
import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkingest.errors import ConfigurationError

log = logging.getLogger(__name__)

_LOCAL_SCRATCH: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may run without the setting; it then gets one temporary
    folder per application, since driver and executors share the machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ConfigurationError("spark.checkpoint.dir", "must name a folder all executors share")
    if sc.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="sparkingest-")
    return _LOCAL_SCRATCH[sc.applicationId]


_OWN_FOLDERS: set[str] = set()


def work_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used before, in the application's folder below the shared one. The
    folder is deleted when the driver ends."""
    own = f"{shared_dir(spark)}/sparkingest/{spark.sparkContext.applicationId}"
    if own not in _OWN_FOLDERS:
        files, path = _file_system(spark, own)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWN_FOLDERS.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there, its
    size is known to the planner, and a lost executor recomputes nothing.

    The copy stays until the application ends; ``scratch_table`` deletes it earlier.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for large tables: the copy is deleted when the block ends."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        try:
            delete_path(spark, path)
        except Exception as error:
            log.warning("scratch table %s not deleted: %s", path, error)


def timestamp_literal(moment: dt.datetime) -> Column:
    """A naive time is wall clock in the session's time zone, whatever Python's own is."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def one_row(spark: SparkSession, schema: str, values: tuple) -> DataFrame:
    """A single log row, built from literals in the JVM and written as one file."""
    fields = StructType.fromDDL(schema).fields
    columns = []
    for field, value in zip(fields, values, strict=True):
        literal = timestamp_literal(value) if isinstance(value, dt.datetime) else F.lit(value)
        columns.append(literal.cast(field.dataType).alias(field.name))
    return spark.range(0, 1, 1, 1).select(*columns)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """True if there was something to delete."""
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path) and files.delete(hadoop_path, True)


def rename_to_new(spark: SparkSession, source: str, target: str) -> None:
    """Move a file to a name that must not exist; of several that try, one succeeds."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        path(target).toUri(), spark._jsc.hadoopConfiguration()
    )
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(options, 0)
    context.mkdir(
        path(target).getParent(), jvm.org.apache.hadoop.fs.permission.FsPermission.getDirDefault(), True
    )
    context.rename(path(source), path(target), none)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None if there is none."""
    files, hadoop_path = _file_system(spark, path)
    if not files.exists(hadoop_path):
        return None
    stream = files.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Write a small file whole: it is written aside and gets its name at once.

    Without ``overwrite`` an existing file stays and the answer is False; of several writers
    one gets True. A local rename replaces its target, so there the name is given by a hard
    link, which the system refuses for a name that is taken.
    """
    files, target = _file_system(spark, path)
    jvm = spark._jvm
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    stream = files.create(jvm.org.apache.hadoop.fs.Path(aside), True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    try:
        if overwrite:
            files.delete(target, False)
            return files.rename(jvm.org.apache.hadoop.fs.Path(aside), target)
        if files.getUri().getScheme() == "file":
            name = lambda p: jvm.java.io.File(jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(name(path), name(aside))
        else:
            rename_to_new(spark, aside, path)
        return True
    except Exception:
        if not overwrite and files.exists(target):
            return False
        raise
    finally:
        delete_path(spark, aside)


def folders_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders of one directory, for directories with few of them."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(x.getPath().getName() for x in files.listStatus(folder) if x.isDirectory())


@contextmanager
def option(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session option for the jobs of one block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
