"""Tables in versions: a replace that cannot lose the table (SK5) and an append
that may be repeated (SK4).

    <path>/load_id=<id>/attempt=<unique>/[<partition>=<value>/]part-*.parquet
    <path>/_versions/<number>.json    which attempt of which load is current, and the schema

A write goes to a folder of its own; only when all of it is there does a commit,
one small file renamed into place, make it part of the table. A write that fails
half way leaves the table as it was, a reader keeps the version it started with,
and a load that is written again takes the place of its former attempt. Two
writers never take the same version number: the later one commits on top of the
other's version. What no version names any more is removed by ``remove_old``.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD, ATTEMPT, COMMITS = "load_id", "attempt", "_versions"
WHOLE = "all"  # load id of a table written as a whole
GRACE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    loads: dict[str, str] = field(default_factory=dict)  # load id -> attempt
    partition_by: tuple[str, ...] = ()

    def text(self) -> str:
        return json.dumps({"loads": self.loads, "partition_by": list(self.partition_by), "schema": self.schema.jsonValue()})

    def folders(self, path: str) -> list[str]:
        return [f"{path}/{LOAD}={load}/{ATTEMPT}={attempt}" for load, attempt in sorted(self.loads.items())]


class _Files:
    """The few calls on Spark's own file systems that commits need."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, folder: str) -> list[tuple[str, float]]:
        """(name, time of the last change in seconds) of a folder's entries."""
        p = self.path(folder)
        if not self.fs.exists(p):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in self.fs.listStatus(p)]

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> bool:
        """Write a file as a whole; False if there is one already."""
        folder, _, name = file.rpartition("/")
        part = self.path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = self.fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        how[0] = rename.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(part), self.fs.makeQualified(self.path(file)), how)
        except Exception:
            if not self.fs.exists(self.path(file)):
                raise
            self.fs.delete(part, False)
            return False
        return True

    def remove(self, p: str) -> None:
        self.fs.delete(self.path(p), True)


def _numbers(files: _Files, path: str) -> list[int]:
    return sorted(int(m[1]) for n, _ in files.names(f"{path}/{COMMITS}") if (m := re.fullmatch(r"(\d+)\.json", n)))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The current version of a table, or the one of the given number; None if
    the table has none."""
    path = path.rstrip("/")
    files = _Files(spark, path)
    found = _numbers(files, path)
    if number is None:
        number = found[-1] if found else None
    if number not in found:
        return None
    x = json.loads(files.read(f"{path}/{COMMITS}/{number:012d}.json"))
    return Version(number, T.StructType.fromJson(x["schema"]), x["loads"], tuple(x["partition_by"]))


def _commit(spark: SparkSession, path: str, change: Callable[[Version | None], Version]) -> Version:
    files = _Files(spark, path)
    while True:
        new = change(version(spark, path))
        if files.create(f"{path}/{COMMITS}/{new.number:012d}.json", new.text()):
            return new


def _write(df: DataFrame, path: str, load_id: str, partition_by: Sequence[str]) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", load_id):
        raise ValueError(f"not a load id: {load_id!r}")
    attempt = f"{int(time.time() * 1000):x}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{LOAD}={load_id}/{ATTEMPT}={attempt}")
    return attempt


def replace_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), load_id: str = WHOLE) -> Version:
    """SK5: the rows of ``df`` become the table. Until all are written the table
    stays as it is; ``df`` may read the table itself."""
    path, partition_by = path.rstrip("/"), tuple(partition_by)
    attempt = _write(df, path, load_id, partition_by)
    return _commit(df.sparkSession, path, lambda old: Version(old.number + 1 if old else 1, df.schema, {load_id: attempt}, partition_by))


def append_load(df: DataFrame, path: str, load_id: str, partition_by: Sequence[str] = ()) -> Version:
    """SK4: the rows of ``df`` become the load ``load_id`` of the table, beside its
    other loads; a load that is there already is replaced by this attempt.

    The columns must be the table's (any order); a new table takes those of ``df``
    and its ``partition_by``."""
    path, spark = path.rstrip("/"), df.sparkSession
    table = version(spark, path)
    if table:
        partition_by = table.partition_by
        if sorted((f.name, f.dataType.simpleString()) for f in df.schema) != sorted((f.name, f.dataType.simpleString()) for f in table.schema):
            raise ValueError(f"the load's columns are not the table's: {df.schema.simpleString()}, {table.schema.simpleString()}")
        df = df.select(*table.schema.names)
    attempt = _write(df, path, load_id, partition_by)

    def change(old: Version | None) -> Version:
        if old is None:
            return Version(1, df.schema, {load_id: attempt}, tuple(partition_by))
        return Version(old.number + 1, old.schema, old.loads | {load_id: attempt}, old.partition_by)

    return _commit(spark, path, change)


def clear_version(spark: SparkSession, path: str) -> Version:
    """SK5: no rows, the same columns; the files stay until ``remove_old``."""
    path = path.rstrip("/")

    def change(old: Version | None) -> Version:
        if old is None:
            raise ValueError(f"no table at {path}")
        return Version(old.number + 1, old.schema, {}, old.partition_by)

    return _commit(spark, path, change)


def read_version(spark: SparkSession, path: str, number: int | None = None, loads: bool = False) -> DataFrame:
    """The table's current rows, or those of an earlier version that is still
    kept. ``loads=True`` adds the column ``load_id``. A folder without versions is
    read as the Parquet folder it is."""
    path = path.rstrip("/")
    table = version(spark, path, number)
    if table is None:
        if number is not None:
            raise ValueError(f"no version {number} at {path}")
        return spark.read.parquet(path)
    columns = [*table.schema.names, *([LOAD] if loads else [])]
    schema = T.StructType([*table.schema.fields, T.StructField(LOAD, T.StringType()), T.StructField(ATTEMPT, T.StringType())])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    if not table.loads:
        return spark.createDataFrame([], schema).select(*columns)
    return spark.read.schema(schema).option("basePath", path).parquet(*table.folders(path)).select(*columns)


def load_counts(spark: SparkSession, path: str) -> DataFrame:
    """(load_id, rows): of each load of the current version."""
    return read_version(spark, path, loads=True).groupBy(LOAD).agg(F.count(F.lit(1)).alias("rows"))


def remove_old(spark: SparkSession, path: str, keep: int = 2, grace_seconds: float = GRACE_SECONDS) -> list[str]:
    """Delete versions before the last ``keep`` and the files that no kept version
    names, if they were last changed over ``grace_seconds`` ago: a reader of an old
    version, and a write under way, have that long to end. Returns the folders."""
    path = path.rstrip("/")
    files, before = _Files(spark, path), time.time() - grace_seconds
    numbers = _numbers(files, path)
    kept = {folder for n in numbers[-keep:] for folder in version(spark, path, n).folders(path)}
    gone = []
    for load, _ in files.names(path):
        if not load.startswith(f"{LOAD}="):
            continue
        for attempt, changed in files.names(f"{path}/{load}"):
            folder = f"{path}/{load}/{attempt}"
            if folder not in kept and changed < before:
                gone.append(folder)
    for n in numbers[:-keep]:
        files.remove(f"{path}/{COMMITS}/{n:012d}.json")
    for folder in gone:
        files.remove(folder)
    return gone
