"""Helpers shared by the operators: lineage cuts, size-checked broadcasts and
Arrow batch access."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BROADCAST_ROWS = 1_000_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once for each application: bound Arrow batches, and give the executors
    this package's code, as ``--py-files`` does, so that tasks can import it
    wherever it is run from."""
    package = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not package.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="tillpoint-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)
    # whole texts are long: unless the session says otherwise, batches of some
    # megabytes instead of ten thousand rows
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "500")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared ``spark.checkpoint.dir``, removed when
    the application ends."""
    ship_package(spark)
    return scratch_path(spark, f"llm-{name}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a *staged* table has at most ``rows`` rows of
    fixed width; otherwise leave the join to shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def release() -> None:
    """Give memory that a task has freed back to the system: workers are kept
    between tasks, next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_KEPT: dict[str, Callable[[], None]] = {}  # what a worker keeps from task to task


def kept_by_worker(name: str, clear: Callable[[], None]) -> None:
    """Say how to let go of what an operator keeps in a worker between tasks."""
    _KEPT[name] = clear


def turn_to(name: str | None = None) -> None:
    """At the start of a task: a worker that turns to another operator lets go of
    what earlier ones kept."""
    for other, clear in _KEPT.items():
        if other != name:
            clear()
    release()


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of a task one at a time: a row may be a block of megabytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}
    release()


def packs(batches: Iterable[pa.RecordBatch], key: str, text: str, max_bytes: int) -> Iterator[tuple[list, list[bytes]]]:
    """Group the rows of a task into packs of about ``max_bytes`` of text (a
    longer document is a pack of its own). Yields (keys, texts)."""
    keys: list = []
    held: list[bytes] = []
    size = 0
    for batch in batches:
        for k, t in zip(batch.column(key).to_pylist(), texts(batch, text), strict=True):
            if held and size + len(t) > max_bytes:
                yield keys, held
                keys, held, size = [], [], 0
            keys.append(k)
            held.append(t)
            size += len(t)
    if held:
        yield keys, held
    del keys, held
    release()


def spans_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets (n + 1) of consecutive pieces with the given lengths."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` items under links a[i]-b[i]:
    repeated minimum over links and pointer jumping, all vectorised."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new
