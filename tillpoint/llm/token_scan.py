"""Operator 7: token counts by separator scan.

Flat token files hold nothing but unsigned big-endian ids, each document
closed by an end-of-document id. Files are read in blocks; a block's
separators are found by one vectorised comparison, and a prefix scan over the
blocks of a file stitches the documents that cross their boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import word_bpe

#: An id past the vocabularies in use whose two bytes are one character of UTF-8,
#: so that Spark's text writer can put it after each document.
END = 50304
BLOCK = 1 << 20


def write_flat(docs: DataFrame, path: str, tokenizer: str, text: str = "text", rows_per_file: int = 20_000) -> None:
    """Write each document's ids (2 bytes each) and END into flat files under
    ``path``, on any file system Spark writes to. Null and empty texts are END
    alone. The order within a file is the order of the rows in their task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(tokenizer)
        for batch in batches:
            ids = [np.frombuffer(x, dtype="<u4").astype(">u2").tobytes() for x in encoder.encode(t.as_py() for t in batch.column(0))]
            yield pa.record_batch([pa.array(ids, pa.binary())], names=["ids"])

    flat = docs.select(text).mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    end = np.array([END], dtype=">u2").tobytes().decode()
    flat.write.option("lineSep", end).option("maxRecordsPerFile", rows_per_file).text(path)


def _find(end: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, last = [], []
            for first, closing, data in zip(batch.column("first").to_pylist(), batch.column("closing").to_pylist(), batch.column("data")):
                ids = np.frombuffer(data.as_py(), dtype=dtype)
                at = np.flatnonzero(ids == end) + first
                if closing and len(ids) and ids[-1] != end:  # the file's last document has no end id
                    at = np.append(at, first + len(ids))
                found.append(at)
                last.append(int(at[-1]) if len(at) else None)
            yield pa.record_batch([batch.column("file"), batch.column("first"), pa.array(last, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                  names=["file", "first", "last", "at"])
    return run


def scan_flat(spark: SparkSession, path: str, end: int = END, dtype: str = ">u2", block: int = BLOCK) -> DataFrame:
    """(file, document, start, n_tokens): the documents of flat token files,
    numbered within their file; the end id is not counted.

    Ids after a file's last end id are a document of their own; bytes that do
    not fill a last id are ignored; an empty file has no documents. A file is
    one row for Spark's binary reader (2 GB at most); its blocks are cut from
    it in the task and searched one by one.
    """
    width = np.dtype(dtype).itemsize
    files = (spark.read.format("binaryFile").load(path).where("length > 0")
             .select(F.col("path").alias("file"), "content", F.floor(F.col("length") / width).alias("n")))
    starts = files.select("file", "content", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(block).cast("long"))).alias("first")).where("n > 0")
    blocks = starts.select("file", "first", (F.col("first") + block >= F.col("n")).alias("closing"),
                           F.expr(f"substring(content, int(first * {width} + 1), int(least({block}, n - first) * {width}))").alias("data"))
    found = blocks.mapInArrow(_find(end, dtype), "file string, first long, last long, at array<long>")
    before = Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select("file", "at", F.coalesce(F.last("last", True).over(before), F.lit(-1)).alias("carry"),
                            F.coalesce(F.sum(F.size("at")).over(before), F.lit(0)).alias("base"))
    return (stitched.select("file", "base", "carry", "at", F.posexplode("at").alias("i", "sep"))
            .select("file", (F.col("base") + F.col("i")).alias("document"),
                    (F.when(F.col("i") == 0, F.col("carry")).otherwise(F.try_element_at("at", F.col("i"))) + 1).alias("start"), "sep")
            .select("file", "document", "start", (F.col("sep") - F.col("start")).alias("n_tokens")))
