"""Operator 8: best-two-fit packing.

A plan needs only how many pieces there are of each length, a table of at most
``size`` rows. The plan fills a bin greedily from the longest piece down, then
replaces the bin's smallest piece with two unpacked pieces that fit the
expanded gap more tightly, and repeats the bin's pattern while pieces last.
Pieces are ranked within their length by a salted, distributed count and each
finds its bin by its rank, so packing is global and no bin is built by a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .tokens import word_bpe

SALTS = 256


def _best_two(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths a >= b of largest sum within ``room``."""
    lengths = np.flatnonzero(left[:room])
    if not len(lengths):
        return None
    upto = np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))
    b = upto[np.minimum(room - lengths, lengths)]
    single = (b == lengths) & (left[lengths] < 2)
    b[single] = upto[lengths[single] - 1]
    total = np.where(b > 0, lengths + b, 0)
    i = int(total.argmax())
    return (int(lengths[i]), int(b[i])) if total[i] else None


def plan_bins(counts: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Bins for so many pieces of each length: (entries, number of bins).

    An entry (length, first rank, pieces per bin, bins, first bin, offset)
    places the pieces of a length from that rank on.
    """
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(size + 1, dtype=np.int64)
    entries, bins = [], 0
    while left.any():
        bin_, gap, spare = [], size, left.copy()
        while gap:
            fits = np.flatnonzero(spare[:gap + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            n = min(int(spare[length]), gap // length)
            bin_ += [length] * n
            spare[length] -= n
            gap -= n * length
        while gap and len(bin_) > 1:
            two = _best_two(spare, gap + bin_[-1])
            if two is None or sum(two) <= bin_[-1]:
                break
            smallest = bin_.pop()
            spare[smallest] += 1
            for length in two:
                spare[length] -= 1
                bin_.append(length)
            gap += smallest - sum(two)
            bin_.sort(reverse=True)
        lengths, per = np.unique(bin_, return_counts=True)
        times = int((left[lengths] // per).min())
        offset = 0
        for length, k in zip(lengths.tolist(), per.tolist()):
            entries.append((length, int(used[length]), k, times, bins, offset))
            offset += length * k
            used[length] += k * times
            left[length] -= k * times
        bins += times
    return entries, bins


def token_pieces(docs: DataFrame, key: str, text: str, tokenizer: str, size: int, end: int = 0) -> DataFrame:
    """(key, piece, start, length, ids_crc32): each document's ids and the
    end id, cut into pieces of ``size`` only where longer."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(tokenizer)
        tail = np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            at = []
            for i, ids in enumerate(encoder.encode(t.as_py() for t in batch.column(1))):
                ids += tail
                for piece, start in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[start:start + 4 * size]
                    at.append(i)
                    rows.append((piece, start // 4, len(part) // 4, zlib.crc32(part)))
            piece, start, length, crc = zip(*rows) if rows else ([], [], [], [])
            yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                                  names=[key, "piece", "start", "length", "ids_crc32"])

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = 2048, end: int = 0) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset), one row per
    piece; the pieces of a sequence fill it from 0 without gaps.

    Null and empty texts are the end id alone. Rows with a null or repeated
    key are packed like any other. Other columns are not read; no rows: no
    rows. ``tokenizer``: path of the tokenizer's file, the same on every node.
    """
    pieces = stage(token_pieces(docs, key, text, tokenizer, size, end), "pieces")
    # at most ``size`` rows: one for each length
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    entries, _ = plan_bins(counts, size)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(SALTS)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # at most ``size`` times SALTS rows
    groups = salted.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy(F.col(key), "piece", "ids_crc32")
    ranked = (salted.withColumn("n", F.row_number().over(order)).join(F.broadcast(groups), ["length", "salt"])
              .select(key, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("n") - 1).alias("rank")))
    columns = [np.array(c, dtype=np.int64) for c in zip(*sorted(entries))] or [np.empty(0, dtype=np.int64)] * 6
    kind = docs.schema[key].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e_length, e_rank, e_per, _, e_bin, e_offset = columns
        keys = (e_length << 44) + e_rank
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            i = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            nth = rank - e_rank[i]
            yield pa.record_batch([*batch.columns[:5], pa.array(e_bin[i] + nth // e_per[i]), pa.array(e_offset[i] + nth % e_per[i] * length)],
                                  names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{key} {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
