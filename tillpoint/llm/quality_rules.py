"""Operator 12: quality rules by cross-document line frequency.

Each line's words, A-Z lower-cased and joined by one space, are hashed together
with the document's host (128 bits). A document sends each of its distinct lines
once; the number of documents of each (host, line) is a plain count, combined
before the shuffle, so a line that a third of all documents hold costs a task one
row. Lines in more than ``limit`` documents of their host are removed, and a
document that loses more than ``most_lost`` of its words, or has fewer than
``min_words`` left, is rejected as depleted.

The text is read once, in Arrow batches, for the counts of the rules and for its
lines' hashes; only hashes and counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, release, stage, texts

LIMIT = 30  # documents of a host that may hold a line
MOST_LOST = 0.5  # share of a document's words that removed lines may hold
MIN_WORDS = 20
MOST_REPEATED = 30  # percent of a document's words in repeated windows
WINDOW = 8
_SYMBOLS = b"#*$%&|<>"  # fixed values


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in windows of ``window`` words that the text holds
    twice or more, the first among them. Windows are compared exactly: words are
    numbered, then pairs, then pairs of pairs, as far as a window needs."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    if len(numbers) == n:
        return 0
    size = 1
    while size < window:
        step = min(size, window - size)  # the last step may overlap
        _, ids = np.unique(ids[:-step] * (ids.max() + 1) + ids[step:], return_inverse=True)
        size += step
    again = np.bincount(ids)[ids] > 1
    if not again.any():
        return 0
    edges = np.zeros(n + 1, dtype=np.int64)
    edges[:len(again)] += again
    edges[window:window + len(again)] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def line_key(host: bytes, words: list[bytes]) -> bytes:
    """128 bits that stand for a host and a normalised line."""
    return xxhash.xxh3_128_digest(b"%d %b%b" % (len(host), host, b" ".join(words).lower()))


def measures(text: bytes, host: bytes) -> tuple[tuple[int, int, int, int, int], dict[bytes, int]]:
    """((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), words on
    each distinct normalised line, by its key)."""
    words = text.split()
    joined = np.frombuffer(b"".join(words), dtype=np.uint8)
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    duplicates = 0
    lines: dict[bytes, int] = {}
    for line in text.split(b"\n"):
        own = line.split()
        if own:
            if line in seen:
                duplicates += 1
            seen.add(line)
            key = line_key(host, own)
            lines[key] = lines.get(key, 0) + len(own)
    counts = (len(words), int(((joined & 0xC0) != 0x80).sum()), symbols, duplicates, repeated_words(words))
    return counts, lines


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURED = "key string, " + ", ".join(f"{c} long" for c in COUNTS) + ", high array<long>, low array<long>, line_words array<long>"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(texts(batch, "text"), texts(batch, "host"), strict=True)
        for keys, counts, found in _slices(batch.column("key").to_pylist(), rows):
            ends = pa.array(np.cumsum([0, *(len(x) for x in found)]), pa.int32())
            hashes = np.frombuffer(b"".join(k for x in found for k in x), dtype="<i8").reshape(-1, 2)
            sizes = np.array([n for x in found for n in x.values()], dtype=np.int64)
            yield pa.record_batch(
                [pa.array(keys, pa.string()), *(pa.array(c, pa.int64()) for c in zip(*counts)),
                 *(pa.ListArray.from_arrays(ends, pa.array(v, pa.int64())) for v in (hashes[:, 0], hashes[:, 1], sizes))],
                names=[c.split()[0] for c in MEASURED.split(", ")])
    release()


def _slices(keys: list, rows) -> Iterator[tuple[list, list, list]]:
    """Measures of a batch, in slices of a bounded number of lines."""
    held: tuple[list, list, list] = ([], [], [])
    lines = 0
    for key, (text, host) in zip(keys, rows, strict=True):
        counts, found = measures(text, host)
        for kept, x in zip(held, (key, counts, found)):
            kept.append(x)
        lines += len(found)
        if lines > 100_000:
            yield held
            held, lines = ([], [], []), 0
    if held[0]:
        yield held


def _measured(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """One narrow row per document, numbered: hashes and counts, no text."""
    narrow = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"),
                         F.col(host).cast("string").alias("host"))
    rows = narrow.mapInArrow(_measure, MEASURED).withColumn("row", F.monotonically_increasing_id())
    return stage(rows, "quality-lines")


def _frequent(lines: DataFrame, limit: int) -> DataFrame:
    """(high, low, n_docs): the keys of lines in more than ``limit`` documents."""
    counts = lines.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > limit)
    return broadcast_if_small(stage(counts, "quality-frequent"))


def _lines(measured: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("high", "low", "line_words"))
    return measured.select("row", zipped.alias("x")).select("row", "x.high", "x.low", F.col("x.line_words").alias("n"))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limit: int = LIMIT,
                  most_lost: float = MOST_LOST, min_words: int = MIN_WORDS, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_removed_words, kept), one row per input row.

    A document fails at once with fewer than ``min_words`` words or with more
    than ``most_repeated`` percent of them in repeated windows. Else it is kept
    unless it is depleted: its lines in more than ``limit`` documents of its host
    hold more than ``most_lost`` of its words, or leave fewer than ``min_words``.
    Words are what ASCII white space parts; lines end at ``\\n`` and count once
    for a document; a line without words is none. Every row is a document, also
    one that repeats a key or has none; null texts are empty, null hosts are the
    empty host. Texts are measured whole. Other columns are not read; no rows:
    no rows.
    """
    measured = _measured(docs, key, text, host)
    lines = _lines(measured)
    lost = lines.join(_frequent(lines, limit), ["high", "low"]).groupBy("row").agg(F.sum("n").alias("n_removed_words"))
    rows = measured.select("row", "key", *COUNTS).join(lost, "row", "left")
    removed = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    depleted = (removed > most_lost * F.col("n_words")) | (F.col("n_words") - removed < min_words)
    return rows.select(F.col("key").cast(docs.schema[key].dataType).alias(key), *COUNTS, failed.alias("base_failed"),
                       removed.alias("n_removed_words"), (~failed & ~depleted).alias("kept"))


def frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", limit: int = LIMIT) -> DataFrame:
    """(host, line, n_docs): the normalised lines in more than ``limit`` documents
    of their host, most frequent first. Nulls as in ``quality_rules``."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    words = F.array_remove(F.split(F.translate("line", upper, lower), r"[\x20\x09-\x0D]+"), "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n").alias("lines"))
    once = rows.select("row", "host", F.explode("lines").alias("line")).select("row", "host", F.array_join(words, " ").alias("line")).where("line <> ''").distinct()
    return (once.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > limit)
            .orderBy(F.desc("n_docs"), "host", "line"))


def remove_frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", limit: int = LIMIT) -> DataFrame:
    """``docs`` with the lines above ``limit`` taken out of ``text``; the other
    columns, and texts without such lines, stay as they are (null stays null).

    Each document learns the keys of its own frequent lines, no more.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # own names: none can clash
    place, at = docs.columns.index(text), docs.columns.index(host)
    staged = stage(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "quality-docs")
    measured = _measured(staged, "row", names[place], names[at])
    lines = _lines(measured)
    owned = (lines.join(_frequent(lines, limit), ["high", "low"])
             .join(measured.select("row", F.col("key").cast("long").alias("doc")), "row")
             .groupBy("doc").agg(F.collect_list(F.struct("high", "low")).alias("gone")))  # at most a document's own lines
    rows = staged.join(owned, staged["row"] == owned["doc"], "left").drop("row", "doc")
    schema = staged.drop("row").schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(names[place]).cast(pa.binary()).to_pylist()
            hosts = texts(batch, names[at])
            kept = []
            for t, h, gone in zip(raw, hosts, batch.column("gone").to_pylist(), strict=True):
                if gone:
                    out = {np.array([g["high"], g["low"]], dtype="<i8").tobytes() for g in gone}
                    t = b"\n".join(x for x in t.split(b"\n") if not x.split() or line_key(h, x.split()) not in out)
                kept.append(t)
            columns = [pa.array(kept, pa.binary()).cast(pa.string()) if c == names[place] else batch.column(c) for c in names]
            yield pa.record_batch(columns, names=names)

    return rows.mapInArrow(cut, schema).toDF(*docs.columns)
