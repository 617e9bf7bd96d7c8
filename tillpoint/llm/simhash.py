"""Operator 9: SimHash near-duplicates by tiled exact comparison.

Fingerprints are grouped into cells by the population counts of a few bit
segments. Two fingerprints within ``radius`` bits differ by at most ``radius``
in the sum of the segments' population counts, so only neighbouring cells are
compared: a cell is cut into tiles, and each pair of tiles is one numpy
exclusive-or with bit counts. A tile pair reports a spanning forest of its
links, never all pairs. The comparison is exact: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forest, stage, texts
from .components import connected_components

TILE = 2048
PIECE = 1 << 22
SPACE = b" \t\n\r\x0b\x0c"


def _word_lists(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text in bounded pieces, cut at white space."""
    data, at = data.lower(), 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in SPACE:
            end += 1
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over word shingles (repeats included): a bit is set when
    it is set in over half the shingle hashes. Fewer words than a shingle:
    the whole sequence is the one shingle; no words: zero."""
    ones, n, carry = np.zeros(64, dtype=np.int64), 0, []
    for words in _word_lists(data):
        words = carry + words
        if len(words) >= shingle:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), dtype="<u8", count=len(words) - shingle + 1)
            for part in np.array_split(h, len(h) // 65536 + 1):
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
            carry = words[len(words) - shingle + 1:]
        else:
            carry = words
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(carry), seed) if carry else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = 3) -> DataFrame:
    """(key, row, fp): one row per input row; null text counts as empty.
    ``row`` is a hash of the text: with the key it names the row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in texts(batch, "body")], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fp)], names=["id", "row", "fp"])

    read = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("row"), F.col(text).alias("body"))
    return read.mapInArrow(run, f"id {kind}, row long, fp long")


def _segments(n: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``n`` nearly equal segments of 64 bits."""
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _half_ball(n: int, radius: int) -> list[tuple[int, ...]]:
    """One of every two opposite offsets of L1 length up to ``radius``."""
    ball = [o for o in product(range(-radius, radius + 1), repeat=n) if sum(map(abs, o)) <= radius]
    return [o for o in ball if o >= (0,) * n]


def _compare(radius: int, tile_rows: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = {}
            for s in "ab":
                col = batch.column(s)
                flat = col.flatten()
                at = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                side[s] = at, flat.field(0).to_numpy(zero_copy_only=False).view(np.uint64), flat.field(1).to_numpy(zero_copy_only=False)
            own = batch.column("own").to_numpy(zero_copy_only=False)
            hi, lo = [], []
            for i in range(batch.num_rows):
                (at, fa, ia), (bt, fb, ib) = side["a"], side["b"]
                fa, ia = fa[at[i]:at[i + 1]], ia[at[i]:at[i + 1]]
                fb, ib = fb[bt[i]:bt[i + 1]], ib[bt[i]:bt[i + 1]]
                pairs = []
                for r in range(0, len(fa), tile_rows):
                    near = np.bitwise_count(fa[r:r + tile_rows, None] ^ fb[None, :]) <= radius
                    if own[i]:  # a tile with itself: above the diagonal
                        near &= np.arange(r, r + near.shape[0])[:, None] < np.arange(len(fb))[None, :]
                    if near.any():
                        x, y = np.nonzero(near)
                        pairs.append((x + r, y))
                if not pairs:
                    continue
                ids = ia if own[i] else np.concatenate([ia, ib])
                x = np.concatenate([p[0] for p in pairs])
                y = np.concatenate([p[1] for p in pairs]) + (0 if own[i] else len(ia))
                root = forest(len(ids), x, y)
                # the root is the item with the smallest index, not id: any spanning link will do
                moved = np.flatnonzero(root != np.arange(len(ids)))
                hi.append(ids[moved])
                lo.append(ids[root[moved]])
            none = np.empty(0, dtype=np.int64)
            yield pa.record_batch([pa.array(np.concatenate([none, *hi])), pa.array(np.concatenate([none, *lo]))], names=["a", "b"])
    return run


def near_links(reps: DataFrame, radius: int, n_rows: int) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints ``reps`` (fp, rep).

    Tiles are compared when their cells' population counts differ by at most
    ``radius`` in sum. Three segments; four beyond two million fingerprints,
    so that a cell stays about a tile (the result is the same).
    """
    parts = _segments(3 if n_rows <= 2_000_000 else 4)
    counts = [F.bit_count(F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1))).cast("int") for at, w in parts]
    celled = reps.select("fp", "rep", *[c.alias(f"p{i}") for i, c in enumerate(counts)])
    cell = [f"p{i}" for i in range(len(parts))]
    # at most (width + 1) ** segments rows: a bound of the fingerprint, not of the data
    sizes = celled.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("n_tiles"))
    tiles = (celled.join(F.broadcast(sizes), cell)
             .withColumn("tile", F.pmod(F.xxhash64("fp"), "n_tiles").cast("int"))
             .groupBy(*cell, "tile").agg(F.collect_list(F.struct("fp", "rep")).alias("items")))
    tiles = stage(tiles, "tiles")
    offsets = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(o)]) for o in _half_ball(len(parts), radius)])
    left = (tiles.withColumn("o", F.explode(offsets))
            .select(F.col("items").alias("a"), F.col("tile").alias("ta"),
                    F.expr(" and ".join(f"o.d{i} = 0" for i in range(len(parts)))).alias("same"),
                    *[(F.col(c) + F.col(f"o.d{i}")).alias(c) for i, c in enumerate(cell)])
            .where(F.expr(" and ".join(f"p{i} between 0 and {w}" for i, (_, w) in enumerate(parts)))))
    right = tiles.select(*cell, F.col("tile").alias("tb"), F.col("items").alias("b"))
    pairs = (left.join(right, cell).where("not same or ta <= tb")
             .select("a", "b", F.expr("same and ta = tb").alias("own")))
    return pairs.mapInArrow(_compare(radius), "a long, b long")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """(id, row, fp, group, component_id), one row per input row: ``group`` is
    the smallest fingerprint reachable, ``component_id`` the smallest key of
    that group's rows (a key with several texts can lead several groups).
    Rows with a null key have neither."""
    fps = stage(fingerprints(docs, key, text, shingle), "fingerprints")
    reps = stage(fps.where("id is not null").groupBy("fp").agg(F.min("id").alias("least")), "classes")
    # fingerprints are linked, not keys: rows that repeat a key stay apart
    links = near_links(reps.select("fp", F.col("fp").alias("rep")), radius, reps.count())
    comps = connected_components(links, "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("group"))
    classes = reps.join(comps, "fp", "left").select("fp", "least", F.coalesce("group", "fp").alias("group"))
    least = classes.groupBy("group").agg(F.min("least").alias("component_id"))
    classes = stage(classes.select("fp", "group").join(least, "group"), "components")
    known = F.col("id").isNotNull()
    return (fps.join(classes, "fp", "left")
            .select("id", "row", "fp", *[F.when(known, F.col(c)).alias(c) for c in ("group", "component_id")]))


def simhash_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """(key, fingerprint, component_id, kept), one row per input row.

    Documents whose fingerprints differ in at most ``radius`` bits link;
    ``component_id`` is the smallest key reachable. Null and empty texts have
    fingerprint zero and link like any other. A row with a null key gets its
    fingerprint, a null component and links nothing. Rows that repeat a key
    each keep a row; they join the component of their own fingerprint. Other
    columns of ``docs`` are not read. No rows: no rows.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return components(docs, key, text, shingle, radius).select(
        F.col("id").alias(key), hexed.alias("fingerprint"), "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
