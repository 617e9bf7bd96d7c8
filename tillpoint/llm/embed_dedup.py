"""Operator 2: embedding near-duplicates.

Random-hyperplane sign hashing puts every distinct vector into one bucket of
each of several tables: the number of bits follows the number of vectors, so that
a bucket stays about a tile, and the number of tables the bits, for the wanted
recall. Buckets are cut into tiles; each pair of tiles of a
bucket is one matrix product whose cosines (double precision) are checked
exactly. A pair counts in the first table whose buckets agree, so links are
counted without ever being listed: a tile pair returns link counts and a
spanning forest. Components are found over the distributed forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, forest, stage
from .components import connected_components

TILE = 1024
RECALL = 0.9997  # of pairs exactly at the threshold; closer ones meet more surely


def recall(cosine: float, bits: int, tables: int) -> float:
    """Chance that a pair of this cosine meets in at least one table."""
    return 1 - (1 - (1 - np.arccos(cosine) / np.pi) ** bits) ** tables


def plan_tables(n: int, cosine: float, target: float = RECALL) -> tuple[int, int]:
    """(tables, bits) for ``n`` vectors: buckets of about a tile on average, 8 to 16
    bits, and as many tables as pairs of this cosine need to meet with a chance of
    at least ``target``. A vector is then compared with some tables * tile others,
    whatever the number of vectors (up to 67 million; beyond, buckets grow)."""
    bits = min(16, max(8, int(np.ceil(np.log2(max(n, 1) / TILE)))))
    tables = 1
    while recall(cosine, bits, tables) < target:
        tables += 1
    return tables, bits


def _planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))


def _scaled(X: np.ndarray) -> np.ndarray:
    """Rows brought to a largest component of one half to one by a power of two,
    which changes no other digit: squares of very large and very small components
    then neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(X).max(axis=1, keepdims=True))
    half = exponent // 2  # in two steps: the power itself may be out of range
    return np.ldexp(np.ldexp(X, -half), half - exponent)


def _sign_rows(tables: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            ids, size, dims = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "size", "dim"))
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(dims)])
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                raw = flat[at[own][:, None] + np.arange(d)]  # as stored: single or double precision
                signs = _scaled(raw.astype(np.float64)) @ _planes(int(d), tables, bits, seed) > 0
                sig = (signs.reshape(len(own), tables, bits) * weights).sum(axis=2).astype("<u2")
                raw = [x.tobytes() for x in raw]
                sigs = [s.tobytes() for s in sig]
                for t in range(tables):
                    yield pa.record_batch([
                        pa.array(np.full(len(own), t, dtype=np.int32)), pa.array(sig[:, t].astype(np.int32)),
                        pa.array(np.full(len(own), d, dtype=np.int32)), pa.array(ids[own]), pa.array(size[own]),
                        pa.array(raw, pa.binary()), pa.array(sigs, pa.binary())],
                        names=["t", "bucket", "dim", "node", "size", "vec", "sig"])
    return run


def _check(threshold: float, stored: str):
    def load(items, dim):
        X = np.frombuffer(b"".join(items.field("vec").to_pylist()), dtype=stored).reshape(-1, dim)
        X = _scaled(X.astype(np.float64))
        S = np.frombuffer(b"".join(items.field("sig").to_pylist()), dtype="<u2").reshape(len(X), -1)
        return X, np.sqrt((X * X).sum(axis=1)), S, items.field("node").to_numpy(), items.field("size").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                t, dim, own = (batch.column(c)[i].as_py() for c in ("t", "dim", "own"))
                X, nx, S, ids, size = load(batch.column("a")[i].values, dim)
                Y, ny, R, jds, tize = (X, nx, S, ids, size) if own else load(batch.column("b")[i].values, dim)
                near = (X @ Y.T) / (nx[:, None] * ny[None, :]) >= threshold
                if own:
                    near = np.triu(near, 1)
                x, y = np.nonzero(near)
                if t and len(x):  # the first table in which the two meet counts the pair
                    first = np.ones(len(x), dtype=bool)
                    for k in range(t):
                        first &= S[x, k] != R[y, k]
                    x, y = x[first], y[first]
                if not len(x):
                    continue
                ids_all = ids if own else np.concatenate([ids, jds])
                shift = 0 if own else len(ids)
                add = np.zeros(len(ids_all), dtype=np.int64)
                np.add.at(add, x, tize[y])
                np.add.at(add, y + shift, size[x])
                root = forest(len(ids_all), x, y + shift)
                out = np.flatnonzero(add)
                yield pa.record_batch([pa.array(ids_all[out]), pa.array(ids_all[root[out]]), pa.array(add[out])],
                                      names=["node", "root", "n"])
    return run


def embedding_dedup(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9,
                    target: float = RECALL, seed: int = 7) -> DataFrame:
    """(key, n_links, component_id, kept), one row per input row.

    Pairs with cosine of at least ``threshold`` that meet in a table link (at
    least ``target`` of the pairs exactly there, more of closer ones, see
    ``plan_tables``; all equal vectors link without hashing). ``n_links`` counts
    the other rows linked directly, ``component_id`` is the smallest key
    reachable, ``kept`` says that a row leads its component. Null, empty or
    zero vectors and vectors with null or non-finite components link with
    nothing, nor do rows with a null key (component null, not kept). Vectors
    of different lengths never link. A key with several vectors has a row, with
    links and a component of its own, for each. Rows that repeat, key and vector,
    are one vector: each has its row, none links with its own copies, and others
    count them once. Other columns are not read.
    """
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    stored, kind = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    rows = stage(vectors.select(F.col(key).alias("id"), F.col(embedding).cast(kind).alias("embedding")), "vectors")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    good = rows.where(usable)
    classes = good.distinct().groupBy("embedding").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("size"))
    # numbered once, as they are written: one id can have several vectors, so an id does not name a class
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    tables, bits = plan_tables(classes.count(), threshold, target)
    hashed = (classes.select("node", "size", F.size("embedding").alias("dim"), "embedding")
              .mapInArrow(_sign_rows(tables, bits, seed), "t int, bucket int, dim int, node long, size long, vec binary, sig binary"))
    where = ["t", "bucket", "dim"]
    sizes = hashed.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("n_tiles"))
    # tables * 2 ** bits buckets for each vector length; checked, else joined by shuffle
    sizes = broadcast_if_small(stage(sizes, "bucket-sizes"))
    placed = hashed.join(sizes, where).withColumn("tile", F.pmod(F.xxhash64("node"), "n_tiles").cast("int"))
    items = F.collect_list(F.struct("vec", "sig", "node", "size"))
    tiles = placed.groupBy(*where, "tile").agg(items.alias("a"))
    many = placed.where("n_tiles > 1").groupBy(*where, "tile").agg(items.alias("a"))
    across = (many.withColumnRenamed("tile", "ta").join(many.withColumnsRenamed({"tile": "tb", "a": "b"}), where).where("ta < tb")
              .select("t", "dim", F.lit(False).alias("own"), "a", "b"))
    pairs = tiles.select("t", "dim", F.lit(True).alias("own"), "a", F.lit(None).alias("b")).unionByName(across)
    found = stage(pairs.mapInArrow(_check(threshold, stored), "node long, root long, n long"), "vector-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    comps = connected_components(found, "node", "root")
    # a component is called by the smallest id of its vectors
    labels = classes.select("node", "least").join(comps, "node").groupBy("component").agg(F.min("least").alias("label"))
    labels = comps.join(labels, "component").select("node", "label")
    classes = stage(classes.join(counts, "node", "left").join(labels, "node", "left")
                    .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                            F.coalesce("label", "least").alias("component_id")), "vector-components")
    linked = good.join(classes, "embedding").select("id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(key), "n_links", "component_id",
                                            F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))

