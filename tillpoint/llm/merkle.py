"""Operator 3: Merkle fixity audit of WARC replicas.

Records are hashed; a leaf node covers a fixed range of file offsets and
hashes its records in offset order; a parent hashes ``fanout`` neighbouring
nodes in order, up to one root per file. Two replicas compare roots, and only
children of nodes that differ are read at the next level, down to the records.
Ranges of offsets need no row numbers, so a file of any size is spread over
tasks by (file, range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

RANGE = 1 << 16
FANOUT = 16


def record_digests(records: DataFrame, file: str, offset: str, record: str) -> DataFrame:
    """(file, offset, length, digest) of each record's bytes; null: empty."""
    body = F.coalesce(F.col(record).cast("binary"), F.lit(b""))
    return records.select(F.col(file).alias("file"), F.col(offset).cast("long").alias("offset"),
                          F.length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"))


def _ordered(position: str) -> Column:
    """Digests in order, as one text; rows at the same place in digest order."""
    # a node has at most ``fanout`` children; a leaf range as many records as it has bytes
    rows = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col("digest").alias("d"))))
    return F.sha2(F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["p"].cast("string"), r["d"])), "\n"), 256)


def merkle_tree(leaves: DataFrame, top: int, span: int = RANGE, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of (file, node, digest), from offset ranges up to the roots.
    ``top``: the largest offset of any replica, so that both have one shape."""
    places = F.floor(F.col("offset") / span).cast("long")
    level = leaves.withColumn("node", places).groupBy("file", "node").agg(_ordered("offset").alias("digest"))
    levels, last = [stage(level, "merkle-0")], top // span
    while last:
        last //= fanout
        up = F.floor(F.col("node") / fanout).cast("long")
        level = (levels[-1].withColumn("up", up).groupBy("file", "up").agg(_ordered("node").alias("digest"))
                 .withColumnRenamed("up", "node"))
        levels.append(stage(level, f"merkle-{len(levels)}"))
    return levels


def _differing(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Full outer comparison: (on..., a_digest, b_digest) where they differ."""
    both = a.withColumnRenamed("digest", "a_digest").join(b.withColumnRenamed("digest", "b_digest"), on, "full")
    return both.where(~F.col("a_digest").eqNullSafe(F.col("b_digest")))


def audit(ours: DataFrame, theirs: DataFrame, span: int = RANGE, fanout: int = FANOUT) -> DataFrame:
    """(file, offset, status, digest, replica_digest) of every record that
    differs between two ``record_digests`` tables: ``changed``, ``missing``
    (not in the replica) or ``extra`` (only there). Different records at one
    offset, and how often each repeats, are compared together. Rows
    with a null file or offset are outside any range and not compared; two
    empty tables give no rows.
    """
    # repeated rows become one leaf with its number of copies, before any shuffle
    ours, theirs = (stage(t.where("file is not null and offset is not null").groupBy("file", "offset", "length", "digest")
                          .agg(F.count(F.lit(1)).alias("n"))
                          .select("file", "offset", F.concat_ws(":", F.col("length").cast("string"), "digest",
                                                                F.when(F.col("n") > 1, F.col("n").cast("string"))).alias("digest")),
                          "leaves") for t in (ours, theirs))
    top = ours.select("offset").unionByName(theirs.select("offset")).agg(F.max("offset")).first()[0] or 0
    trees = [merkle_tree(t, top, span, fanout) for t in (ours, theirs)]
    bad = _differing(trees[0][-1], trees[1][-1], ["file", "node"]).select("file", "node")
    up = F.floor(F.col("node") / fanout).cast("long")
    for a, b in zip(trees[0][-2::-1], trees[1][-2::-1]):
        parents = bad.withColumnRenamed("node", "up")
        a, b = (t.withColumn("up", up).join(parents, ["file", "up"], "left_semi").select("file", "node", "digest") for t in (a, b))
        bad = _differing(a, b, ["file", "node"]).select("file", "node")
    bad = stage(bad, "merkle-bad")
    place = F.floor(F.col("offset") / span).cast("long")
    records = []
    for t in (ours, theirs):
        near = t.withColumn("node", place).join(bad, ["file", "node"], "left_semi")
        records.append(near.groupBy("file", "offset").agg(
            F.array_join(F.array_sort(F.collect_list("digest")), " ").alias("digest")))
    found = _differing(*records, ["file", "offset"])
    status = F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra").otherwise("changed")
    return found.select("file", "offset", status.alias("status"), F.col("a_digest").alias("digest"), F.col("b_digest").alias("replica_digest"))
