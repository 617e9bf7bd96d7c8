"""Operator 1 (native): benchmark decontamination by size-partitioned MinHash
containment search, verified by exact shingle containment.

Test items are partitioned by size class (powers of two of their number of
distinct shingles). An item keeps a bottom-k MinHash sketch, its k shingles of
smallest hash, with k set by its class: more than the shingles that an item of
that class may miss at the required containment. By the pigeonhole principle a
document with the required containment holds at least ``k - missable`` sketch
shingles, however long it is, so the search loses nothing; a document's size
never enters, which is what lets a forty-word item be found in a book.
Candidates are then verified by exact containment over all shingles.

An item of fewer words than a shingle is one shingle of its own length; texts
get shingles of each such length that occurs among the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage

SPLIT = r"[^\p{L}\p{N}]+"  # fixed value: what parts words


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPLIT), lambda w: w != "")


def shingles(words_col: str, n: int) -> Column:
    """Space-joined runs of ``n`` words; fewer words: the whole sequence; no
    words: none."""
    size = F.size(words_col)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(words_col, i, n), " "))
    return F.when(size > 0, runs).otherwise(F.array().cast("array<string>"))


def runs_of(words_col: str, lengths: list[int]) -> Column:
    """The shingles of each of the ``lengths``; runs of different lengths are
    never equal, as their words hold no space."""
    return F.concat(*[shingles(words_col, n) for n in lengths])


def sketches(items: DataFrame, key: str, text: str, n: int, containment: float) -> DataFrame:
    """(item, length, n_shingles, shingles, sketch, need): one row per distinct
    item; ``length`` is the number of words of its shingles."""
    need = F.ceil(F.col("n_shingles") * containment - 1e-9)
    top = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n_shingles").cast("double"))) + 1) - 1  # of the size class
    k = F.least(F.col("n_shingles"), F.floor(top * (1 - containment) + 1e-9) + 2)
    return (items.where(F.col(key).isNotNull()).select(F.col(key).alias("item"), words(text).alias("w")).distinct()
            .select("item", F.least(F.size("w"), F.lit(n)).alias("length"), F.array_distinct(shingles("w", n)).alias("shingles"))
            .withColumn("n_shingles", F.size("shingles")).where("n_shingles > 0")
            .withColumn("k", k.cast("int"))
            .withColumn("sketch", F.slice(F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s))), F.lit(1), F.col("k")))
            .withColumn("need", (F.col("k") - (F.col("n_shingles") - need)).cast("int"))
            .select("item", "length", "n_shingles", "shingles", "sketch", "need"))


def contained_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                    item_text: str = "text", n: int = 5, containment: float = 0.8) -> DataFrame:
    """(key, item_key, n_shingles, n_found, containment): the documents that
    hold at least ``containment`` of an item's distinct ``n``-word shingles.

    Words are runs of letters and digits, lower-cased. An item of fewer than
    ``n`` words is one shingle, found wherever its words stand in a row; null
    and empty texts have none and match nothing, as do rows with a null key. Rows that repeat a key are judged one
    by one, the largest containment counts. Other columns are not read.
    """
    wanted = stage(sketches(items, item_key, item_text, n, containment), "items")
    probe = broadcast_if_small(stage(wanted.select("item", "need", F.explode("sketch").alias("h")).distinct(), "sketch"))
    base = docs.select(F.col(key).alias("doc"), F.col(text).alias("body")).where("doc is not null")
    lengths = sorted(r["length"] for r in wanted.select("length").distinct().collect()) or [n]  # at most n
    hashes = F.transform(runs_of("w", lengths), lambda s: F.xxhash64(s))
    met = (base.select("doc", words("body").alias("w")).select("doc", F.explode(hashes).alias("h"))
           .join(probe, "h").groupBy("doc", "item", "need").agg(F.count_distinct("h").alias("hits")).where("hits >= need"))
    candidates = stage(met.select("doc", "item"), "candidates")
    # the exact check reads only the documents that the search found
    full = base.join(broadcast_if_small(candidates.select("doc").distinct()), "doc", "left_semi")
    full = full.select("doc", words("body").alias("w")).select("doc", runs_of("w", lengths).alias("own"))
    judged = (full.join(broadcast_if_small(candidates), "doc").join(wanted.select("item", "n_shingles", "shingles"), "item")
              .select("doc", "item", "n_shingles", F.size(F.array_intersect("shingles", "own")).alias("n_found")))
    share = F.col("n_found").cast("double") / F.col("n_shingles")
    return (judged.withColumn("containment", share).where(F.col("n_found") >= F.ceil(F.col("n_shingles") * containment - 1e-9))
            .groupBy("doc", "item").agg(F.max_by(F.struct("n_shingles", "n_found", "containment"), F.struct("containment", "n_found")).alias("r"))
            .select(F.col("doc").alias(key), F.col("item").alias(item_key), "r.*"))
