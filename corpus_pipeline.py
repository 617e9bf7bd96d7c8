"""The training-data pipeline: five stages over ``documents``, each by one
operator, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm.common import broadcast_if_small, shared_path, stage
from tillpoint.llm.decontaminate import contained_items
from tillpoint.llm.packing import pack
from tillpoint.llm.queries import read, tokenizer_path, toxicity_model
from tillpoint.llm.simhash import components
from tillpoint.llm.suffix_dedup import cut_texts
from tillpoint.llm.toxicity import tag


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go."""
    crf = toxicity_model(docs, read(spark, sf_dir, "labels"))
    names = [f"c{i}" for i in range(len(docs.columns))]  # own names: none can clash with the tags
    tagged = tag(docs.toDF(*names), crf, names[docs.columns.index("text")])
    return tagged.where("predicted = 0").select(*names).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one of smallest id; of
    rows of that id in the component the least. Rows with a null id stay."""
    leads = components(docs).where("id = component_id").groupBy("group", "id", "row").agg(F.count(F.lit(1)).alias("n"))
    leads = stage(leads, "kept-rows")
    sizes = stage(leads.groupBy("group").agg(F.sum("n").alias("n"), F.min("id").alias("id"), F.min("row").alias("row")), "kept-groups")
    once = broadcast_if_small(sizes.where("n = 1").select("id", "row"))
    again = broadcast_if_small(stage(leads.join(sizes.where("n > 1").select("group"), "group", "left_semi"), "kept-repeats")
                               .select("group", "id", "row"))

    def same(rows: DataFrame) -> Column:
        return (docs["doc_id"] == rows["id"]) & (F.xxhash64(docs["text"]) == rows["row"])

    order = ["text", *[c for c in docs.columns if c != "text"]]
    least = (docs.join(again, same(again)).select(again["group"], F.struct(*[docs[c] for c in order]).alias("doc"))
             .groupBy("group").agg(F.min("doc").alias("doc")).select("doc.*").select(*docs.columns))
    single = docs.join(once, same(once), "left_semi")
    return single.unionByName(least).unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings go from every text but the first that has them."""
    return cut_texts(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, row by row: a null or
    repeated id is judged by its row's text."""
    # id and text hash name a row: never null, and rows that share both share their text
    rows = docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")).alias("row"), "text")
    found = contained_items(rows, read(spark, sf_dir, "benchmark"), key="row")
    leaks = broadcast_if_small(stage(found.select("row.*").distinct(), "leaks"))
    same = docs["doc_id"].eqNullSafe(leaks["id"]) & (F.xxhash64(docs["text"]) == leaks["hash"])
    return docs.join(leaks, same, "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's pieces in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("best_two_fit", pack_sequences),
]

# A trained random field, tokenizer ids and a greedy plan have no SQL form;
# tests compare the operators with brute force and try the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
