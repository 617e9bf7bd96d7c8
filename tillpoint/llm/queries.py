"""The registered queries of the numbered operators and of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc_mod, shared_path, ship_package, stage
from .conversation_repair import repair, repaired_digests
from .decontaminate import contained_items
from .embed_dedup import embedding_dedup
from .lm_score import score_texts
from .merkle import audit
from .packing import pack
from .quality_rules import quality_rules
from .simhash import simhash_dedup
from .suffix_dedup import repeated_bytes
from .token_align import align_texts
from .token_scan import scan_flat, write_flat
from .toxicity import score, train, training_sample
from .url_filter import filter_urls

#: verdict, host, path
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
MAX_LABELLED = 16_000  # labelled documents that the toxicity model is fitted on, at most


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def toxicity_model(docs: DataFrame, labels: DataFrame):
    """Fitted on labelled documents that are not held out."""
    learn = labels.where(crc_mod("doc_id", 5) != 0)
    return train(training_sample(docs, learn, "doc_id", "text", "toxic", MAX_LABELLED))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read(spark, sf_dir, "embeddings"))


def replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The record digests (file, offset, length, digest) of two replicas of the
    pages as WARC records: a file holds the pages of a thousand ids end to end. In
    the second, some records have a byte changed and some are lost. A record is
    hashed where it is read; offsets are found from lengths alone."""
    size = F.length(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
                    F.lit("\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"))
    record = F.concat(head, F.coalesce("html", F.lit("")), F.lit("\r\n\r\n"))
    file = F.format_string("warc-%06d", F.floor(F.coalesce("page_id", F.lit(0)) / 1000))
    mark = F.coalesce("page_id", F.lit(0)) * 7919
    body = record.cast("binary")
    damaged_body = F.overlay(record, F.lit("#"), F.lit(20)).cast("binary")  # a character of the head: the length stays
    narrow = stage(pages.select("page_id", file.alias("file"), F.length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"),
                                F.when(mark % 97 == 0, F.sha2(damaged_body, 256)).alias("changed")), "records")
    # offsets: a running sum within the thousand ids of a file
    order = Window.partitionBy("file").orderBy("page_id", "length").rowsBetween(Window.unboundedPreceding, -1)
    placed = narrow.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
    theirs = placed.where(mark % 211 != 1).withColumn("digest", F.coalesce("changed", "digest"))
    return tuple(t.select("file", "offset", "length", "digest") for t in (placed, theirs))


def op3_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(*replicas(read(spark, sf_dir, "pages")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))
    held = (crc_mod("doc_id", 5) == 0).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted", "n_toxic")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "flat")
    write_flat(read(spark, sf_dir, "documents"), path, tokenizer_path())
    found = scan_flat(spark, path)
    return found.select(F.regexp_extract("file", r"part-(\d+)", 1).cast("int").alias("part"),
                        F.regexp_extract("file", r"-c(\d+)", 1).cast("int").alias("file"), "document", "start", "n_tokens")


def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "kept")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_texts(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut off, repeated or given to the
    user, by a hash of conversation and turn."""
    names = ("conv_id", "turn", "role", "text")
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in names}
    fault = F.crc32(F.concat(shown["conv_id"], F.lit(":"), shown["turn"]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown["role"].alias("role"), shown["text"].alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    found = repaired_digests(rows, repair(rows))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
            .select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in sums), F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_embedding_dedup, op3_merkle_audit, op4_toxicity, op5_suffix_dedup, op6_url_filter,
                                   op7_token_counts, op8_best_two_fit, op9_simhash, op10_lm_score, op11_token_alignment, op12_quality_rules, op13_conversation_repair)}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
