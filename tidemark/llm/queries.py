"""One query per operator of this package, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontaminate,
    encoding,
    hard_negatives,
    language,
    licenses,
    mixing,
    near,
    quality_rules,
    repair,
    repeats,
    token_count,
    token_file,
    topk,
)
from tidemark.llm.common import read_table, stored
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op6_chat_format(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.digests(chat.read_back(stored(chat.windows(turns.unionByName(own)), "chat-windows")))


@query
def op8_mix_sources(spark, sf_dir):
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def language_model(docs: DataFrame) -> language.Model:
    """Learned from the labelled documents that are not held out."""
    return language.train(docs.where(~held_out()).select("doc_id", "text", "lang"))


@query
def op9_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    found = language.predict(docs, language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op10_decontaminate(spark, sf_dir):
    docs, items = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contaminated(docs, items)


def tokenizer() -> str:
    import public_tokenizers

    return encoding.content(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_token_file(spark, sf_dir):
    path = scratch_path(spark, "token-ids")
    token_file.write(read_table(spark, sf_dir, "documents"), path, tokenizer())
    return token_file.checksums(token_file.read(spark, path))


def revisions(text: str):
    """Three edits that depend on the document: a phrase replaced, a line put first, the end cut."""
    size = F.length(text)
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(size, F.lit(1)).cast("long"))

    def edit(at, deleted, inserted):
        return F.struct(
            at.cast("int").alias("at"), F.lit(deleted).alias("deleted"), F.lit(inserted).alias("inserted")
        )

    return F.array(
        edit(place, 25, " revised in 2025, "),
        edit(F.lit(0), 0, "Second edition.\n"),
        edit(size - F.lit(20), 40, ""),
    )


@query
def op5_token_counts(spark, sf_dir):
    content = tokenizer()
    trees = token_count.build(read_table(spark, sf_dir, "documents"), content)
    changed = token_count.edited(trees.withColumn("edits", revisions("text")), content)
    return changed.select(
        "doc_id", "n_tokens_before", "n_tokens", F.length("text").cast("long").alias("n_chars"),
        F.size("leaf_tokens").cast("long").alias("n_leaves"), F.col("encoded").alias("chars_encoded"),
    )


@query
def op4_license_scan(spark, sf_dir):
    return licenses.scan(read_table(spark, sf_dir, "documents"), licenses.known_digests(spark))


@query
def op7_near_duplicates(spark, sf_dir):
    return near.near_duplicates(read_table(spark, sf_dir, "documents"), similarity=0.85)


@query
def op2_remove_repeats(spark, sf_dir):
    left = repeats.without_repeats(read_table(spark, sf_dir, "documents"))
    return left.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op3_top_k(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults: by a checksum of conversation and turn, rows go, lose text or stops, repeat or change role."""
    space = F.lit(" ")
    fate = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])) % 20
    role, text = (F.coalesce(c, space) for c in ("role", "text"))
    rows = turns.where(fate != 0).select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 3, 2).otherwise(1).alias("_times"),
    )
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).drop("_times", "_copy")


@query
def op11_conversation_repair(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    told = repair.summary(damaged(turns)).withColumnRenamed("conv_id", "_conv")
    all_ = turns.select("conv_id").distinct().join(told, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return all_.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in repair.COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_hard_negatives(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")))


@query
def op13_quality_rules(spark, sf_dir):
    return quality_rules.judged(read_table(spark, sf_dir, "documents")).drop("rules_asked")
