"""The corpus pipeline: documents through the operators of ``tidemark.llm``, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, mixing, near, queries, token_file
from tidemark.llm.common import read_table, stored
from tidemark.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key that a row's content determines, in place of doc_id; rows without doc_id sort last.

    ``_key`` has the parts missing, doc_id and digest (of the text). Only equal rows share it.
    """
    digest = F.coalesce(F.substr(F.unhex(F.sha2("text", 256)), F.lit(1), F.lit(16)), F.lit(b""))
    return docs.withColumn(
        "_key", F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", digest.alias("digest"))
    )


def _without(docs: DataFrame, rejected) -> DataFrame:
    """Documents whose row is not among those that ``rejected`` gives for (doc_id, text), row keys as doc_id."""
    keyed = _keyed(docs)
    other = rejected(keyed.select(F.col("_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(other, "_key", "left_anti").select(*docs.columns)


def identify_language(spark, docs, sf_dir):
    """Documents without a recognisable language go; a missing lang is filled in."""
    found = language.predict(docs, queries.language_model(docs), COLUMNS)
    known = found.where(F.col("lang_pred") != language.UNDETERMINED)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates stays, the one with the smallest doc_id; equal rows stay together."""
    return _without(docs, lambda rows: near.near_duplicates(rows).where("NOT kept"))


def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    items = read_table(spark, sf_dir, "benchmark")
    return _without(docs, lambda rows: decontaminate.contaminated(rows, items))


def mix_sources(spark, docs, sf_dir):
    """Every document as often as the mix of sources holds it."""
    return mixing.mixed_documents(docs)


def write_tokens(spark, docs, sf_dir):
    """Token ids of all that is left, written and read back: a row per document of the file."""
    path = scratch_path(spark, "corpus-tokens")
    token_file.write(docs, path, queries.tokenizer())
    return token_file.checksums(token_file.read(spark, path))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_file", write_tokens),
]

# SQL has neither the trees of the first stage nor the tokenizer of the last;
# tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
