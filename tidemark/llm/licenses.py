"""Licence scans by canonical digests.

A text is brought to a canonical form: copyright lines are dropped, letters are
lower case, equivalent spellings are made one, and everything between words is
one space. The digest of an entire canonical text is then looked up among those
of known licences with an equi-join. Besides the whole document, its blocks
(lines between blank lines) and its lines are looked up, each as an entire text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.known_licenses import KNOWN

# Spellings that count as the same, as they stand in canonical text.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sub license": "sublicense",
    "sublicence": "sublicense",
    "non commercial": "noncommercial",
    "non infringement": "noninfringement",
    "organisation": "organization",
    "authorisation": "authorization",
    "recognised": "recognized",
    "merchantibility": "merchantability",
    "favour": "favor",
    "per cent": "percent",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "creative commons by": "cc by",
    "v2": "version 2",
    "v3": "version 3",
}
COPYRIGHT = r"(?im)^[^\p{L}\p{N}\n(©]*(?:copyright\b|\(c\)|©|all rights reserved\b)[^\n]*$"
SHORTEST = 12


def with_canonical(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the canonical form of a text, line ends kept: else, what stands between words is one space."""
    plain = F.lower(F.regexp_replace(text, COPYRIGHT, ""))
    df = df.withColumn("_plain", F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " "))
    usual = F.col("_plain")
    for spelling, other in SPELLINGS.items():
        usual = F.regexp_replace(usual, rf"\b{spelling}\b", other)
    spelled = F.when(F.col("_plain").rlike(rf"\b(?:{'|'.join(SPELLINGS)})\b"), usual).otherwise(F.col("_plain"))
    return df.withColumn(out, F.regexp_replace(spelled, " ?\n ?", "\n")).drop("_plain")


def entire(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[ \n]+", " "))


def known_digests(spark: SparkSession, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """license, digest of the given texts by licence."""
    rows = [(name, text) for name, texts in known.items() for text in texts]
    texts = spark.createDataFrame(rows, "license string, text string")
    clean = with_canonical(texts, "text", "clean")
    return clean.select("license", F.sha2(entire(F.col("clean")), 256).alias("digest")).distinct()


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, scope, nth, license: the entire texts of ``docs`` that are known licence texts.

    ``scope`` is ``text``, ``block`` or ``line``; ``nth`` counts from 0 within
    the document, blocks and lines that are empty in canonical form left out. A
    block of one line is reported as a line only; a text of one line as a text
    and as a line. Null and empty texts hold nothing, texts shorter than
    ``SHORTEST`` canonical characters are not looked up. Every row is scanned:
    repeated rows are reported as often as they come, null ids too. A text that
    is two licences' is reported for both. Other columns are not read.
    """
    clean = with_canonical(docs.select("doc_id", "text"), "text", "clean")

    def units(scope, parts):
        full = F.transform(F.filter(parts, lambda p: F.length(entire(p)) > 0), lambda p: p)
        return F.transform(
            full, lambda p, k: F.struct(F.lit(scope).alias("scope"), k.alias("nth"), p.alias("part"))
        )

    whole = units("text", F.array("clean"))
    blocks = F.filter(units("block", F.split("clean", "\n\n+")), lambda u: F.trim(u["part"], F.lit("\n")).contains("\n"))
    lines = units("line", F.split("clean", "\n"))
    parts = clean.select("doc_id", F.explode(F.concat(whole, blocks, lines)).alias("u"))
    text = entire(F.col("u.part"))
    looked = parts.where(F.length(text) >= SHORTEST).select(
        "doc_id", "u.scope", F.col("u.nth").cast("long").alias("nth"), F.sha2(text, 256).alias("digest")
    )
    return looked.join(known, "digest").select("doc_id", "scope", "nth", "license")
