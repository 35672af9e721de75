"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Every document gets a hash-random key. Within its source, documents are ordered
by that key; prefix sums of their sizes say how many words come before each. A
source's budget is its whole size as often as it goes in (epochs), and the rest
is cut off the ordered documents. Prefix sums are taken per bucket of the key,
so that a source with a third of all rows is spread over its buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import prefix_sums, stored, word_count

WEIGHTS = (3, 1, 2)


def random_key(seed: int) -> Column:
    """A random-looking key that the document determines."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text")))


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``target`` per source, from one row (source, source_size) per source.

    Sources ordered by code point, null last, take the ``weights`` in turn and
    divide ``share`` times the whole size. A source stops at ``most`` times its
    own size; the excess goes to the others by weight. Sources by rising
    size per weight fill up first, so the level at which the others stand is
    found with one running sum.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
        (F.col("source_size") * most).alias("most"),
    )
    rising = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    full = F.coalesce(
        F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy()
    levels = weighed.withColumn("whole", F.sum("source_size").over(every) * share).withColumn(
        "level", (F.col("whole") - full) / open_weight
    )
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))
    # From the first source that isn't full on, levels only fall.
    level = F.coalesce(F.max(fits).over(every), F.lit(math.inf))
    return levels.select(
        "source", "source_size",
        F.when(F.col("source_size") > 0, F.least(F.col("weight") * level, F.col("most")))
        .otherwise(F.lit(0.0)).alias("target"),
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
    seed: int = 1,
) -> DataFrame:
    """doc_id, key, source, size, source_size, target, copies, taken for every row of ``docs``.

    ``copies`` says how often the mix holds the document, ``taken`` how many
    words that is. The document at the cut goes in if at least half of it is
    before the cut, so a source is off its target by half a document at most.
    A null text has size 0; a null source is a source; equal rows are ordered
    arbitrarily among themselves, which changes nothing in the result as a
    whole. Documents of no words take part and are ordered like the others. An
    empty table gives an empty result. Only doc_id, text and source are read.
    """
    key = random_key(seed)
    sized = stored(
        docs.select(
            "doc_id", "source", word_count("text").alias("size"), key.alias("key"),
            F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_source"),
        ),
        "mix-sizes",
    )
    # About as many buckets as rows in a bucket: neither level outgrows a task.
    digits = max(1, math.ceil(math.log(max(1, sized.count()), 16) / 2))
    source = ["_none", "_source"]
    placed = prefix_sums(
        sized.withColumn("_bucket", F.substring("key", 1, digits)),
        source, "_bucket", ["key"], "size", "before",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(sizes, weights, share, most).select(
        F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_source"),
        "source_size", "target",
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    within = F.col("before") + F.col("size") / 2 <= rest
    return (
        placed.join(aimed, source)
        .withColumn("epochs", whole)
        .withColumn("copies", (F.col("epochs") + F.when(within & (rest > 0), 1).otherwise(0)).cast("int"))
        .select(
            "doc_id", "key", "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, seed: int = 1, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix holds it.

    Rows with one doc_id, source and text share their copies evenly, rounded up.
    """
    own = [F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_source")]
    often = F.ceil(F.sum("copies") / F.count("*")).cast("int")
    plan = (
        mix(docs, seed=seed, **options)
        .select("key", *own, "copies")
        .groupBy("key", "_none", "_source")
        .agg(often.alias("copies"))
        .where("copies > 0")
    )
    # The row travels as one column, so its names can't clash with those of the plan.
    keyed = docs.select(F.struct("*").alias("row"), random_key(seed).alias("key"), *own)
    again = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return keyed.join(plan, ["key", "_none", "_source"]).select("row", again).select("row.*")
