"""Token ids of documents as ORC files that are read by stripe and pruned by document id.

Documents are range-partitioned and sorted by doc_id, so the files follow each
other in ascending order and every stripe and row group covers a narrow range
of ids. ORC writes the ids with integer run-length encoding and keeps minimum,
maximum and a Bloom filter of doc_id per row group: reading some documents
touches only the row groups that may hold them, reading all of them is parallel
over stripes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import small_batches
from tidemark.llm.encoding import encoder

END = 0
# Bytes of text that a task cuts and encodes at once; a row counts as some, too.
BLOCK, ROW_BYTES = 24 << 20, 16
OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(16 << 20),
    "orc.block.padding": "false",
    "compression": "zstd",
}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of about ``BLOCK`` bytes of text, or of one longer text."""
    held, size = [], 0
    for batch in batches:
        ends, low = np.cumsum(pc.binary_length(batch["text"]).to_numpy() + ROW_BYTES), 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + BLOCK - size)))
            held.append(batch.slice(low, high - low))
            size, low = size + int(ends[high - 1] - before), high
            if size >= BLOCK or low < batch.num_rows:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _encode(shared, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        with encoder(shared.value) as ids:
            for block in _blocks(batches):
                low = 0
                for bounds, values in ids.arrays(block["text"], end):
                    part = block.slice(low, len(bounds) - 1)
                    yield pa.record_batch(
                        {
                            "doc_id": part["doc_id"],
                            "block": part["block"],
                            "start_in_block": start + bounds[:-1],
                            "n_tokens": np.diff(bounds),
                            "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values.view(np.int32)),
                        }
                    )
                    low, start = low + part.num_rows, start + int(bounds[-1])

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, partitions: int | None = None) -> None:
    """Encode every text of (doc_id, text) and write the ids below ``path``.

    ``tokenizer`` is the content of a tokenizer file. Every document ends with
    the id ``end``; a null or empty text is that id alone. Null doc_ids come
    first; rows with one doc_id are ordered by their texts and may lie in several files.
    Rows repeat as often as they come. An empty table writes no rows. Other
    columns are not read. A file's rows carry its number (``block``) and the
    ids before them within it, counted while writing; a task that runs again
    writes the same.
    """
    spark = docs.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(tokenizer)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = (
        small_batches(docs)
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(count, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
        .withColumn("block", F.spark_partition_id())
    )
    ordered.mapInArrow(
        _encode(shared, end),
        f"doc_id {kind}, block int, start_in_block long, n_tokens long, ids array<int>",
    ).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids; ``start`` counts the ids of all documents before this one.

    ``where`` (on doc_id) reaches the ORC reader, which passes over stripes and
    row groups by their ranges and Bloom filters. Only one number per file is
    gathered for ``start``, from a scan of two small columns.
    """
    rows = spark.read.orc(path)
    totals = rows.groupBy("block").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    # One row per file.
    chosen = rows if where is None else rows.where(where)
    return chosen.join(F.broadcast(offsets), "block").select(
        "doc_id", (F.col("_offset") + F.col("start_in_block")).alias("start"), "n_tokens", "ids"
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from zlib import crc32

    for batch in batches:
        ids = batch["ids"]
        values, bounds = ids.values.to_numpy(), ids.offsets.to_numpy()
        sums = [crc32(values[a:b].astype("<u4")) for a, b in zip(bounds[:-1], bounds[1:])]
        columns = {c: batch[c] for c in ("doc_id", "start", "n_tokens")}
        yield pa.record_batch(columns | {"ids_crc32": pa.array(sums, pa.int64())})


def checksums(read_back: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as 32-bit integers."""
    kind = read_back.schema["doc_id"].dataType.simpleString()
    return small_batches(read_back).mapInArrow(_checksums, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
