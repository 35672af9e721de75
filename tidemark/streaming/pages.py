"""Single pages as a stream: pages that arrive twice or late, each row taken once.

Pages of a snapshot are fetched and announced one by one, again after a failure, and
not always in order. Here their rows are the events of a stream: a row that came
before, on the page fetched again, is dropped by state that holds the keys seen, for as long
as ``delay`` behind the latest fetch; rows later than that are dropped and counted, as the state
that would know them is gone. What was taken is written exactly once, over restarts too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ordered import latest_per_key


def stream_pages(
    spark: SparkSession,
    base: str,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    keys: Sequence[str],
    fetched: str,
    delay: str = "1 day",
    files: int = 100,
) -> StreamingQuery:
    """Take the page files below ``base`` (JSON lines) that are new since the last start into ``out``, then stop.

    ``keys`` name a row of a page and must hold what tells a snapshot from the next one (its
    run, or the page's number and day). ``fetched`` is the time a page was fetched, the stream's
    event time. Of rows alike in ``keys`` that come within ``delay`` one is kept. ``files`` bounds what one batch reads.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("mode", "FAILFAST").json(base)
    return (
        rows.withWatermark(fetched, delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def page_states(query: StreamingQuery) -> dict[str, int]:
    """Keys held at the end of a finished run of the stream, and in all its batches: rows taken, repeated and too late."""
    held = repeated = late = taken = 0
    for progress in query.recentProgress:
        taken += progress.numInputRows
        for state in progress.stateOperators:
            held = state.numRowsTotal
            late += state.numRowsDroppedByWatermark
            repeated += int(state.customMetrics.get("numDroppedDuplicateRows", 0))
    return {"held": held, "read": taken, "repeated": repeated, "late": late}


def latest_entities(rows: DataFrame, entity: Sequence[str], fetched: str) -> DataFrame:
    """Of the rows taken, the one of each entity that was fetched last; ties by all columns."""
    others = [c for c in rows.columns if c not in (*entity, fetched)]
    return latest_per_key(rows, entity, [fetched, *others])
