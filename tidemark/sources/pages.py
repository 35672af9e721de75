"""Paged snapshots checked against the total that their source announced.

Pages are taken one after the other while the source goes on changing, so an
entity can be on two pages, or on none, and a page can fail to arrive. Pages are stored
with their number; the plan of pages follows from the announced total, and what was
read is held against it: page by page, and as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import latest_per_key
from tidemark.sources.tables import WriteMetrics, write_table

PAGE = "page"
OK, MISSING, SHORT, EXTRA = "ok", "missing", "short", "extra"
# Pages named in an error.
NAMED = 20


def write_pages(rows: DataFrame, path: str, page: str = PAGE) -> WriteMetrics:
    """Land rows with the number of their page, as JSON lines in a folder per page."""
    return write_table(rows.withColumnRenamed(page, PAGE), path, partition_by=[PAGE], fmt="json")


def read_numbered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All landed pages below ``path`` with their number; a broken line is an error."""
    full = T.StructType(list(schema)).add(PAGE, T.IntegerType())
    return spark.read.schema(full).option("mode", "FAILFAST").json(path)


def page_report(pages: DataFrame, total: int, size: int, keys: Sequence[str]) -> DataFrame:
    """page, expected, row_count, repeated, status of every page planned or found.

    ``total`` entities in pages of ``size`` make the plan: full pages and a last one with the
    rest, numbered from 0. ``repeated`` counts rows whose entity is on an earlier page too,
    or earlier on this one. A page is ``missing`` without rows, ``short`` with fewer than expected, and
    ``extra`` beyond the plan or with more rows than it asks for.
    """
    planned = -(-total // size)
    plan = pages.sparkSession.range(planned).select(
        F.col("id").cast("int").alias(PAGE), F.least(F.lit(size), F.lit(total) - F.col("id") * size).alias("expected")
    )
    # Ranked over few columns; an entity is on few pages.
    seen = pages.select(PAGE, *keys).withColumn(
        "_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(PAGE))
    )
    counts = seen.groupBy(PAGE).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("_nth") > 1).alias("repeated"))
    both = plan.join(counts, PAGE, "full_outer").select(
        PAGE, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("expected", "row_count", "repeated")]
    )
    status = (
        F.when(F.col("row_count") == 0, MISSING)
        .when(F.col("row_count") < F.col("expected"), SHORT)
        .when(F.col("row_count") > F.col("expected"), EXTRA)
        .otherwise(OK)
    )
    return both.withColumn("status", status)


def complete_snapshot(
    pages: DataFrame, total: int, size: int, keys: Sequence[str], order: Sequence[str] = (PAGE,), moved: int = 0
) -> DataFrame:
    """The snapshot that numbered pages make, each entity once (the last by ``order``), if it is whole.

    A page that is missing, short or extra is an error that names the pages. So are
    more than ``moved`` entities that came twice: as many others were then passed over
    while pages shifted, and the snapshot must not be read as saying that they are gone.
    Runs one job over the pages' numbers and keys.
    """
    report = page_report(pages, total, size, keys)
    sums = report.agg(
        F.sum("repeated").alias("repeated"),
        F.count_if(F.col("status") != OK).alias("bad"),
        F.sort_array(F.collect_list(F.when(F.col("status") != OK, F.struct(PAGE, "status")))).alias("pages"),
    ).first()
    if sums.bad:
        named = ", ".join(f"{p.page} {p.status}" for p in sums.pages[:NAMED])
        raise ValueError(f"{sums.bad} of {-(-total // size)} pages are not as planned: {named}")
    if (sums.repeated or 0) > moved:
        raise ValueError(f"{sums.repeated} entities are on two pages, so as many of {total} may have been passed over")
    return latest_per_key(pages, keys, order).drop(PAGE)
