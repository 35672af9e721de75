"""Drifting fields: typed where they fit, kept where they don't, counted, promoted."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import as_set
from tidemark.sources.drift import BROKEN, REST, conformed, drift_report, promote, read_drifting

SCHEMA = T.StructType().add("id", T.StringType()).add("n", T.IntegerType()).add("x", T.DoubleType()).add("a b", T.StringType())
LINES = [
    '{"id": "1", "n": 5, "x": 1.5, "a b": "t"}',
    '{"id": "2", "n": "7", "x": null, "new": {"k": [1, null]}}',
    '{"id": 3, "n": "seven", "x": "2.5", "new": 4}',
    '{"id": "4", "n": 12345678901, "x": {"deep": true}, "other.name": ""}',
    '{"id": "5"}', "{}", "[1, 2]", '{"id": "6", "n":', "", None,
]


@pytest.fixture
def rows(spark):
    return conformed(spark.createDataFrame([(t,) for t in LINES], "value string"), SCHEMA)


def kept(rows):
    got = rows.select("id", F.to_json(REST).alias("rest"), BROKEN).collect()
    return {r.id: json.loads(r.rest) for r in got if r.rest}, sorted(r[BROKEN] for r in got if r[BROKEN])


def test_what_fits_is_typed_and_the_rest_is_kept(rows):
    assert as_set(rows.where("id IS NOT NULL").select("id", "n", "x", "a b")) == {
        ("1", 5, 1.5, "t"), ("2", 7, None, None), ("3", None, 2.5, None), ("4", None, None, None), ("5", None, None, None),
    }
    rest, broken = kept(rows)
    assert rest == {
        "2": {"new": {"k": [1, None]}}, "3": {"n": "seven", "new": 4},
        "4": {"n": 12345678901, "x": {"deep": True}, "other.name": ""},
    }
    assert broken == sorted(["[1, 2]", '{"id": "6", "n":']) and rows.count() == len(LINES)


def test_drift_is_counted_by_field_and_type(rows):
    assert as_set(drift_report(rows, SCHEMA)) == {
        ("new", "undeclared", "OBJECT<k: ARRAY<BIGINT>>", 1), ("new", "undeclared", "BIGINT", 1), ("n", "ill-typed", "STRING", 1),
        ("n", "ill-typed", "BIGINT", 1), ("x", "ill-typed", "OBJECT<deep: BOOLEAN>", 1), ("other.name", "undeclared", "STRING", 1),
        (None, "broken", None, 2),
    }
    assert drift_report(rows.where("id IN ('1', '5')"), SCHEMA).isEmpty()


def test_no_field_is_lost_over_a_stored_table(spark, rows, folder):
    spark.createDataFrame([(t,) for t in LINES if t], "value string").write.text(f"{folder}/landed")
    read_drifting(spark, f"{folder}/landed", SCHEMA).write.parquet(f"{folder}/table")
    assert kept(spark.read.parquet(f"{folder}/table")) == kept(rows)


def test_a_kept_field_can_be_promoted(rows):
    got = promote(rows, "new", T.IntegerType())
    assert {r.id: r.new for r in got.collect() if r.new is not None} == {"3": 4}
    rest, broken = kept(got)
    # What does not fit the new type stays.
    assert rest["2"] == {"new": {"k": [1, None]}} and rest["3"] == {"n": "seven"} and len(broken) == 2
    assert got.columns == ["id", "n", "x", "a b", "new", REST, BROKEN]
    wider = promote(rows.withColumn("n", F.col("n").cast("long")), "n", T.LongType())
    assert {r.id: r.n for r in wider.collect() if r.n} == {"1": 5, "2": 7, "4": 12345678901}


def test_the_report_reads_and_parses_a_line_once(spark, folder):
    spark.createDataFrame([(t,) for t in LINES if t], "value string").write.text(f"{folder}/landed")
    report = drift_report(read_drifting(spark, f"{folder}/landed", SCHEMA), SCHEMA)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Filter" not in plan
    assert plan.count("from_json(MapType(StringType,VariantType,true), value") == 1, plan
    assert report.where("field IS NULL").first()["row_count"] == 2
