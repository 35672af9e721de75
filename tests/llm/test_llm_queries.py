"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import differences, oracle
from tidemark.llm import oracle as llm_oracle
from tidemark.llm import queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_all_are_registered():
    assert sorted(q.split("_")[0] for q in queries.QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(llm_oracle.ORACLE) <= set(entry.oracle_sql()) & set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got)
    if name in llm_oracle.ORACLE:
        assert differences(got, oracle(SF_DIR).execute(llm_oracle.ORACLE[name]).df()) == ""


def test_pipeline_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame(
        [(-1, None, None, None, None), (-2, "123 !?", "en", "src0", 6)], docs.schema
    ).union(docs.where("doc_id = 5").selectExpr("100000 AS doc_id", "text", "lang", "source", "n_chars"))
    docs, counts, columns = docs.union(extra), [], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        counts.append(docs.count())
        if name != "token_file":
            assert docs.columns == columns
            assert docs.where("doc_id IN (-1, -2)").isEmpty()
        if name != "language":
            assert name == "token_file" or docs.where("doc_id = 100000").isEmpty()
    assert counts[0] == 201 and counts[1] < counts[0] and counts[2] <= counts[1] and counts[4] == counts[3] > 0
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_pipeline_drops_rows_not_ids(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    near = " ".join(f"w{k}" for k in range(200))
    clean = [(i, f"clean{n} " + " ".join(f"c{n}x{k}" for k in range(50))) for n, i in enumerate((None, None, 7))]
    rows = clean + [(None, near), (3, near + " end"), (7, near + " stop"), (None, item), (7, item + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    kept = sorted((str(r.doc_id), r.text) for r in left.collect())
    assert len(kept) == 5 and ("3", near + " end") in kept and {(str(i), t) for i, t in clean} < set(kept)
    kept = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.drop_contaminated(spark, docs, SF_DIR).collect())
    assert kept == sorted((str(i), t) for i, t in rows[:6])


def test_pipeline_of_no_documents(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.isEmpty()
