import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Columns that clash with names the operators use or give.
CLASHING = (
    "block bucket key rank size score kept id hash at n segment window tokens start group component_id lang_pred "
    "_key _none _source _text _own _bucket"
).split()


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text, lang, source) rows, with clashing columns."""

    def make(rows, clashing=True):
        full = [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clashing:
            for name in CLASHING:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
