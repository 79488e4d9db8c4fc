import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make(spark):
    """documents from (doc_id, text) or (doc_id, text, source) rows, with further constant columns."""

    def build(rows, **more):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) + tuple(more.values()) for r in rows]
        schema = T.StructType(SCHEMA.fields + [T.StructField(name, T.StringType()) for name in more])
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r.doc_id, r.text) for r in small.orderBy("doc_id").collect()]
