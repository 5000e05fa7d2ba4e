import pytest
from pyspark.sql import types as T

# A table whose extra columns clash with names the operators use themselves.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("Score", T.StringType()),
    T.StructField("doc", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("mix", T.StringType()), T.StructField("line_doc", T.StringType()),
    T.StructField("recipe", T.StringType()), T.StructField("shard", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """``rows``: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or ""), *["x"] * 7) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
