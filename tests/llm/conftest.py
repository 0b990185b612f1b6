import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows (doc_id, text[, lang]) as a DataFrame."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make
