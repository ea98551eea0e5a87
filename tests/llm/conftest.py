import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs_schema():
    return T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                         T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark, docs_schema):
    """Rows of ``documents`` from (doc_id, text[, lang[, source]]), with extra columns whose names
    clash with those that operators use inside."""
    from pyspark.sql import functions as F

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, docs_schema)
        if extra:
            for c in ("id", "n", "v", "key", "hash", "size", "spans", "_spans", "places", "component", "rank", "_d", "_row", "_cut", "_n", "_s",
                      "lang_pred", "score", "doc", "h", "key2", "below", "times", "slot", "body", "set"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return make
