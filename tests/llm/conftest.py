import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that operators use inside, as extra columns of their input.
EXTRA = ("key", "w", "row", "blob", "node", "block", "bucket", "score", "words", "at", "n", "ids", "train")


@pytest.fixture
def documents(spark):
    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit("x").alias(c) for c in EXTRA])
        return df
    return make
