import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, extra=""):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for c in extra.split():
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("mine"))
        return df

    return make
