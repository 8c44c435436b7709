import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    def make(texts, **extra):
        rows = [(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
        d = spark.createDataFrame(rows, DOCS)
        return d.withColumns({k: F.lit(v) for k, v in extra.items()})

    return make
