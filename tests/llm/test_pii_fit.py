"""What the fit of operator 1 reads."""

from pyspark.sql import functions as F

from convolake.llm import pii


def test_every_document_lends_its_context(spark):
    """1,200 documents, of which each has one candidate of its own and its context for planted spans; a fit on the first
    1,000 by hash would count 1,000 own ones."""
    d = spark.range(1200).select(F.col("id").alias("doc_id"), F.concat(F.lit("nr 123456789 "), F.repeat(F.lit("x"), F.lit(130))).alias("text"))
    own = pii.labelled_candidates(d, 1).filter("kind = 3 AND label = 0 AND x[1] = 9 AND x[3] = 9")
    assert own.agg(F.sum("n")).first()[0] >= 1200
    spans = d.select(F.size(pii.planted(F.col("doc_id").cast("string"), 3)).alias("n")).distinct().collect()
    assert [r.n for r in spans] == [3]
    kinds = d.select(F.explode(pii.planted(F.col("doc_id").cast("string"), 1)).alias("p")).select("p.kind", "p.good", "p.lead").distinct().count()
    assert kinds == spark.range(1).select(F.explode(pii.planted(F.lit("1"))).alias("p")).select("p.kind", "p.good", "p.lead").distinct().count()
