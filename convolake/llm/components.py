"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convolake.llm.common import Scratch


def components(links: DataFrame, s: Scratch, rounds: int = 60) -> DataFrame:
    """id, comp (the smallest id reachable) of every id in links (a, b). Each round takes the least label among
    neighbours (partial minima, so that hubs are no hot spot) and then the label's own label; labels are written after
    each round, in s. It ends when nothing changes."""
    both = s.written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    if both.isEmpty():
        return both.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    labels = s.written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")), "labels")
    for _ in range(rounds):
        least = both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        step = labels.join(least.withColumnRenamed("a", "id"), "id").select("id", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("further"))
        new = s.written(step.join(jump, "comp", "left").select("id", "old", F.least("comp", "further").alias("comp")), "labels")
        labels = new.select("id", "comp")
        if new.filter("old <> comp").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
