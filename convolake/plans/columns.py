"""Declared columns: predicates, buckets, aliases and aggregates that a user adds to the gold table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolake.operators.common import bottom_k, hashed


def condition(df: DataFrame, expression: str) -> Column:
    """A boolean SQL expression over df's columns; rows where it is null do not match, and neither does any row if it
    names a column that df lacks."""
    names = set(re.findall(r"\b[A-Za-z_]\w*\b", re.sub(r"'[^']*'", "", expression)))
    words = {"and", "or", "not", "in", "is", "null", "true", "false", "between", "like", "rlike"}
    if {n for n in names if n.lower() not in words} - set(df.columns):
        return F.lit(False)
    return F.coalesce(F.expr(expression), F.lit(False))


@dataclass(frozen=True)
class Bucket:
    name: str
    rules: tuple[tuple[str, str], ...]
    default: str = "unknown"


@dataclass(frozen=True)
class Alias:
    name: str
    source: str


@dataclass(frozen=True)
class Aggregate:
    name: str
    source: str
    how: str = "sum"  # sum, count, max, min or mean of a message column


def apply_columns(gold: DataFrame, plan: list[Bucket | Alias | Aggregate], messages: DataFrame | None = None) -> DataFrame:
    """gold with the planned columns (those it has already are skipped); all aggregates take one pass and one join."""
    plan = [p for p in plan if p.name not in gold.columns]
    wanted = [p for p in plan if isinstance(p, Aggregate)]
    if wanted and messages is not None:
        how = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "mean": F.avg}
        cast = lambda p: F.col(p.source).cast("int") if dict(messages.dtypes)[p.source] == "boolean" else F.col(p.source)
        gold = gold.join(messages.groupBy("lead_key").agg(*[how[p.how](cast(p)).alias(p.name) for p in wanted]), "lead_key", "left")
    for p in plan:
        if isinstance(p, Alias):
            gold = gold.withColumn(p.name, F.col(p.source) if p.source in gold.columns else F.lit(None).cast("string"))
        elif isinstance(p, Bucket):
            value = F.lit(p.default)
            for rule, label in reversed(p.rules):
                value = F.when(condition(gold, rule), F.lit(label)).otherwise(value)
            gold = gold.withColumn(p.name, value)
    return gold


def _shown(df: DataFrame, hidden: tuple[str, ...]) -> dict[str, str]:
    return {c: t for c, t in df.dtypes if c not in hidden and not c.startswith("message_body")}


def schema_sample(df: DataFrame, hidden: tuple[str, ...] = (), n: int = 5) -> DataFrame:
    """column_name, dtype and samples of each column that is not hidden: the n of its distinct values whose hash is lowest,
    joined. No order of rows and no split into partitions changes them; ranks are limited before the shuffle."""
    kinds = _shown(df, hidden)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in kinds])).alias("x")
    each = df.select(cells).select("x.*").filter("value IS NOT NULL").distinct()
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(hashed(F.col("value")), "value"))
    found = each.withColumn("r", rank).filter(F.col("r") <= n).groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("samples"))
    dtype = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    return found.select("column_name", "samples", dtype[F.col("column_name")].alias("dtype"))


def row_sample(df: DataFrame, hidden: tuple[str, ...] = (), n: int = 10) -> DataFrame:
    """The n rows (columns that are not hidden, as text) whose hash is lowest: each task keeps n of its own."""
    kinds = _shown(df, hidden)
    d = df.select(*[F.col(c).cast("string").alias(c) for c in kinds])
    return bottom_k(d, hashed(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in kinds])), n)
