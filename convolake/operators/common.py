"""Small column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(*names: str) -> Column:
    """A sort key over columns in which nulls come last."""
    return F.struct(*[x for n in names for x in (F.col(n).isNull().alias(f"{n}_null"), F.col(n).alias(n))])


def first_by(value: Column, key: Column, where: Column | None = None) -> Column:
    """The value at the smallest key, among rows where it is not null (and where holds)."""
    return F.min_by(value, F.when(value.isNotNull() if where is None else value.isNotNull() & where, key))


def last_by(value: Column, key: Column, where: Column | None = None) -> Column:
    return F.max_by(value, F.when(value.isNotNull() if where is None else value.isNotNull() & where, key))


def non_empty(c: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def sorted_set(c: Column) -> Column:
    return F.array_sort(F.collect_set(non_empty(c)))


def any_flag(c: Column) -> Column:
    return F.coalesce(F.bool_or(F.coalesce(c, F.lit(False))), F.lit(False))


def smallest(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """key and its n smallest values, joined. Ranks are limited before the shuffle, so no task holds all values."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(value))
    few = df.select(key, value).distinct().withColumn("__rank", rank).filter(F.col("__rank") <= n)
    return few.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(value)), ",").alias("samples"))


def hashed(c: Column) -> Column:
    """An order that has nothing to do with the values' own (hexadecimal MD5)."""
    return F.md5(c.cast("binary"))


def bottom_k(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The n rows with the smallest key (nulls last): each task keeps n, so nothing else is moved."""
    return df.orderBy(key.asc_nulls_last(), *df.columns).limit(n)


def bounded_sample(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The n smallest distinct keys (column key, nulls as <null>): each task keeps n."""
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("<null>")).alias("key")).distinct().orderBy("key").limit(n)
