"""Change detection: source ids, statistical drift, promotion of unknown columns, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.text import has_pii
from convolake.operators.bronze import metadata_keys, snake_case, valid_json


def fingerprint(ids: DataFrame) -> DataFrame:
    """One row: an order-free fingerprint of distinct ids, from the first 60 bits of each one's MD5. A null id counts as an
    empty one."""
    one = F.coalesce(F.col("message_id").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(one.cast("binary")), 1, 15), 16, 10).cast("long")
    return ids.select(one.alias("id"), h.alias("h")).distinct().agg(F.count("*").alias("ids"), F.coalesce(F.bit_xor("h"), F.lit(0)).cast("long").alias("xor"), F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"))


class Fingerprints:
    """The fingerprints of a source from run to run: each run adds one row, the last one counts."""

    SCHEMA = "run long, ids long, xor long, total decimal(38,0)"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.createDataFrame([], self.SCHEMA).write.mode("ignore").parquet(folder)

    def stored(self) -> DataFrame | None:
        """The last run's row, or None before the first."""
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.folder)
        last = rows.agg(F.max("run")).first()[0]
        return None if last is None else rows.filter(F.col("run") == last)

    def observe(self, source: DataFrame) -> DataFrame:
        """One row (run, changed, ids, added, xor_differs, total_differs): source against the last run; then it is stored."""
        before, now = self.stored(), fingerprint(source)
        run = 0 if before is None else before.first().run + 1
        row = now.withColumn("run", F.lit(run).cast("long")).select("run", "ids", "xor", "total")
        row.coalesce(1).write.mode("append").parquet(self.folder)
        row = self.stored()
        if before is None:
            return row.select("run", F.lit(True).alias("changed"), "ids", F.col("ids").alias("added"), F.lit(True).alias("xor_differs"), F.lit(True).alias("total_differs"))
        both = row.alias("a").join(F.broadcast(before.alias("b")))  # one row each
        differs = lambda c: ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        any_ = differs("ids") | differs("xor") | differs("total")
        return both.select("a.run", any_.alias("changed"), "a.ids", (F.col("a.ids") - F.col("b.ids")).alias("added"), differs("xor").alias("xor_differs"), differs("total").alias("total_differs"))


def new_ids(current: DataFrame, known: DataFrame) -> DataFrame:
    return current.select("message_id").distinct().join(known.select("message_id"), "message_id", "left_anti")


def missing_ids(current: DataFrame, known: DataFrame) -> DataFrame:
    return new_ids(known, current)


def changed(current: DataFrame, stored: DataFrame | None) -> DataFrame:
    """One row: whether the fingerprint differs from the stored one; without one, yes."""
    if stored is None:
        return current.select(F.lit(True).alias("changed"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("ids", "xor", "total")]
    return current.alias("a").join(F.broadcast(stored).alias("b")).select((~(same[0] & same[1] & same[2])).alias("changed"))


def null_rates(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.round(F.col(c) / F.greatest("n", F.lit(1)), 6).alias("null_rate")) for c in columns])).alias("x")).select("x.*")


def frequencies(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """column_name, value and its share among the column's non-null values, rounded to six places."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    counts = df.select(cells).select("x.*").filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    total = counts.groupBy("column_name").agg(F.sum("n").alias("total"))
    return counts.join(total, "column_name").select("column_name", "value", F.round(F.col("n") / F.col("total"), 6).alias("freq"))


def null_rate_rise(current: DataFrame, baseline: DataFrame, least: float = 0.10) -> DataFrame:
    b = baseline.select("column_name", F.col("null_rate").alias("before"))
    return current.join(b, "column_name").select("column_name", "before", "null_rate", F.round(F.col("null_rate") - F.col("before"), 6).alias("rise")).filter(F.col("rise") >= least)


def record_drop(current: DataFrame, baseline: DataFrame, least: float = 0.20) -> DataFrame:
    n = current.agg(F.count("*").alias("rows"))
    m = baseline.agg(F.count("*").alias("before"))
    return n.join(F.broadcast(m)).select("before", "rows", ((F.col("before") > 0) & ((F.col("before") - F.col("rows")) / F.greatest("before", F.lit(1)) >= least)).alias("dropped"))


def drift_triggers(shifts: DataFrame, rises: DataFrame, drop: DataFrame) -> DataFrame:
    """One row: what the detector found (columns of distribution_shift(), null_rate_rise() and record_drop()), joined."""
    named = shifts.select(F.concat(F.lit("distribution_shift:"), "column_name").alias("trigger"))
    named = named.unionByName(rises.select(F.concat(F.lit("null_rate:"), "column_name").alias("trigger")))
    named = named.unionByName(drop.filter("dropped").select(F.lit("record_drop").alias("trigger")))
    return named.agg(F.array_join(F.array_sort(F.collect_list("trigger")), ",").alias("triggers"))


def frequency_changes(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Change of each value's share, over the union of values."""
    b = baseline.select("column_name", "value", F.col("freq").alias("before"))
    zero = F.lit(0.0)
    return current.join(b, ["column_name", "value"], "full").select("column_name", "value", F.coalesce("before", zero).alias("before"), F.coalesce("freq", zero).alias("freq"), F.round(F.coalesce("freq", zero) - F.coalesce("before", zero), 6).alias("diff"))


def distribution_shift(changes: DataFrame, least: float = 0.15) -> DataFrame:
    return changes.groupBy("column_name").agg(F.max(F.abs("diff")).alias("shift")).filter(F.col("shift") >= least)


def boolean_strings(df: DataFrame) -> DataFrame:
    """Metadata keys whose values are strings that say yes or no, with the number of such rows."""
    ok = F.when(valid_json(F.col("metadata")), F.col("metadata"))
    d = df.select(ok.alias("m"), F.explode(F.json_object_keys(ok)).alias("key"))
    value = F.try_variant_get(F.try_parse_json("m"), "$", "map<string,variant>")[F.col("key")]
    d = d.withColumn("value", value).filter(F.schema_of_variant("value") == "STRING")
    return d.filter(F.lower(F.try_variant_get("value", "$", "string")).isin("true", "false", "sim", "nao")).groupBy("key").agg(F.count("*").alias("rows"))


def key_renames(df: DataFrame) -> DataFrame:
    """Metadata keys that differ from their snake-case form."""
    return metadata_keys(df).withColumn("normalized", snake_case(F.col("key"))).filter("key <> normalized")


def outcome_gap(df: DataFrame, vocabulary: tuple[str, ...], stem: str = "negoci") -> DataFrame:
    o = F.lower("conversation_outcome")
    return df.agg(F.count_if(o.contains(stem) & ~F.col("conversation_outcome").isin(*vocabulary)).alias("uncovered"), F.count_if(o.contains(stem)).alias("rows"))


def promotion_stats(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Density, distinct values, numeric moments and value class of candidate columns, exact, from one aggregation."""
    number = lambda c: F.col(c).try_cast("double")
    aggs = [x for c in columns for x in (F.count(c).alias(f"{c}__n"), F.count_distinct(c).alias(f"{c}__d"), F.count(number(c)).alias(f"{c}__x"), F.avg(number(c)).alias(f"{c}__m"), F.stddev_samp(number(c)).alias(f"{c}__s"))]
    one = df.agg(F.count("*").alias("rows"), *aggs)
    row = lambda c: F.struct(F.lit(c).alias("column_name"), (F.col(f"{c}__n") / F.greatest("rows", F.lit(1))).alias("density"), F.col(f"{c}__d").alias("distinct_values"), (F.col(f"{c}__x") > 1).alias("numeric"), F.col(f"{c}__m").alias("mean"), F.col(f"{c}__s").alias("std"))
    return one.select(F.explode(F.array(*[row(c) for c in columns])).alias("x")).select("x.*").withColumn("value_class", value_class(F.col("numeric")))


def value_class(numeric: Column) -> Column:
    """Numeric where mean and standard deviation are defined: two numbers at least."""
    return F.when(numeric, "numeric_continuous").otherwise("categorical_text")


# --- column sketches, one set of rows per cycle ------------------------------------------------------------------------------
#: Registers of the distinct sketch: 2 ** SKETCH of them, a relative error of about 1.04 / 2 ** (SKETCH / 2).
SKETCH = 14
SKETCHES = "cycle long, column_name string, rows long, filled long, values binary, numbers long, mean double, m2 double"


def column_sketches(df: DataFrame, columns: tuple[str, ...], cycle: int) -> DataFrame:
    """What one cycle's rows say about columns, to be stored and merged with other cycles' rows: rows, filled cells, a
    sketch of the distinct values, and the numbers among them with their mean and sum of squared deviations."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    number = F.col("value").try_cast("double")
    d = df.select(cells).select("x.*").groupBy("column_name").agg(
        F.count("*").alias("rows"),
        F.count("value").alias("filled"),
        F.hll_sketch_agg("value", F.lit(SKETCH)).alias("values"),
        F.count(number).alias("numbers"),
        F.coalesce(F.avg(number), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(number) * F.count(number), F.lit(0.0)).alias("m2"),
    )
    return d.select(F.lit(cycle).cast("long").alias("cycle"), *[c for c in d.columns])


def merged_sketches(log: DataFrame) -> DataFrame:
    """One row per column from the stored rows of any cycles, without their data: the moments are merged about the common
    mean, so nothing cancels."""
    n = F.col("numbers")
    whole = F.sum(n * F.col("mean")).over(Window.partitionBy("column_name")) / F.nullif(F.sum(n).over(Window.partitionBy("column_name")), F.lit(0))
    d = log.withColumn("centre", F.coalesce(whole, F.lit(0.0)))
    return d.groupBy("column_name").agg(
        F.max("cycle").alias("cycle"),
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.hll_union_agg("values").alias("values"),
        F.sum(n).alias("numbers"),
        F.max("centre").alias("mean"),
        F.sum(F.col("m2") + n * F.pow(F.col("mean") - F.col("centre"), 2)).alias("m2"),
    )


def sketched_stats(merged: DataFrame) -> DataFrame:
    """promotion_stats() from merged sketches: distinct values are estimates, the rest is exact."""
    numbers = F.col("numbers")
    return merged.select(
        "column_name",
        (F.col("filled") / F.greatest("rows", F.lit(1))).alias("density"),
        F.hll_sketch_estimate("values").alias("distinct_values"),
        (numbers > 1).alias("numeric"),
        F.when(numbers > 0, F.col("mean")).alias("mean"),
        F.when(numbers > 1, F.sqrt(F.col("m2") / (numbers - 1))).alias("std"),
        value_class(numbers > 1).alias("value_class"),
    )


def privacy_gate(df: DataFrame, columns: tuple[str, ...], forbidden: tuple[str, ...]) -> DataFrame:
    """column_name, passed and reason of candidate columns: a forbidden name fails, and so does a column with personal data
    in any value (all are looked at, in one pass; the first class in the contract's order is the reason)."""
    open_ = [c for c in columns if c not in forbidden]
    one = df.agg(F.lit(1).alias("one"), *[F.bool_or(has_pii(F.col(c), k)).alias(f"{c}__{k}") for c in open_ for k in C.FLAGS])
    found = lambda c: F.coalesce(*[F.when(F.col(f"{c}__{k}"), F.lit(f"sensitive_pattern:{k}")) for k in C.FLAGS])
    reason = lambda c: found(c) if c in open_ else F.lit("forbidden_raw_column")
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), reason(c).alias("reason")) for c in columns])).alias("x")
    return one.select(rows).select("x.column_name", F.col("x.reason").isNull().alias("passed"), "x.reason")


def promotion_level(density: Column, distinct: Column, numeric: Column, cycles: Column, private: Column) -> Column:
    return (
        F.when((density < 0.2) | (cycles < 3) | private, "none")
        .when((distinct <= 20) & (density > 0.7) & ~numeric, "macro_dimension")
        .when(numeric, "gold_passthrough")
        .when((distinct > 100) & (density > 0.5), "silver")
        .otherwise("bronze_optional")
    )


def promotion_confidence(cycles: Column, typed: Column, fit: Column, private: Column) -> Column:
    flag = lambda c: c.cast("int")
    score = 0.4 * F.least(F.lit(1.0), cycles / 5) + 0.2 * flag(typed) + 0.2 * fit + 0.2 * flag(~private)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4)


#: Absences in a row after which a column is forgotten, and mismatches in a row that are counted. Fixed values.
PRUNE_CYCLES, MISMATCHES = 20, 5


def observation_runs(log: DataFrame, last_cycle: Column | None = None) -> DataFrame:
    """Of a log (cycle, column_name, dtype, drift_class; one row at most per cycle and column): the length of each column's
    latest run of cycles in which it was seen with the same type and class, the cycle it was seen last, the cycles that it
    has been absent for since, and type mismatches in a row up to then.

    A run goes over cycles without the column, but PRUNE_CYCLES of them in a row end it, and a column that has been absent for
    so long by the last cycle (of the log, if none is given) is dropped. The log is laid on a dense grid of cycles by column;
    it is small, a row per column and cycle."""
    c = F.col
    until = log.agg((last_cycle if last_cycle is not None else F.max("cycle")).alias("until"))
    first = log.groupBy("column_name").agg(F.min("cycle").alias("since")).join(F.broadcast(until))  # until is one row
    grid = first.select("column_name", "until", F.explode(F.sequence("since", "until")).alias("cycle"))
    d = grid.join(log.withColumn("seen", F.lit(True)), ["column_name", "cycle"], "left")
    order = Window.partitionBy("column_name").orderBy("cycle")
    past, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    kind = F.when(c("seen"), F.struct("dtype", "drift_class"))
    d = d.withColumns({"was": F.last(kind, True).over(past), "was_at": F.last(F.when(c("seen"), c("cycle")), True).over(past)})
    new = c("seen") & (c("was").isNull() | ~c("was").eqNullSafe(kind) | (c("cycle") - c("was_at") > PRUNE_CYCLES))
    fits = c("seen") & ~c("drift_class").eqNullSafe(F.lit("type_mismatch"))
    d = d.withColumns({"run": F.sum(F.coalesce(new, F.lit(False)).cast("int")).over(so_far), "fits": F.sum(F.coalesce(fits, F.lit(False)).cast("int")).over(so_far)})
    whole = Window.partitionBy("column_name")
    d = d.withColumns({"last_run": F.max("run").over(whole), "last_fit": F.max("fits").over(whole)})
    sized = d.filter("seen").groupBy("column_name").agg(
        F.count_if(c("run") == c("last_run")).alias("cycles"),
        F.max("cycle").alias("last_cycle"),
        (F.max("until") - F.max("cycle")).cast("long").alias("absent_cycles"),
        F.least(F.lit(MISMATCHES).cast("long"), F.count_if((c("fits") == c("last_fit")) & (c("drift_class") == "type_mismatch"))).alias("mismatches"),
        F.max_by("dtype", "cycle").alias("dtype"),
        F.max_by("drift_class", "cycle").alias("drift_class"),
    )
    return sized.filter(c("absent_cycles") < PRUNE_CYCLES)


def suppressed_alerts(log: DataFrame, minutes: int = 30, hours: int = 24) -> DataFrame:
    """log (dedupe_key, run_at, id) with suppressed: an alert with the same key came at most so long before.

    A key's alerts are cut into ranges of so many hours, so that a frequent key is spread over many tasks; the alerts of a
    range's last minutes are shown to the next range too, where they only serve to look back at."""
    second = F.unix_micros(F.col("run_at").cast("timestamp")) / 1_000_000
    at = lambda later: F.floor((second + later) / (hours * 3600))
    ranges = F.when(F.col("run_at").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.array_distinct(F.array(at(0), at(60 * minutes))))
    d = log.withColumn("__first", at(0)).withColumn("__range", F.explode(ranges))
    before = F.lag("run_at").over(Window.partitionBy("dedupe_key", "__range").orderBy("run_at", "id"))
    d = d.withColumn("suppressed", F.coalesce(F.timestamp_diff("SECOND", before, F.col("run_at")) <= 60 * minutes, F.lit(False)))
    return d.filter(F.col("__range").eqNullSafe(F.col("__first"))).drop("__range", "__first")


def decision_metrics(log: DataFrame) -> DataFrame:
    """Of a decision log (family, decision, duration): counts, rates (four places) and upper median duration."""
    n = lambda d: F.count_if(F.col("decision") == d)
    return log.groupBy("family").agg(
        F.count("*").alias("proposals"),
        n("promoted").alias("promotions"),
        n("rolled_back").alias("rollbacks"),
        F.round(n("promoted") / F.count("*"), 4).alias("promotion_rate"),
        F.expr("-percentile_disc(0.5) WITHIN GROUP (ORDER BY -duration)").alias("median_duration"),
    )
