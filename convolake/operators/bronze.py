"""Bronze: metadata, categories, quarantine and profile of raw messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.operators.common import smallest


def valid_json(c: Column) -> Column:
    """Whether a string is one JSON value (of any kind) and nothing else. Repeated keys are valid, the last one wins,
    where spark.sql.variant.allowDuplicateKeys is on (the sources turn it on)."""
    wrapped = F.concat(F.lit("["), c, F.lit("]"))
    return F.coalesce((F.trim(c) != "") & F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 1), F.lit(False))


def parse_metadata(df: DataFrame, accepted: bool = False) -> DataFrame:
    """The metadata JSON as typed columns: absent strings are empty, and null where the JSON is invalid. Of rows that
    quarantine() accepted it is known to be valid, and not looked at again for that."""
    ok = F.lit(True) if accepted else valid_json(F.col("metadata"))
    v = F.try_parse_json(F.when(ok, F.col("metadata")))
    text = lambda k: F.when(ok, F.coalesce(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")))
    return df.withColumns(
        {
            **{f"metadata_{k}": text(k) for k in ("device", "city", "state", "lead_source")},
            "metadata_response_time_sec": F.try_variant_get(v, "$.response_time_sec", "long"),
            "metadata_is_business_hours": F.try_variant_get(v, "$.is_business_hours", "boolean"),
        }
    ).drop("metadata")


def snake_case(c: Column) -> Column:
    """Lower-case words with underscores between, as keys are named."""
    split = F.regexp_replace(F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2"), "[^A-Za-z0-9]+", "_")
    return F.lower(F.regexp_replace(split, "^_+|_+$", ""))


def cast_categories(df: DataFrame, domains: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Values outside their domain become null."""
    domains = domains or C.DOMAINS | {"conversation_outcome": C.OUTCOMES}
    return df.withColumns({c: F.when(F.col(c).isin(*d), F.col(c)) for c, d in domains.items() if c in df.columns})


def required_columns(df: DataFrame, required=C.REQUIRED_COLUMNS) -> DataFrame:
    """One row: number of rows, and required columns that are missing."""
    missing = [c for c in required if c not in df.columns]
    return df.agg(F.count("*").alias("row_count")).select("row_count", F.lit(",".join(missing)).alias("missing_columns"), F.lit(not missing).alias("schema_ok"))


def metadata_keys(df: DataFrame) -> DataFrame:
    """Distinct top-level keys of the metadata objects."""
    ok = F.when(valid_json(F.col("metadata")), F.col("metadata"))
    return df.select(F.explode(F.json_object_keys(ok)).alias("key")).distinct()


def quarantine_reason(timestamps: bool = True, metadata: bool = True) -> Column:
    """Why a row is rejected, empty where it is not; each rule can be off."""
    return F.concat_ws(
        "|",
        F.when(F.lit(timestamps) & F.col("timestamp").isNull(), F.lit("invalid_timestamp")),
        F.when(F.lit(metadata) & ~valid_json(F.col("metadata")), F.lit("invalid_metadata")),
    )


def quarantine(df: DataFrame, timestamps: bool = True, metadata: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows that go on, and rejected rows with their reason."""
    d = df.withColumn("quarantine_reason", quarantine_reason(timestamps, metadata))
    return d.filter("quarantine_reason = ''").drop("quarantine_reason"), d.filter("quarantine_reason <> ''")


def _quarantine_counts() -> list[Column]:
    reason = F.col("quarantine_reason")
    return [
        F.count("*").alias("rows"),
        F.count_if(reason.contains("invalid_timestamp")).alias("invalid_timestamp"),
        F.count_if(reason.contains("invalid_metadata")).alias("invalid_metadata"),
        F.count_if(reason != "").alias("quarantined"),
    ]


def quarantine_counts(df: DataFrame, timestamps: bool = True, metadata: bool = True) -> DataFrame:
    """One row: rows, rows of each reason (a rule that is off counts none), rejected rows."""
    return df.withColumn("quarantine_reason", quarantine_reason(timestamps, metadata)).agg(*_quarantine_counts())


def quarantine_write(df: DataFrame, path: str, timestamps: bool = True, metadata: bool = True) -> DataFrame:
    """Writes all rows in one pass, accepted ones below path/quarantined=false and rejected ones (with their reason) below
    path/quarantined=true, and returns the report (one row, as quarantine_counts()) that was counted on the way."""
    told = Observation()
    d = df.withColumn("quarantine_reason", quarantine_reason(timestamps, metadata)).observe(told, *_quarantine_counts())
    d.withColumn("quarantined", F.col("quarantine_reason") != "").write.mode("overwrite").partitionBy("quarantined").parquet(path)
    names = ("rows", "invalid_timestamp", "invalid_metadata", "quarantined")
    return df.sparkSession.createDataFrame([tuple(int(told.get[n]) for n in names)], ", ".join(f"{n} long" for n in names))


def quarantine_read(spark: SparkSession, path: str, schema: str, quarantined: bool) -> DataFrame:
    """The rows of one side; only its files are read."""
    d = spark.read.schema(f"{schema}, quarantine_reason string, quarantined boolean").parquet(path)
    return d.filter(F.col("quarantined") == quarantined).drop("quarantined", *([] if quarantined else ["quarantine_reason"]))


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, conversations, nulls per column, length of bodies."""
    size = F.length("message_body")
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct("conversation_id").alias("conversations"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns],
        F.min(size).alias("body_min"),
        F.avg(size).alias("body_mean"),
        F.percentile(size, F.lit(0.95)).alias("body_p95"),
        F.max(size).alias("body_max"),
    )


#: Columns whose most frequent values a profile shows. Fixed values.
PROFILED = ("direction", "message_type", "status", "channel", "conversation_outcome")


def profile_values(df: DataFrame, columns: tuple[str, ...] = PROFILED, n: int = 10) -> DataFrame:
    """column_name, value, rows and rank of the n most frequent values of each column (nulls are a value; equals go by
    value), from one scan: grouping sets count all columns at once, and ranks are limited before the shuffle by column."""
    some = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = some.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(F.grouping_id().alias("set"), F.count("*").alias("rows"))
    # in the grouping id the first column is the highest bit, and a column's bit is 0 in its own set
    full, k = (1 << len(columns)) - 1, len(columns)
    mine = [F.col("set") == full - (1 << (k - 1 - i)) for i in range(k)]
    name = F.coalesce(*[F.when(m, F.lit(c)) for m, c in zip(mine, columns, strict=True)])
    value = F.coalesce(*[F.when(m, F.col(c)) for m, c in zip(mine, columns, strict=True)])
    d = counted.select(name.alias("column_name"), value.alias("value"), "rows")
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("rows"), F.asc_nulls_last("value")))
    return d.withColumn("rank", rank).filter(F.col("rank") <= n)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).count().orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(n)


def drift_columns(spark: SparkSession, columns: list[str], required=C.REQUIRED_COLUMNS, optional: tuple[str, ...] = ()) -> DataFrame:
    """Columns that are missing, optional or unknown. (As many rows as columns.)"""
    rows = [(c, "missing_required") for c in required if c not in columns]
    rows += [(c, "optional_known" if c in optional else "unknown") for c in columns if c not in required]
    return spark.createDataFrame(rows, "column_name string, drift_class string")


def drift_metadata_keys(df: DataFrame, known=C.METADATA_FIELDS) -> DataFrame:
    return metadata_keys(df).filter(~F.col("key").isin(*known)).select(F.col("key").alias("column_name"), F.lit("unknown_metadata_key").alias("drift_class"))


def category_values(df: DataFrame, domains=C.DOMAINS) -> DataFrame:
    """column_name, value and rows of each value of the domain columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in domains if c in df.columns]))
    return df.select(pairs.alias("p")).select("p.*").filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count("*").alias("rows"))


def drift_categories(df: DataFrame, domains=C.DOMAINS, samples: int = 10, width: int = 32) -> DataFrame:
    """Per column: rows with values outside the domain, and up to ten of them (cut to 32 characters)."""
    known = reduce(lambda a, b: a | b, [(F.col("column_name") == c) & F.col("value").isin(*d) for c, d in domains.items()])
    out = category_values(df, domains).filter(~known).withColumn("value", F.substring("value", 1, width))
    return out.groupBy("column_name").agg(F.sum("rows").alias("row_count")).join(smallest(out, "column_name", "value", samples), "column_name")


def drift_types(spark: SparkSession, df: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
    expected = expected or {c: "timestamp" if c == "timestamp" else "string" for c in C.REQUIRED_COLUMNS}
    rows = [(c, expected[c], t) for c, t in df.dtypes if c in expected and t != expected[c]]
    return spark.createDataFrame(rows, "column_name string, expected string, observed string")


#: Policies by drift class, and their severity. Fixed values.
POLICY = {"missing_required": "block", "unknown": "passthrough_with_alert", "optional_known": "passthrough_with_alert", "unknown_metadata_key": "passthrough_with_alert", "type_mismatch": "quarantine", "category_drift": "quarantine"}
SEVERITY = {"silent": 0, "passthrough_with_alert": 1, "quarantine": 2, "block": 3}


def drift_policy(events: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """events with policy: an override of the column, else that of the class."""
    by_class = F.create_map(*[F.lit(x) for kv in POLICY.items() for x in kv])
    policy = by_class[F.col("drift_class")]
    if overrides:
        policy = F.coalesce(F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])[F.col("column_name")], policy)
    return events.withColumn("policy", policy)


def drift_events(df: DataFrame) -> DataFrame:
    """Column, key and category events of a message table."""
    spark = df.sparkSession
    categories = drift_categories(df).select("column_name", F.lit("category_drift").alias("drift_class"))
    return drift_policy(drift_columns(spark, df.columns).unionByName(drift_metadata_keys(df)).unionByName(categories))


def drift_report(events: DataFrame) -> DataFrame:
    """Events per class, classes without any included, with the gravest policy."""
    level = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    classes = events.sparkSession.createDataFrame([(c,) for c in POLICY], "drift_class string")
    got = events.groupBy("drift_class").agg(F.count("*").alias("n"), F.max_by("policy", level[F.col("policy")]).alias("policy"))
    return classes.join(got, "drift_class", "left").select("drift_class", F.coalesce("n", F.lit(0)).alias("events"), F.coalesce("policy", F.lit("silent")).alias("policy"))


def validation_report(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """drift_report() of a message table, with schema_ok: false on every row where any event blocks."""
    report = drift_report(drift_policy(drift_events(df).drop("policy"), overrides))
    blocked = report.agg(F.coalesce(F.bool_or(F.col("policy") == "block"), F.lit(False)).alias("blocked"))
    return report.join(F.broadcast(blocked)).withColumn("schema_ok", ~F.col("blocked")).drop("blocked")  # blocked is one row


def passthrough_names(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Unknown columns get the passthrough prefix."""
    known = {*C.REQUIRED_COLUMNS, *keep}
    return df.withColumnsRenamed({c: C.PASSTHROUGH + c for c in df.columns if c not in known and not c.startswith((C.PASSTHROUGH, "metadata_"))})
