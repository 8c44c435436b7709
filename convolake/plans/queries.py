"""The registered queries over the message table, each with the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions import text as T
from convolake.functions.signals import tone_hits, with_directional_defaults
from convolake.operators import audit as A
from convolake.operators import bronze as B
from convolake.operators import change as D
from convolake.operators import checks as Q
from convolake.operators import conversations as V
from convolake.operators import enrichment as N
from convolake.operators import gold as G
from convolake.operators import publication as P
from convolake.operators import silver as S
from convolake.operators.common import bounded_sample
from convolake.plans.columns import Aggregate, Alias, Bucket, apply_columns, condition, row_sample, schema_sample
from convolake.plans.oracle import AUDIENCE, sql
from convolake.plans.oracle import MASKED as MASKED_SQL
from convolake.plans.oracle import PII as PII_SQL
from convolake.plans.oracle import UNMASKED as UNMASKED_SQL
from convolake.sources.messages import fixture_messages, message_ids, publish, read_bronze, read_parquet, read_report, scratch_folder, write_parquet, write_report
from convolake.streaming.refresh import replay_idle, replay_ingest, replay_late, replay_refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, query: Query, oracle: str | None = None) -> None:
    QUERIES[name] = query
    if oracle is not None:
        SQL[name] = sql(oracle)


# --- layers -----------------------------------------------------------------------------------------------------------
def bronze(spark, d):
    return fixture_messages(spark, d)


def parsed(spark, d):
    return B.parse_metadata(bronze(spark, d))


def held(df: DataFrame, name: str) -> DataFrame:
    """df as a table that further steps read, instead of working it out anew for each."""
    at = scratch_folder(df.sparkSession, name)
    write_parquet(df, at)
    return read_parquet(df.sparkSession, at, df.schema)


def silver(spark, d):
    return S.silver_messages(bronze(spark, d))


def stored(spark, d, *columns: str) -> DataFrame:
    """Silver messages as a table of these columns alone: what nobody asks for (masks, for one) is not made."""
    return held(silver(spark, d).select(*dict.fromkeys(columns)), "silver")


def leads(spark, d):
    return S.silver_leads(stored(spark, d, *S.LEAD_COLUMNS))


def flat(df: DataFrame) -> DataFrame:
    """Array columns as joined text."""
    return df.withColumns({c: F.array_join(c, ",") for c, t in df.dtypes if t == "array<string>"})


def gold(spark, d):
    """Only what gold reads of silver is made and stored: masks, for one, are not."""
    m = stored(spark, d, *S.LEAD_COLUMNS, *G.MESSAGE_COLUMNS)
    return G.gold_leads(S.silver_leads(m), m)


def semantics(spark, d):
    return held(V.conversation_semantics(V.conversation_features(silver(spark, d))), "semantics")


def texts(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")


LAYER = {"bronze": bronze, "parsed": parsed, "silver": silver, "leads": leads, "gold": gold, "semantics": semantics}
KEY = {"bronze": "message_id", "parsed": "message_id", "silver": "message_id", "leads": "lead_key", "gold": "lead_key", "semantics": "conversation_id"}


def columns_of(name: str, layer: str, *cols: str) -> None:
    """A query of some columns of a layer, with its key."""
    wanted = (KEY[layer], *cols)
    add(name, lambda spark, d: flat(LAYER[layer](spark, d).select(*wanted)), f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in wanted)} FROM {layer}")


# --- sources ------------------------------------------------------------------------------------------------------------


def _stored(s, d):
    at = scratch_folder(s, "source")
    write_parquet(bronze(s, d), at)
    return at


def _loose(s, d):
    """A table whose timestamps are text, some of it none."""
    at = scratch_folder(s, "loose")
    bad = F.when(F.substring("message_id", 12, 1) == "6", "30/02/2024 x").otherwise(F.col("timestamp").cast("string"))
    write_parquet(bronze(s, d).withColumn("timestamp", bad), at)
    return at


add("src_parquet", lambda s, d: read_parquet(s, _stored(s, d), C.BRONZE_SCHEMA), "SELECT * FROM bronze")
add("src_bronze", lambda s, d: read_bronze(s, _loose(s, d)).select("message_id", "conversation_id", "timestamp", "direction", "message_body"), """SELECT message_id, conversation_id, CASE WHEN substr(message_id, 12, 1) <> '6' THEN "timestamp" END AS "timestamp", direction, message_body FROM bronze""")
add("src_ids", lambda s, d: message_ids(bronze(s, d)), "SELECT DISTINCT message_id FROM bronze")
def _quarantined(s, d):
    at = scratch_folder(s, "quarantine")
    report = B.quarantine_write(bronze(s, d), at)
    return at, report


add("snk_quarantine", lambda s, d: B.quarantine_read(s, _quarantined(s, d)[0], C.BRONZE_SCHEMA, True).select("message_id", "quarantine_reason"),
    """SELECT message_id, concat_ws('|', CASE WHEN "timestamp" IS NULL THEN 'invalid_timestamp' END, CASE WHEN NOT json_ok THEN 'invalid_metadata' END) AS quarantine_reason FROM parsed WHERE "timestamp" IS NULL OR NOT json_ok""")  # fmt: skip


def _quarantine_report(s, d):
    """The counts taken while writing, beside those of the files."""
    at, report = _quarantined(s, d)
    count = lambda side, name: B.quarantine_read(s, at, C.BRONZE_SCHEMA, side).agg(F.count("*").alias(name))
    return report.join(count(True, "rejected_read")).join(count(False, "accepted_read"))  # one row each


add("snk_quarantine_report", _quarantine_report, """SELECT count(*) AS rows, count(*) FILTER ("timestamp" IS NULL) AS invalid_timestamp, count(*) FILTER (NOT json_ok) AS invalid_metadata, count(*) FILTER ("timestamp" IS NULL OR NOT json_ok) AS quarantined,
    count(*) FILTER ("timestamp" IS NULL OR NOT json_ok) AS rejected_read, count(*) FILTER ("timestamp" IS NOT NULL AND json_ok) AS accepted_read FROM parsed""")  # fmt: skip


def _through_parquet(s, d):
    at = scratch_folder(s, "parquet")
    write_parquet(parsed(s, d).select("message_id", "metadata_city"), at)
    return read_parquet(s, at)


def _through_json(s, d):
    at = scratch_folder(s, "report")
    write_report(B.quarantine_counts(bronze(s, d)), at)
    return read_report(s, at)


def _published(s, d):
    """Beside the layers only the messages are stored, with the two private columns that leads and gold are made of."""
    m = stored(s, d, *P.sanitize(silver(s, d)).columns, *S.LEAD_COLUMNS, *G.MESSAGE_COLUMNS, *V.MESSAGE_COLUMNS)
    layers = {
        "bronze": bronze(s, d),
        "silver_messages": P.sanitize(m),
        "silver_leads": S.silver_leads(m),
        "conversations": V.conversation_features(m).drop("messages"),  # silver_messages has them
        "gold": lambda done: G.public_gold(G.gold_leads(done["silver_leads"], m)),
        "gold_macro": lambda done: G.gold_macro(done["gold"]),
    }
    at = publish(layers, scratch_folder(s, "layers"), lambda done: Q.gold_key_checks(done["gold"]))
    read = [s.read.parquet(path).select(F.lit(name).alias("layer"), F.col(PUBLISHED[name]).alias("key")) for name, path in at.items()]
    return reduce(DataFrame.unionByName, read).groupBy("layer").agg(F.count("*").alias("rows"), F.count_distinct("key").alias("keys"), F.min("key").alias("first"), F.max("key").alias("last"))


PUBLISHED = {"bronze": "message_id", "silver_messages": "message_id", "silver_leads": "lead_key", "conversations": "conversation_id", "gold": "lead_key", "gold_macro": "dimension_value"}
add("snk_parquet", _through_parquet, "SELECT message_id, metadata_city FROM parsed")
add("snk_report_json", _through_json, """SELECT count(*) AS rows, count(*) FILTER ("timestamp" IS NULL) AS invalid_timestamp, count(*) FILTER (NOT json_ok) AS invalid_metadata, count(*) FILTER ("timestamp" IS NULL OR NOT json_ok) AS quarantined FROM parsed""")
_layer_sql = {"bronze": "bronze", "silver_messages": "silver", "silver_leads": "leads", "conversations": "features", "gold": "gold"}
_counted = lambda layer, table: f"SELECT '{layer}' AS layer, count(*) AS rows, count(DISTINCT {PUBLISHED[layer]}) AS keys, min({PUBLISHED[layer]}) AS first, max({PUBLISHED[layer]}) AS last FROM {table}"
# --- bronze -------------------------------------------------------------------------------------------------------------
META = ("metadata_device", "metadata_city", "metadata_state", "metadata_lead_source", "metadata_response_time_sec", "metadata_is_business_hours")
columns_of("brz_parse_metadata", "parsed", *META)
_cast = lambda c, v: f"CASE WHEN {c} IN ({', '.join(repr(x) for x in v)}) THEN {c} END AS {c}"
_domains = C.DOMAINS | {"conversation_outcome": C.OUTCOMES}
add("brz_cast_categories", lambda s, d: B.cast_categories(bronze(s, d)).select("message_id", *_domains), f"SELECT message_id, {', '.join(_cast(c, v) for c, v in _domains.items())} FROM bronze")
add("brz_required_columns", lambda s, d: B.required_columns(bronze(s, d)).unionByName(B.required_columns(bronze(s, d).filter("direction = 'inbound'").drop("status", "channel"))), "SELECT count(*) AS row_count, '' AS missing_columns, TRUE AS schema_ok FROM bronze UNION ALL SELECT count(*), 'status,channel', FALSE FROM bronze WHERE direction = 'inbound'")
add("brz_metadata_keys", lambda s, d: B.metadata_keys(bronze(s, d)), "SELECT DISTINCT unnest(json_keys(CASE WHEN json_valid(metadata) THEN metadata END)) AS key FROM bronze")
add("brz_build", lambda s, d: B.cast_categories(parsed(s, d)).select("message_id", *_domains, *META), f"SELECT message_id, {', '.join(_cast(c, v) for c, v in _domains.items())}, {', '.join(META)} FROM parsed")
add("brz_validation_report", lambda s, d: B.validation_report(bronze(s, d), {"leadScore": "block"}), """SELECT *, NOT coalesce(bool_or(policy = 'block') OVER (), FALSE) AS schema_ok FROM (SELECT c AS drift_class, CASE c WHEN 'unknown_metadata_key' THEN (SELECT count(DISTINCT k) FROM (SELECT unnest(json_keys(CASE WHEN json_valid(metadata) THEN metadata END)) AS k FROM bronze) WHERE k NOT IN ('device', 'city', 'state', 'response_time_sec', 'is_business_hours', 'lead_source'))
  WHEN 'category_drift' THEN (SELECT count(*) FROM (SELECT 1 FROM bronze WHERE message_type = 'video' LIMIT 1)) ELSE 0 END AS events, CASE c WHEN 'unknown_metadata_key' THEN 'block' WHEN 'category_drift' THEN 'quarantine' ELSE 'silent' END AS policy
  FROM (VALUES ('missing_required'), ('unknown'), ('optional_known'), ('unknown_metadata_key'), ('type_mismatch'), ('category_drift')) t(c))""")  # fmt: skip
def _toggled(s, d):
    """The report under each setting of the two rules."""
    m = bronze(s, d)
    each = [B.quarantine_counts(m, t, j).select(F.lit(t).alias("timestamps"), F.lit(j).alias("metadata"), "*") for t in (True, False) for j in (True, False)]
    return reduce(DataFrame.unionByName, each)


add("brz_quarantine", _toggled, """SELECT t AS timestamps, j AS metadata, count(*) AS rows, count(*) FILTER (t AND "timestamp" IS NULL) AS invalid_timestamp, count(*) FILTER (j AND NOT json_ok) AS invalid_metadata,
    count(*) FILTER ((t AND "timestamp" IS NULL) OR (j AND NOT json_ok)) AS quarantined FROM parsed, (VALUES (TRUE, TRUE), (TRUE, FALSE), (FALSE, TRUE), (FALSE, FALSE)) v(t, j) GROUP BY t, j""")  # fmt: skip
add("brz_valid_json", lambda s, d: bronze(s, d).select("message_id", B.valid_json(F.col("metadata")).alias("valid")), "SELECT message_id, json_ok AS valid FROM parsed")
add("brz_profile", lambda s, d: B.profile(bronze(s, d)), f"""SELECT count(*) AS rows, count(DISTINCT conversation_id) AS conversations, {', '.join(f'count(*) FILTER ("{c}" IS NULL) AS null_{c}' for c in C.REQUIRED_COLUMNS)}, min(length(message_body)) AS body_min, avg(length(message_body)) AS body_mean, quantile_cont(length(message_body), 0.95) AS body_p95, max(length(message_body)) AS body_max FROM bronze""")
add("brz_profile_values", lambda s, d: B.profile_values(bronze(s, d)), f"""SELECT column_name, value, rows, rank FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, value NULLS LAST) AS rank FROM (
    SELECT CASE {' '.join(f"WHEN GROUPING({c}) = 0 THEN '{c}'" for c in B.PROFILED)} END AS column_name, CASE {' '.join(f"WHEN GROUPING({c}) = 0 THEN {c}" for c in B.PROFILED)} END AS value, count(*) AS rows
    FROM bronze GROUP BY GROUPING SETS ({', '.join(f"({c})" for c in B.PROFILED)}))) WHERE rank <= 10""")  # fmt: skip
# --- schema evolution -----------------------------------------------------------------------------------------------------
add("drift_columns", lambda s, d: B.drift_columns(s, bronze(s, d).withColumns({"extra": F.lit("x")}).drop("status").columns).join(bronze(s, d).agg(F.count("*").alias("rows"))), "SELECT column_name, drift_class, (SELECT count(*) FROM bronze) AS rows FROM (VALUES ('status', 'missing_required'), ('extra', 'unknown')) t(column_name, drift_class)")
add("drift_metadata_keys", lambda s, d: B.drift_metadata_keys(bronze(s, d)), "SELECT DISTINCT k AS column_name, 'unknown_metadata_key' AS drift_class FROM (SELECT unnest(json_keys(CASE WHEN json_valid(metadata) THEN metadata END)) AS k FROM bronze) WHERE k NOT IN ('device', 'city', 'state', 'response_time_sec', 'is_business_hours', 'lead_source')")
_known_keys = ", ".join(repr(k) for k in C.METADATA_FIELDS)
_pairs_sql = "(SELECT metadata, unnest(json_keys(metadata)) AS k FROM bronze WHERE json_valid(metadata))"
_new_keys = f"(SELECT DISTINCT k FROM {_pairs_sql} WHERE k NOT IN ({_known_keys}))"
_beyond = "(" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, substr({c}, 1, 32) AS v, count(*) AS n FROM bronze WHERE {c} IS NOT NULL AND {c} NOT IN ({', '.join(repr(x) for x in d)}) GROUP BY 2" for c, d in C.DOMAINS.items()) + ")"
_events = lambda category: f"SELECT k AS column_name, 'unknown_metadata_key' AS drift_class, 'passthrough_with_alert' AS policy FROM {_new_keys} UNION ALL SELECT DISTINCT column_name, 'category_drift', {category} FROM {_beyond}"
_snake = lambda k: f"lower(trim(regexp_replace(regexp_replace({k}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '[^A-Za-z0-9]+', '_', 'g'), '_'))"
add("drift_categories", lambda s, d: B.drift_categories(bronze(s, d)), f"SELECT column_name, CAST(sum(n) AS BIGINT) AS row_count, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT v FROM {_beyond} y WHERE y.column_name = x.column_name ORDER BY v LIMIT 10)) AS samples FROM {_beyond} x GROUP BY column_name")
add("drift_types", lambda s, d: B.drift_types(s, bronze(s, d).withColumn("timestamp", F.col("timestamp").cast("string"))).join(bronze(s, d).agg(F.count("timestamp").alias("rows"))), """SELECT 'timestamp' AS column_name, 'timestamp' AS expected, 'string' AS observed, count("timestamp") AS rows FROM bronze""")
add("drift_policy", lambda s, d: B.drift_policy(B.drift_events(bronze(s, d)), {"message_type": "block"}), _events("CASE WHEN column_name = 'message_type' THEN 'block' ELSE 'quarantine' END"))
add("drift_detect", lambda s, d: B.drift_events(bronze(s, d)), _events("'quarantine'"))
add("drift_passthrough_rename", lambda s, d: B.passthrough_names(bronze(s, d).select("message_id", F.upper("channel").alias("region"))), "SELECT message_id, upper(channel) AS bronze_passthrough__region FROM bronze")
add("drift_gold_partition", lambda s, d: G.public_gold(gold(s, d).withColumn(f"{C.PASSTHROUGH}x", F.lit(1))).select("lead_key", "total_messages", "intent_stage"), "SELECT lead_key, total_messages, intent_stage FROM gold")
_extra = lambda s, d: gold(s, d).withColumns({f"{C.PASSTHROUGH}region": F.nullif("city", F.lit("Recife")), f"{C.PASSTHROUGH}score": F.lit(1), f"{C.PASSTHROUGH}kept": F.lit(2)})
add("drift_gold_events", lambda s, d: G.partition_events(_extra(s, d), ("kept",)), f"""SELECT '{C.PASSTHROUGH}region' AS column_name, 'unknown' AS drift_class, 'passthrough_with_alert' AS policy, 'not_in_gold_contract' AS reason, count(*) FILTER (city <> 'Recife') AS filled_rows FROM gold
    UNION ALL SELECT '{C.PASSTHROUGH}score', 'unknown', 'passthrough_with_alert', 'not_in_gold_contract', count(*) FROM gold""")  # fmt: skip
add("drift_extra_agg", lambda s, d: S.extra_aggregates(silver(s, d), {"status": "first_non_null", "agent_id": "last_non_null", "message_length": "max", "word_count": "mean", "duplicate_event_group_size": "sum", "is_empty_message": "any", "is_inbound": "all", "message_type": "mode"}),
    """SELECT lead_key, first(status ORDER BY conversation_id, "timestamp", message_id) AS status_first_non_null, last(agent_id ORDER BY conversation_id, "timestamp", message_id) AS agent_id_last_non_null, max(message_length) AS message_length_max, avg(word_count) AS word_count_mean,
    CAST(sum(duplicate_event_group_size) AS BIGINT) AS duplicate_event_group_size_sum, bool_or(is_empty_message) AS is_empty_message_any, bool_and(is_inbound) AS is_inbound_all,
    (SELECT message_type FROM (SELECT s2.message_type, count(*) AS n FROM silver s2 WHERE s2.lead_key = s.lead_key GROUP BY 1) ORDER BY n DESC, message_type LIMIT 1) AS message_type_mode FROM silver s GROUP BY lead_key""")  # fmt: skip
CANDIDATES = ("agent_id", "campaign_id", "message_body")
PROMOTED = (*CANDIDATES, "response")
_numbered = lambda s, d: parsed(s, d).withColumn("response", F.col("metadata_response_time_sec").cast("string"))
_numbered_sql = "(SELECT *, CAST(metadata_response_time_sec AS VARCHAR) AS response FROM parsed)"
_exact = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) / count(*) AS density, count(DISTINCT {c}) AS distinct_values, count(TRY_CAST({c} AS DOUBLE)) > 1 AS numeric, round(avg(TRY_CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(TRY_CAST({c} AS DOUBLE)), 6) AS std, CASE WHEN count(TRY_CAST({c} AS DOUBLE)) > 1 THEN 'numeric_continuous' ELSE 'categorical_text' END AS value_class FROM {_numbered_sql}" for c in PROMOTED)
add("drift_promotion_stats", lambda s, d: D.promotion_stats(_numbered(s, d), PROMOTED).withColumns({c: F.round(c, 6) for c in ("mean", "std")}), _exact)


def _by_cycles(s, d):
    """Sketches of three cycles (days 1 to 10, 11 to 20, later or unknown), stored as they come, merged without the rows."""
    m, at = _numbered(s, d), scratch_folder(s, "sketches")
    day = F.coalesce(F.dayofyear("timestamp"), F.lit(366))
    for cycle, (low, high) in enumerate(((1, 10), (11, 20), (21, 366))):
        D.column_sketches(m.filter(day.between(low, high)), PROMOTED, cycle).coalesce(1).write.mode("append").parquet(at)
    return D.sketched_stats(D.merged_sketches(s.read.schema(D.SKETCHES).parquet(at)))


add("drift_promotion_sketches", lambda s, d: _by_cycles(s, d).join(D.promotion_stats(_numbered(s, d), PROMOTED).select("column_name", F.col("distinct_values").alias("exact")), "column_name")
    .select("column_name", "density", "numeric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "value_class", (F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * 0.05).alias("within_5_pct")),
    f"SELECT column_name, density, numeric, mean, std, value_class, TRUE AS within_5_pct FROM ({_exact})")
_stats = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) / count(*) AS density, count(DISTINCT {c}) AS n FROM bronze" for c in CANDIDATES)
add("drift_promotion_level", lambda s, d: D.promotion_stats(bronze(s, d), CANDIDATES).select("column_name", D.promotion_level(F.col("density"), F.col("distinct_values"), F.col("numeric"), F.lit(5), F.col("column_name") == "message_body").alias("level")),
    f"SELECT column_name, CASE WHEN density < 0.2 OR column_name = 'message_body' THEN 'none' WHEN n <= 20 AND density > 0.7 THEN 'macro_dimension' WHEN n > 100 AND density > 0.5 THEN 'silver' ELSE 'bronze_optional' END AS level FROM ({_stats} )")
add("drift_promotion_confidence", lambda s, d: D.promotion_stats(bronze(s, d), CANDIDATES).select("column_name", D.promotion_confidence(F.lit(4), F.lit(True), (F.col("distinct_values") <= 20).cast("double"), F.col("column_name") == "message_body").alias("confidence")),
    f"SELECT column_name, round(0.4 * 0.8 + 0.2 + 0.2 * CAST(n <= 20 AS INT) + 0.2 * CAST(column_name <> 'message_body' AS INT), 4) AS confidence FROM ({_stats})")
def _observed(s, d):
    """A log in which a campaign's type changes on day 8, one's class on day 21; one is gone after day 9, one on days 5 to 27,
    one on days 12 to 14."""
    day, camp = F.dayofyear("timestamp"), F.substring("campaign_id", 1, 6)
    gone = ((camp == "camp_1") & (day > 9)) | ((camp == "camp_2") & day.between(5, 27)) | ((camp == "camp_4") & day.between(12, 14))
    log = bronze(s, d).filter("timestamp IS NOT NULL").filter(~gone).select(day.alias("cycle"), F.col("campaign_id").alias("column_name"), F.when(day < 8, "string").otherwise("double").alias("dtype"), F.when((camp == "camp_3") & (day > 20), "type_mismatch").otherwise("unknown").alias("drift_class"))
    return log.distinct()


_log = """SELECT DISTINCT CAST(dayofyear("timestamp") AS INT) AS cycle, campaign_id AS column_name, CASE WHEN dayofyear("timestamp") < 8 THEN 'string' ELSE 'double' END AS dtype, CASE WHEN campaign_id LIKE 'camp_3%' AND dayofyear("timestamp") > 20 THEN 'type_mismatch' ELSE 'unknown' END AS drift_class
    FROM bronze WHERE "timestamp" IS NOT NULL AND NOT (campaign_id LIKE 'camp_1%' AND dayofyear("timestamp") > 9 OR campaign_id LIKE 'camp_2%' AND dayofyear("timestamp") BETWEEN 5 AND 27 OR campaign_id LIKE 'camp_4%' AND dayofyear("timestamp") BETWEEN 12 AND 14)"""
add("drift_observation_history", lambda s, d: D.observation_runs(_observed(s, d)), f"""SELECT column_name, count(*) AS cycles, max(cycle) AS last_cycle, CAST(u - max(cycle) AS BIGINT) AS absent_cycles, least(5, count(*) FILTER (drift_class = 'type_mismatch')) AS mismatches, last(dtype ORDER BY cycle) AS dtype, last(drift_class ORDER BY cycle) AS drift_class
    FROM (SELECT *, max(run) OVER (PARTITION BY column_name) AS last_run FROM (SELECT *, sum(CAST(broken AS INT)) OVER (PARTITION BY column_name ORDER BY cycle) AS run FROM (
      SELECT *, (SELECT max(cycle) FROM ({_log})) AS u, coalesce(lag(cycle) OVER w <= cycle - 21 OR lag(dtype) OVER w <> dtype OR lag(drift_class) OVER w <> drift_class, TRUE) AS broken FROM ({_log}) WINDOW w AS (PARTITION BY column_name ORDER BY cycle))))
    WHERE run = last_run GROUP BY column_name, u HAVING u - max(cycle) < 20""")  # fmt: skip
_private = ("message_body", "agent_id", "sender_name", "campaign_id", "metadata")
add("drift_privacy_scan", lambda s, d: D.privacy_gate(bronze(s, d), _private, P.FORBIDDEN), f"""SELECT column_name, reason IS NULL AS passed, reason FROM (
    {' UNION ALL '.join(f"SELECT '{c}' AS column_name, 'forbidden_raw_column' AS reason" for c in _private if c in P.FORBIDDEN)} UNION ALL
    {' UNION ALL '.join(f"SELECT '{c}' AS column_name, CASE {' '.join(f'WHEN bool_or({p}) THEN {chr(39)}sensitive_pattern:{k}{chr(39)}' for k, p in PII_SQL.items())} END AS reason FROM (SELECT coalesce({c}, '') AS body FROM bronze)" for c in _private if c not in P.FORBIDDEN)})""")  # fmt: skip
# --- joins --------------------------------------------------------------------------------------------------------------
columns_of("join_gold_left", "gold", "city", "message_count", "total_messages", "vehicle_make", "vehicle_model", "vehicle_year", "primary_sinistro_type")
add("join_extra_left", lambda s, d: (lambda m: S.silver_leads(m).join(S.extra_aggregates(m, {"message_length": "max"}), "lead_key", "left").select("lead_key", "message_count", "message_length_max"))(stored(s, d, *S.LEAD_COLUMNS, "message_length")), "SELECT lead_key, message_count, message_length_max FROM leads LEFT JOIN (SELECT lead_key, max(message_length) AS message_length_max FROM silver GROUP BY lead_key) USING (lead_key)")


def gold_overlaid(s, d):
    m = stored(s, d, *S.LEAD_COLUMNS, *G.MESSAGE_COLUMNS, *V.MESSAGE_COLUMNS)
    conversations = held(V.conversation_semantics(V.conversation_features(m)), "semantics")
    return G.gold_leads(S.silver_leads(m), m, V.consolidate(conversations))


_overlay = f"""SELECT g.lead_key, coalesce(c.intent_stage, g.intent_stage) AS intent_stage, CASE WHEN bad THEN g.persona_profile ELSE c.persona_profile END AS persona_profile, CASE WHEN bad THEN g.audience_segment ELSE c.audience_segment END AS audience_segment,
  coalesce(c.conversation_sentiment_label, g.conversation_sentiment_label) AS conversation_sentiment_label, coalesce(c.conversation_sentiment_support, g.conversation_sentiment_support) AS conversation_sentiment_support, 'deterministic_fallback' AS intent_stage_source_family
  FROM gold g LEFT JOIN (SELECT *, {AUDIENCE("persona_profile")} <> audience_segment OR persona_profile IS NULL AS bad0 FROM consolidated) c USING (lead_key), LATERAL (SELECT coalesce(bad0, TRUE) AS bad)"""
for _n in ("join_semantics_left", "sem_gold_overlay"):
    add(_n, lambda s, d: gold_overlaid(s, d).select("lead_key", *G.SEMANTIC, "intent_stage_source_family"), _overlay)
add("join_anti_keys", lambda s, d: silver(s, d).filter("direction = 'inbound'").select("lead_key").distinct().join(silver(s, d).filter("mentions_competitor").select("lead_key").distinct(), "lead_key", "left_anti"), "SELECT DISTINCT lead_key FROM silver WHERE direction = 'inbound' AND lead_key NOT IN (SELECT lead_key FROM silver WHERE mentions_competitor)")
add("join_inner_reconcile", lambda s, d: (lambda m: S.silver_leads(m).select("lead_key", "message_count").join(m.groupBy("lead_key").agg(F.count("*").alias("rows")), "lead_key").select("lead_key", F.col("message_count").eqNullSafe(F.col("rows")).alias("same")))(stored(s, d, *S.LEAD_COLUMNS)), "SELECT lead_key, message_count = n AS same FROM leads JOIN (SELECT lead_key, count(*) AS n FROM silver GROUP BY 1) USING (lead_key)")


def _known(s, d):
    m = bronze(s, d).select("message_id")
    return m.filter("substr(message_id, 12, 1) <> '3'").unionByName(m.filter("substr(message_id, 12, 1) = '5'").select(F.concat(F.lit("old"), "message_id").alias("message_id")))


_known_sql = "(SELECT message_id FROM bronze WHERE substr(message_id, 12, 1) <> '3' UNION ALL SELECT 'old' || message_id FROM bronze WHERE substr(message_id, 12, 1) = '5')"
for _n in ("join_cdc_anti", "cdc_new_ids"):
    add(_n, lambda s, d: D.new_ids(bronze(s, d), _known(s, d)), f"SELECT DISTINCT message_id FROM bronze WHERE message_id NOT IN {_known_sql}")
add("cdc_missing_ids", lambda s, d: D.missing_ids(bronze(s, d), _known(s, d)), f"SELECT DISTINCT message_id FROM {_known_sql} WHERE message_id NOT IN (SELECT message_id FROM bronze)")
_hash = "CAST('0x' || substr(md5(message_id), 1, 15) AS BIGINT)"
add("cdc_fingerprint", lambda s, d: D.fingerprint(bronze(s, d)).withColumn("total", F.col("total").cast("string")), f"SELECT count(*) AS ids, bit_xor({_hash}) AS xor, CAST(sum({_hash}) AS VARCHAR) AS total FROM (SELECT DISTINCT message_id FROM bronze)")


def _watched(s, d):
    """Four runs over a source: the first, one over the same ids in another order and twice, one that lacks some, one in which
    an id has been exchanged for another."""
    m = bronze(s, d).select("message_id")
    most = m.filter("substr(message_id, 12, 1) <> '3'")
    other = most.withColumn("message_id", F.when(F.substring("message_id", 12, 1) == "5", F.concat(F.lit("old"), "message_id")).otherwise(F.col("message_id")))
    at = D.Fingerprints(s, scratch_folder(s, "fingerprints"))
    return reduce(DataFrame.unionByName, [at.observe(x) for x in (m, m.unionByName(m).orderBy(F.desc("message_id")), most, other)])


_n = lambda digit: f"(SELECT count(DISTINCT message_id) FROM bronze WHERE substr(message_id, 12, 1) = '{digit}')"
add("cdc_changed", _watched, f"""SELECT 0 AS run, TRUE AS changed, count(DISTINCT message_id) AS ids, count(DISTINCT message_id) AS added, TRUE AS xor_differs, TRUE AS total_differs FROM bronze
    UNION ALL SELECT 1, FALSE, count(DISTINCT message_id), 0, FALSE, FALSE FROM bronze
    UNION ALL SELECT 2, {_n(3)} > 0, count(DISTINCT message_id) - {_n(3)}, -{_n(3)}, {_n(3)} > 0, {_n(3)} > 0 FROM bronze
    UNION ALL SELECT 3, {_n(5)} > 0, count(DISTINCT message_id) - {_n(3)}, 0, {_n(5)} > 0, {_n(5)} > 0 FROM bronze""")  # fmt: skip


def _cached(s, d):
    x = semantics(s, d).withColumns({"input_hash": F.concat_ws(":", "message_count", "inbound_count"), "prompt_version": F.lit("v1"), "model": F.lit("m")})
    cache = x.filter("message_count % 2 = 0").select("conversation_id", "input_hash", "prompt_version", "model", F.lit("pesquisa_mercado").alias("intent_stage"))
    return V.reuse_cached(x, cache).select("conversation_id", "cache_hit", "intent_stage")


add("join_cache_lookup", _cached, "SELECT conversation_id, message_count % 2 = 0 AS cache_hit, CASE WHEN message_count % 2 = 0 THEN 'pesquisa_mercado' ELSE intent_stage END AS intent_stage FROM semantics")


def _before(s, d):
    return bronze(s, d).filter("timestamp < '2024-01-15'")


def _after(s, d):
    return bronze(s, d).filter("timestamp >= '2024-01-15' OR timestamp IS NULL").withColumn("message_type", F.when(F.col("message_type") == "text", F.when(F.col("direction") == "inbound", F.lit("image")).otherwise("text")).otherwise(F.col("message_type")))


COLS = ("message_type", "conversation_outcome", "channel")
_after_sql = """(SELECT * REPLACE (CASE WHEN message_type = 'text' AND direction = 'inbound' THEN 'image' ELSE message_type END AS message_type) FROM bronze WHERE "timestamp" >= '2024-01-15' OR "timestamp" IS NULL)"""
_before_sql = """(SELECT * FROM bronze WHERE "timestamp" < '2024-01-15')"""
_freq = lambda t: "(" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value, round(count(*) / sum(count(*)) OVER (), 6) AS freq FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}" for c in COLS) + ")"
_changes_sql = f"SELECT column_name, value, coalesce(b.freq, 0) AS before, coalesce(a.freq, 0) AS freq, round(coalesce(a.freq, 0) - coalesce(b.freq, 0), 6) AS diff FROM {_freq(_after_sql)} a FULL JOIN {_freq(_before_sql)} b USING (column_name, value)"
changes = lambda s, d: D.frequency_changes(D.frequencies(_after(s, d), COLS), D.frequencies(_before(s, d), COLS))
add("join_freq_outer", changes, _changes_sql)
PLAN = [Aggregate("prices", "quoted_price", "count"), Aggregate("longest", "message_length", "max"), Bucket("size", (("total_messages > 20", "big"), ("total_messages > 5", "mid")), "small"), Alias("town", "city"), Alias("absent", "nowhere")]
_planned_sql = "SELECT lead_key, total_messages, p.prices, p.longest, CASE WHEN total_messages > 20 THEN 'big' WHEN total_messages > 5 THEN 'mid' ELSE 'small' END AS size, city AS town FROM gold JOIN (SELECT lead_key, count(quoted_price) AS prices, max(message_length) AS longest FROM silver GROUP BY 1) p USING (lead_key)"


def _planned(s, d):
    m = stored(s, d, *S.LEAD_COLUMNS, *G.MESSAGE_COLUMNS, *(x.source for x in PLAN if isinstance(x, Aggregate)))
    return apply_columns(G.gold_leads(S.silver_leads(m), m), PLAN, m).select("lead_key", "total_messages", "prices", "longest", "size", "town")


for _n in ("join_column_plan_agg", "plan_apply", "plan_aggregate"):
    add(_n, _planned, _planned_sql)
add("plan_bucket", lambda s, d: apply_columns(gold(s, d), [PLAN[2]]).select("lead_key", "size"), "SELECT lead_key, CASE WHEN total_messages > 20 THEN 'big' WHEN total_messages > 5 THEN 'mid' ELSE 'small' END AS size FROM gold")
add("plan_alias", lambda s, d: apply_columns(gold(s, d), [PLAN[3], PLAN[4]]).select("lead_key", "town", F.col("absent").isNull().alias("absent_null")), "SELECT lead_key, city AS town, TRUE AS absent_null FROM gold")
add("plan_condition", lambda s, d: (lambda g: g.select("lead_key", condition(g, "mentioned_competitor AND avg_quoted_price > 900").alias("hit"), condition(g, "nowhere > 1").alias("none")))(gold(s, d)), "SELECT lead_key, coalesce(mentioned_competitor AND avg_quoted_price > 900, FALSE) AS hit, FALSE AS none FROM gold")
_low = lambda c: f"(SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v, md5({c}) AS h FROM bronze WHERE {c} IS NOT NULL ORDER BY h, v LIMIT 5))"
_sampled = ("direction", "status", "message_type", "conversation_id")
add("plan_schema_sample", lambda s, d: schema_sample(bronze(s, d).select(*_sampled, "message_body", "agent_id"), hidden=("agent_id",)), " UNION ALL ".join(f"SELECT '{c}' AS column_name, 'string' AS dtype, {_low(c)} AS samples" for c in _sampled))
_whole = ", ".join(f"coalesce('=' || {c}, '')" for c in ("message_id", "direction", "conversation_outcome"))
add("plan_row_sample", lambda s, d: row_sample(bronze(s, d).select("message_id", "direction", "conversation_outcome", "message_body")), f"SELECT message_id, direction, conversation_outcome FROM bronze ORDER BY md5(concat_ws('|', {_whole})), message_id LIMIT 10")
# --- dedup, context, windows --------------------------------------------------------------------------------------------
columns_of("dedup_events", "silver", "status", "duplicate_event_group_size", "had_status_duplication", "dropped_duplicate_events")
columns_of("ctx_conversation", "silver", "conversation_lead_name", "conversation_agent_name", "conversation_lead_phone")
columns_of("ctx_lead_key", "silver", "lead_key", "lead_phone_masked", "lead_name_raw")
add("win_first_message", lambda s, d: bronze(s, d).groupBy("conversation_id").agg(F.min_by("message_id", S.ordered("timestamp", "message_id")).alias("message_id")), """SELECT conversation_id, first(message_id ORDER BY "timestamp" NULLS LAST, message_id) AS message_id FROM bronze GROUP BY conversation_id""")
add("win_rank_dimension", lambda s, d: G.dimension_counts(gold(s, d)).select("dimension", "dimension_value", "rank"), "SELECT dimension, dimension_value, rank FROM macro")
add("win_duplicate_rows", lambda s, d: bronze(s, d).agg(Q.repeated(*C.DEDUPE_KEYS).alias("repeated")), f"""SELECT (SELECT count(*) FROM bronze) - count(*) AS repeated FROM (SELECT DISTINCT {', '.join(f'"{k}"' for k in C.DEDUPE_KEYS)} FROM bronze)""")
add("win_alert_suppression", lambda s, d: D.suppressed_alerts(silver(s, d).filter("urgency_strength > 0").select(F.col("campaign_id").alias("dedupe_key"), F.col("timestamp").alias("run_at"), F.col("message_id").alias("id"))).select("id", "suppressed"), """SELECT message_id AS id, coalesce(date_diff('second', lag("timestamp") OVER w, "timestamp") <= 1800, FALSE) AS suppressed FROM silver WHERE urgency_strength > 0 WINDOW w AS (PARTITION BY campaign_id ORDER BY "timestamp", message_id)""")
# --- text ---------------------------------------------------------------------------------------------------------------
add("txt_ascii", lambda s, d: texts(s, d).select("doc_id", F.sha2(T.ascii_only(F.col("text")), 256).alias("h")), "SELECT doc_id, sha256(regexp_replace(strip_accents(coalesce(text, '')), '[^\\x00-\\x7F]', '', 'g')) AS h FROM documents")
add("txt_match_norm", lambda s, d: silver(s, d).select("message_id", T.match_norm(F.col("message_body")).alias("norm")), "SELECT message_id, norm FROM silver")
add("txt_safe_string", lambda s, d: bronze(s, d).select("message_id", T.safe_string(F.col("message_body")).alias("body"), T.safe_int(F.substring("message_id", 2, 11)).alias("n"), T.safe_float(F.col("status")).alias("x")), "SELECT message_id, coalesce(message_body, '') AS body, TRY_CAST(substr(message_id, 2, 11) AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS x FROM bronze")
add("mask_digits", lambda s, d: bronze(s, d).select("message_id", T.mask_digits(F.col("sender_phone")).alias("masked")), "SELECT message_id, regexp_replace(sender_phone, '[0-9]', 'X', 'g') AS masked FROM bronze")
add("mask_name", lambda s, d: bronze(s, d).select("message_id", T.mask_name(F.col("sender_name")).alias("masked")), "SELECT message_id, regexp_replace(sender_name, '[A-Za-z]', 'X', 'g') AS masked FROM bronze")
add("mask_email", lambda s, d: bronze(s, d).select("message_id", T.mask_email(F.col("message_body")).alias("masked")), "SELECT message_id, CASE WHEN contains(message_body, '@') THEN regexp_replace(split_part(message_body, '@', 1), '(^|.* )[^ ]+$', '\\1') || regexp_replace(regexp_extract(message_body, '[^ ]+@[^ ]+'), '[A-Za-z0-9]', 'x', 'g') ELSE coalesce(message_body, '') END AS masked FROM bronze")
add("mask_plate", lambda s, d: bronze(s, d).select("message_id", T.mask_plate(F.col("message_body")).alias("masked")), "SELECT message_id, regexp_replace(coalesce(message_body, ''), 'ABC[0-9][A-Z][0-9]{2}', 'XXX9X99') AS masked FROM bronze")
add("mask_body", lambda s, d: silver(s, d).select("message_id", "message_body_masked", (F.length("message_body_masked") == F.length(T.safe_string(F.col("message_body")))).alias("same_length")))
add("mask_known_names", lambda s, d: silver(s, d).select("message_id", T.mask_known_names(T.safe_string(F.col("message_body")), F.col("conversation_lead_name"), F.col("conversation_agent_name")).alias("masked")))
_classes = ", ".join(f"CASE WHEN {p} THEN '{k}' END" for k, p in PII_SQL.items())
add("pii_classes", lambda s, d: bronze(s, d).select("message_id", F.array_join(T.pii_classes(F.col("message_body")), ",").alias("classes")), f"SELECT message_id, concat_ws(',', {_classes}) AS classes FROM (SELECT message_id, coalesce(message_body, '') AS body FROM bronze)")
add("pii_unmasked_classes", lambda s, d: silver(s, d).agg(F.count_if(F.size(T.unmasked_classes(F.col("message_body_masked"))) > 0).alias("leaks"), F.count_if(F.size(T.unmasked_classes(F.col("message_body"))) > 0).alias("unmasked"), F.count_if(F.size(T.unmasked_classes(F.concat_ws(" ", "message_body_masked", F.when(F.col("direction") == "inbound", "ABC1D23")))) > 0).alias("planted")), f"SELECT 0 AS leaks, count(*) FILTER ({UNMASKED_SQL}) AS unmasked, count(*) FILTER (direction = 'inbound') AS planted FROM silver")
add("drift_report", lambda s, d: B.drift_report(B.drift_policy(B.drift_events(bronze(s, d)), {"message_type": "block"})).filter("events > 0"), f"SELECT drift_class, count(*) AS events, CASE WHEN bool_or(policy = 'block') THEN 'block' ELSE max(policy) END AS policy FROM ({_events("CASE WHEN column_name = 'message_type' THEN 'block' ELSE 'quarantine' END")}) GROUP BY drift_class")
add("pub_column_audit", lambda s, d: P.column_audit(P.sanitize(silver(s, d)).drop("sender_name_masked")), "SELECT count(*) AS rows, '' AS forbidden_present, 'sender_name_masked' AS safe_missing FROM silver")
_safe = ("conversation_id", "timestamp", "direction", "message_type")
add("pub_safe_keys", lambda s, d: P.sanitize(silver(s, d)).select(*P.safe_keys((*_safe, "sender_phone"))).distinct(), f"""SELECT DISTINCT {', '.join(f'"{k}"' for k in _safe)}, regexp_replace(coalesce(sender_phone, ''), '[0-9]', 'X', 'g') AS sender_phone_masked FROM silver""")
add("pub_sanitize", lambda s, d: P.sanitize(silver(s, d)).select("message_id", "sender_name_masked", "sender_phone_masked"), "SELECT message_id, regexp_replace(coalesce(sender_name, ''), '[A-Za-z]', 'X', 'g') AS sender_name_masked, regexp_replace(coalesce(sender_phone, ''), '[0-9]', 'X', 'g') AS sender_phone_masked FROM silver")
# --- signals ------------------------------------------------------------------------------------------------------------
columns_of("sig_length_words", "silver", "message_length", "word_count", "is_empty_message")
columns_of("sig_contains_pii", "silver", *[f"contains_{k}" for k in C.FLAGS])
for _n, _c in {"sig_vehicle_make": "vehicle_make", "sig_vehicle_model": "vehicle_model", "sig_vehicle_year": "vehicle_year", "sig_competitor": "competitor_mentioned", "sig_claim_type": "sinistro_type", "sig_price": "quoted_price", "sig_email_provider": "email_provider", "sig_price_objection": "price_objection_signal", "sig_urgency": "urgency_strength", "sig_competitor_comparison": "competitor_comparison_signal"}.items():
    columns_of(_n, "silver", _c)
columns_of("sig_mentions", "silver", "mentions_vehicle", "mentions_competitor", "mentions_sinistro")
columns_of("sig_directional", "silver", *[f"{c}_{x}" for x in ("inbound", "outbound") for c in ("price_objection_signal", "urgency_strength", "competitor_comparison_signal", "competitor_mentioned", "mentions_competitor")])
add("sig_tone_hits", lambda s, d: silver(s, d).select("message_id", tone_hits(F.col("message_body"), C.POSITIVE).alias("pos"), tone_hits(F.col("message_body"), C.NEGATIVE).alias("neg")), "SELECT message_id, pos, neg FROM silver")
columns_of("sig_sentiment_label", "gold", "positive_tone_hits", "negative_tone_hits", "conversation_sentiment_label")
columns_of("sig_sentiment_support", "gold", "conversation_sentiment_support")
_old = lambda s, d: silver(s, d).drop("price_objection_signal_outbound", "urgency_strength_inbound", "urgency_strength_outbound", "competitor_comparison_signal", "competitor_comparison_signal_inbound", "competitor_comparison_signal_outbound").withColumn("price_objection_signal_inbound", F.when(F.substring("message_id", 12, 1) != "5", F.col("price_objection_signal_inbound")))
add("sig_column_defaults", lambda s, d: with_directional_defaults(_old(s, d)).select("message_id", *[f"{n}_{x}" for n in ("price_objection_signal", "urgency_strength", "competitor_comparison_signal") for x in ("inbound", "outbound")]),
    "SELECT message_id, price_objection_signal AND is_inbound AS price_objection_signal_inbound, price_objection_signal AND is_outbound AS price_objection_signal_outbound, CASE WHEN is_inbound THEN urgency_strength ELSE 0 END AS urgency_strength_inbound, CASE WHEN is_outbound THEN urgency_strength ELSE 0 END AS urgency_strength_outbound, FALSE AS competitor_comparison_signal_inbound, FALSE AS competitor_comparison_signal_outbound FROM silver")
# --- aggregations -------------------------------------------------------------------------------------------------------
columns_of("silver_messages", "silver", "conversation_id", "lead_key", "timestamp", "direction", "is_inbound", "is_outbound", "quoted_price", "urgency_strength", *META)
LEAD = ("canonical_lead_name_masked", "lead_contact_ref", "city", "state", "first_seen_at", "last_seen_at", "conversation_count", "message_count", "observed_campaign_ids", "observed_lead_sources", "observed_outcomes", *[f"has_{k}_signal" for k in ("vehicle", "competitor", "sinistro", *C.FLAGS)], "primary_campaign_id", "latest_outcome", "vehicle_make_observed", "vehicle_model_observed", "vehicle_year_observed", "primary_competitor_observed", "quoted_price_min", "quoted_price_max", "quoted_price_last", "avg_response_time_sec", "business_hours_ratio")
columns_of("silver_leads", "leads", *LEAD)
columns_of("agg_first_non_empty", "leads", "primary_campaign_id", "latest_outcome", "city", "state")
columns_of("agg_first_last_non_null", "leads", "vehicle_make_observed", "vehicle_model_observed", "vehicle_year_observed", "quoted_price_last")
columns_of("agg_sorted_unique", "leads", "observed_campaign_ids", "observed_lead_sources", "observed_outcomes")
columns_of("agg_any_flag", "leads", *[f"has_{k}_signal" for k in ("vehicle", "competitor", "sinistro", *C.FLAGS)])
columns_of("agg_price_stats", "leads", "quoted_price_min", "quoted_price_max", "quoted_price_last", "avg_response_time_sec", "business_hours_ratio")
AGG = ("total_messages", "inbound_messages", "outbound_messages", "duplicate_events_removed", *[f"contains_{k}" for k in C.FLAGS], "mentioned_vehicle", "mentioned_competitor", "mentioned_sinistro", "avg_quoted_price", "primary_competitor", "quoted_price_mentions", "price_objection_hits", "urgency_hits", "urgency_strength_max", "competitor_mentions_count", "competitor_comparison_hits", "positive_tone_hits", "negative_tone_hits")
columns_of("gold_message_aggregates", "gold", *AGG)
columns_of("gold_vehicle_context", "gold", "vehicle_make", "vehicle_model", "vehicle_year")
columns_of("gold_claim_context", "gold", "primary_sinistro_type")
SEG = tuple(C.GOLD_DOMAINS)
columns_of("gold_leads", "gold", *AGG, *SEG, "data_shared_score", "has_closed_outcome", "dominant_email_provider", "business_hours_message_ratio")
_metrics = {"avg_total_messages": "avg(total_messages)", "avg_conversation_count": "avg(conversation_count)", "avg_data_shared_score": "avg(data_shared_score)", "total_leads": "CAST(count(*) AS DOUBLE)", "leads_with_email_pct": "avg(CAST(contains_email AS INT))", "leads_with_competitor_signal_pct": "avg(CAST(mentioned_competitor AS INT))", "leads_with_sinistro_signal_pct": "avg(CAST(mentioned_sinistro AS INT))", "leads_closed_pct": "avg(CAST(has_closed_outcome AS INT))"}
_numeric = " UNION ALL ".join(f"SELECT 'numeric_snapshot' AS dimension, '{m}' AS dimension_value, CAST(0 AS BIGINT) AS lead_count, CAST(0 AS DOUBLE) AS lead_pct, CAST({i} AS BIGINT) AS rank, {e} AS metric_value FROM gold" for i, (m, e) in enumerate(_metrics.items(), 1))
_dims = "SELECT dimension, dimension_value, lead_count, lead_pct, rank, CAST(NULL AS DOUBLE) AS metric_value FROM macro"
add("macro_dimension", lambda s, d: G.dimension_counts(gold(s, d)), _dims)
add("macro_numeric", lambda s, d: G.numeric_snapshot(gold(s, d)), _numeric)
add("gold_macro", lambda s, d: G.gold_macro(gold(s, d)), f"{_dims} UNION ALL {_numeric}")
add("macro_placeholder", lambda s, d: G.dimension_counts(gold(s, d).drop("intent_stage"), ("intent_stage", "risk_signal")).select("dimension", "dimension_value", "lead_count", "rank"), "SELECT 'intent_stage' AS dimension, 'sem_contrato' AS dimension_value, 0 AS lead_count, 1 AS rank UNION ALL SELECT 'risk_signal', risk_signal, count(*), row_number() OVER (ORDER BY count(*) DESC, risk_signal) FROM gold GROUP BY risk_signal")
FEATURES = ("lead_key", "conversation_first_message_at", "conversation_last_message_at", "message_count", "inbound_count", "positive_tone_hits", "negative_tone_hits", "quoted_price_mentions", "last_price", "avg_response_time_sec", "competitor_mentions_count", "urgency_hits", "has_sinistro_signal")
SIGNALS = ("competitor_comparison_hits", "primary_competitor", "price_objection_hits", "urgency_strength_max", *[f"contains_{k}" for k in C.FLAGS], "has_competitor_signal")
_ISO = {k: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for k in ("timestampFormat", "timestampNTZFormat")}
add("conv_features", lambda s, d: V.conversation_features(silver(s, d)).select("conversation_id", *FEATURES, *SIGNALS, "outbound_count", "has_vehicle_signal", "response_latency_band", F.to_json("messages", _ISO).alias("messages")), f"""SELECT f.conversation_id, {', '.join(f'f.{c}' for c in (*FEATURES, *SIGNALS))}, m.outbound_count, m.has_vehicle_signal,
    CASE WHEN f.avg_response_time_sec IS NULL THEN 'sem_evidencia' WHEN f.avg_response_time_sec <= 300 THEN 'rapida' WHEN f.avg_response_time_sec <= 1800 THEN 'moderada' ELSE 'lenta' END AS response_latency_band, m.messages
    FROM semantics f JOIN (SELECT conversation_id, count(*) FILTER (direction = 'outbound') AS outbound_count, coalesce(bool_or(mentions_vehicle), FALSE) AS has_vehicle_signal,
      CAST(to_json(list({{'timestamp': strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f'), 'direction': coalesce(direction, ''), 'message_type': coalesce(message_type, ''), 'text': body}} ORDER BY "timestamp" NULLS LAST, message_id NULLS LAST)) AS VARCHAR) AS messages
      FROM {MASKED_SQL} GROUP BY conversation_id) m ON f.conversation_id IS NOT DISTINCT FROM m.conversation_id""")  # fmt: skip
add("conv_input_hash", lambda s, d: V.conversation_input_hash(silver(s, d)))
SEM = ("sentiment_label", "sentiment_confidence_band", "intent_stage", "persona_profile", "audience_segment", "price_objection_intensity", "competitor_pressure_level", "commercial_urgency_signal", "recommended_next_action", "data_shared_score")
columns_of("conv_semantics", "semantics", *SEM)


def hashed_conversations(s, d):
    m = stored(s, d, *V.MESSAGE_COLUMNS)
    return held(V.conversation_semantics(V.conversation_features(m)).join(V.conversation_input_hash(m), "conversation_id"), "hashed")


def fixture_answers(x: DataFrame) -> DataFrame:
    """Answers of a model about conversations, by the last digit of (lead number + day): none (0), a provider that failed
    (1), a word outside its vocabulary (2), a note that is too long (3) or shows personal data (4), synonyms (5), typos (6),
    a field that is missing (7), and proper ones (8, 9), which an older and worse answer precedes."""
    n = F.substring("conversation_id", 6, 20).cast("long")
    k = (F.floor(n / 10) + n % 10) % 10
    c, when = F.col, lambda kind, other, field: F.when(k == kind, other).otherwise(F.col(field))
    says = {f: c(f) for f in N.FIELDS} | {
        "sentiment_label": when(5, " Positive", "sentiment_label"),
        "sentiment_confidence_band": when(5, "HIGH", "sentiment_confidence_band"),
        "intent_stage": F.when(k == 2, "comprar_agora").when(k == 5, "Quote request").otherwise(c("intent_stage")),
        "persona_profile": F.when(k == 6, F.concat("persona_profile", F.lit("r"))).when(k == 7, F.lit(None)).otherwise(c("persona_profile")),
        "audience_segment": when(6, F.upper(F.translate("audience_segment", "_", "-")), "audience_segment"),
        "competitor_pressure_level": F.when(k >= 8, "alta").otherwise(c("competitor_pressure_level")),
        "explanation_short": F.when(k == 3, F.repeat(F.lit("x"), F.lit(281))).when(k == 4, "fale com ana@exemplo.com").otherwise("ok"),
    }
    error = lambda *parts: F.struct(*[F.lit(p).cast("string").alias(name) for name, p in zip(("provider", "kind", "detail"), parts, strict=True)])
    output = F.struct(*[says[f].cast("string").alias(f) for f in (*N.FIELDS, "explanation_short")])
    now = x.filter(k > 0).select(
        "conversation_id", "input_hash", F.lit("v1").alias("prompt_version"), F.lit("model").alias("model"), F.when(k == 1, "timeout").otherwise("success").alias("status"), F.lit("alpha").alias("provider_name"),
        F.when(k == 1, F.array(F.lit("alpha"), F.lit("beta"))).otherwise(F.array(F.lit("alpha"))).alias("attempted_providers"), F.when(k == 1, F.array(error("alpha", "timeout", "30s"), error("beta", "", None))).alias("provider_errors"),
        F.when(k != 1, output).alias("output"), F.lit(None).cast("string").alias("validation_error"), F.lit("t").alias("trace_id"), F.lit("2024-02-02").cast("timestamp").alias("answered_at"),
    )
    worse = now.withColumns({"status": F.lit("fallback"), "output": F.lit(None).cast(now.schema["output"].dataType), "answered_at": F.lit("2024-02-01").cast("timestamp")})
    return now.unionByName(worse)


def first_enriched(s, d):
    x = hashed_conversations(s, d)
    return N.enriched(x, fixture_answers(x))


def again_enriched(s, d):
    """A second run with what the first one left in the store, which has been compacted between; no model is asked."""
    x = hashed_conversations(s, d)
    store = N.AnswerStore(s, scratch_folder(s, "answers"))
    first = held(N.enriched(x, fixture_answers(x)), "enriched")
    store.upsert(first.filter("inference_status <> 'success'"))
    store.upsert(first)
    store.compact()
    return N.enriched(x, None, store.latest(x))


ENRICHED = ("conversation_id", "lead_key", "inference_status", "provider_name", "provider_attempt_count", "provider_error_summary", "fallback_reason", "validation_error", "source_family", *N.FIELDS)
_kinds = "(SELECT *, (n // 10 + n % 10) % 10 AS k FROM (SELECT *, CAST(substr(conversation_id, 6) AS BIGINT) AS n FROM semantics))"
_status = "CASE WHEN k = 0 THEN 'provider_error' WHEN k = 1 THEN 'fallback' WHEN k IN (2, 3, 4, 7) THEN 'invalid_output' ELSE 'success' END"
_family = "CASE WHEN k IN (5, 6, 8, 9) THEN 'llm_provider' ELSE 'deterministic_fallback' END"
_replaced = {"sentiment_label": "CASE WHEN k = 5 THEN 'positivo' ELSE sentiment_label END", "sentiment_confidence_band": "CASE WHEN k = 5 THEN 'forte' ELSE sentiment_confidence_band END", "intent_stage": "CASE WHEN k = 5 THEN 'cotacao_ativa' ELSE intent_stage END", "competitor_pressure_level": "CASE WHEN k >= 8 THEN 'alta' ELSE competitor_pressure_level END"}
_enriched_sql = lambda status, family: f"""SELECT conversation_id, lead_key, {status} AS inference_status, CASE WHEN k > 0 THEN 'alpha' END AS provider_name, CASE k WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS provider_attempt_count, CASE WHEN k = 1 THEN 'alpha:timeout:30s | beta' END AS provider_error_summary,
    CASE WHEN k = 0 THEN 'no_answer' WHEN k = 1 THEN 'alpha:timeout:30s | beta' WHEN k IN (2, 3, 4, 7) THEN 'invalid_llm_response' END AS fallback_reason, CASE k WHEN 2 THEN 'invalid_intent_stage:comprar_agora' WHEN 3 THEN 'explanation_too_long' WHEN 4 THEN 'explanation_privacy_leak' WHEN 7 THEN 'missing_fields:persona_profile' END AS validation_error,
    {family} AS source_family, {', '.join(f'{_replaced.get(f, f)} AS {f}' for f in N.FIELDS)} FROM {_kinds}"""  # noqa: E731
add("conv_enrichment", lambda s, d: first_enriched(s, d).select(*ENRICHED), _enriched_sql(_status, _family))
add("conv_enrichment_again", lambda s, d: again_enriched(s, d).select(*ENRICHED), _enriched_sql("'skipped_cache_hit'", "CASE WHEN k > 0 THEN 'llm_provider' ELSE 'deterministic_fallback' END"))
add("sem_mode_recency", lambda s, d: V.mode_with_recency(semantics(s, d), "sentiment_label"), "SELECT lead_key, sentiment_label FROM mood_mode")
add("sem_pair_mode_recency", lambda s, d: V.mode_with_recency(semantics(s, d), "persona_profile", "audience_segment"), "SELECT lead_key, persona_profile, audience_segment FROM pair_mode")
consolidated = lambda s, d: V.consolidate(semantics(s, d))
add("sem_latest_non_null", lambda s, d: consolidated(s, d).select("lead_key", "intent_stage"), "SELECT lead_key, intent_stage FROM consolidated")
add("sem_max_severity", lambda s, d: consolidated(s, d).select("lead_key", "conversation_sentiment_support"), "SELECT lead_key, conversation_sentiment_support FROM consolidated")
add("sem_source_family", lambda s, d: V.consolidate(held(first_enriched(s, d), "enriched")).select("lead_key", "intent_stage_source_family"), f"SELECT lead_key, CASE WHEN count(DISTINCT f) > 1 THEN 'mixed' ELSE min(f) END AS intent_stage_source_family FROM (SELECT lead_key, {_family} AS f FROM {_kinds}) GROUP BY lead_key")
add("sem_consolidate", lambda s, d: consolidated(s, d).select("lead_key", *G.SEMANTIC), f"SELECT lead_key, {', '.join(G.SEMANTIC)} FROM consolidated")
add("metrics_decision_log", lambda s, d: D.decision_metrics(silver(s, d).select(F.col("campaign_id").alias("family"), F.when(F.col("status") == "read", "promoted").when(F.col("status") == "failed", "rolled_back").otherwise("proposed").alias("decision"), F.col("message_length").alias("duration"))),
    "SELECT campaign_id AS family, count(*) AS proposals, count(*) FILTER (status = 'read') AS promotions, count(*) FILTER (status = 'failed') AS rollbacks, round(count(*) FILTER (status = 'read') / count(*), 4) AS promotion_rate, CAST(list_sort(list(message_length))[len(list(message_length)) // 2 + 1] AS DOUBLE) AS median_duration FROM silver GROUP BY 1")
add("snk_published_layers", _published, " UNION ALL ".join(_counted(k, t) for k, t in _layer_sql.items()) + f" UNION ALL SELECT 'gold_macro', count(*), count(DISTINCT dimension_value), min(dimension_value), max(dimension_value) FROM (SELECT dimension_value FROM macro UNION ALL SELECT dimension_value FROM ({_numeric}))")
# --- segments -----------------------------------------------------------------------------------------------------------
for _n, _c in {"seg_engagement": ("engagement_bucket", "total_messages"), "seg_data_shared": ("data_shared_score",), "seg_lifecycle_hours": ("lead_lifecycle_hours",), "seg_latency_band": ("response_latency_band", "avg_response_time_sec"), "seg_outcome_group": ("closure_outcome_group", "observed_outcomes"), "seg_closed_flag": ("has_closed_outcome",), "seg_price_objection": ("price_objection_intensity",), "seg_urgency": ("commercial_urgency_signal",), "seg_competitor_pressure": ("competitor_pressure_level",), "seg_temperature": ("lead_temperature",), "seg_price_sensitivity": ("price_sensitivity",), "seg_contact_readiness": ("contact_readiness",), "seg_intent": ("intent_stage",), "seg_risk": ("risk_signal",), "seg_persona": ("persona_profile",), "seg_audience": ("audience_segment",), "seg_all": SEG, "seg_email_provider_null": ("dominant_email_provider", "contains_email")}.items():
    columns_of(_n, "gold", *_c)
# --- model output -------------------------------------------------------------------------------------------------------
VOCABULARY = ("fechado", "perdido", "sem_interesse", "venda_fechada", "em_negociacao", "ghosting")
_outcomes = lambda s, d: bronze(s, d).filter("conversation_outcome IS NOT NULL").select("message_id", F.concat("conversation_outcome", F.when(F.col("direction") == "inbound", "").otherwise("s")).alias("outcome"))
add("out_normalize", lambda s, d: V.normalized_output(_outcomes(s, d), "outcome", VOCABULARY, {"proposta_enviada": "em_negociacao"}).select("message_id", "outcome", "outcome_normalized"))
add("out_validate", lambda s, d: V.first_violation(silver(s, d), {"direction": ("inbound",), "message_type": ("text", "image")}, "message_body").select("message_id", "violation"),
    f"SELECT message_id, CASE WHEN direction NOT IN ('inbound') THEN 'vocabulary:direction' WHEN message_type NOT IN ('text', 'image') THEN 'vocabulary:message_type' WHEN message_length > 280 THEN 'too_long' WHEN {UNMASKED_SQL} THEN 'pii' END AS violation FROM silver")
add("out_error_summary", lambda s, d: V.error_summaries(silver(s, d).withColumn("campaign_id", F.when(F.col("direction") == "inbound", F.col("campaign_id")).otherwise(" ")), "conversation_id", "channel", "campaign_id", "message_type"), "SELECT conversation_id, string_agg(e, ' | ' ORDER BY e) AS errors FROM (SELECT DISTINCT conversation_id, concat_ws(':', channel, CASE WHEN direction = 'inbound' THEN campaign_id END, message_type) AS e FROM silver) GROUP BY 1")
# --- checks -------------------------------------------------------------------------------------------------------------
_row = lambda layer, check, n: f"SELECT '{layer}' AS layer, '{check}' AS \"check\", CASE WHEN v = 0 THEN 'passed' ELSE 'failed' END AS status, v AS violating_rows FROM (SELECT CAST({n[0]} AS BIGINT) AS v FROM {n[1]})"
_union = lambda layer, rows: " UNION ALL ".join(_row(layer, c, n) for c, n in rows.items())
_f = lambda cond: f"count(*) FILTER ({cond})"
add("dq_required_columns", lambda s, d: Q.columns_result(bronze(s, d), "bronze", C.REQUIRED_COLUMNS).unionByName(Q.columns_result(bronze(s, d).drop("status", "channel"), "less", C.REQUIRED_COLUMNS)).join(bronze(s, d).agg(F.count("*").alias("rows"))),
    "SELECT l AS layer, 'required_columns' AS \"check\", st AS status, CAST(v AS BIGINT) AS violating_rows, n AS rows FROM (SELECT count(*) AS n FROM bronze), (VALUES ('bronze', 'passed', 0), ('less', 'failed', 2)) t(l, st, v)")
for _n in ("dq_bronze_id_unique", "dq_bronze_channel"):
    _check = "message_id_unique" if _n.endswith("unique") else "channel_supported"
    add(_n, (lambda c: lambda s, d: Q.bronze_checks(bronze(s, d)).filter(F.col("check") == c))(_check), _row("bronze", _check, ("count(*) - count(DISTINCT message_id)" if _n.endswith("unique") else _f("channel <> 'whatsapp'"), "bronze")))
_first = """(SELECT conversation_id, first(direction ORDER BY "timestamp" NULLS LAST, message_id) AS direction FROM bronze GROUP BY 1)"""
_bad = {"timestamp_present": '"timestamp" IS NULL', "metadata_valid": "NOT json_ok", "message_type_known": "message_type NOT IN ('text', 'image', 'audio')"}
add("dq_violating_keys", lambda s, d: Q.violating_keys(bronze(s, d), "bronze", "message_id", {"timestamp_present": F.col("timestamp").isNull(), "metadata_valid": ~B.valid_json(F.col("metadata")), "message_type_known": ~F.col("message_type").isin("text", "image", "audio")}),
    " UNION ALL ".join(f"SELECT 'bronze' AS layer, '{k}' AS \"check\", CASE WHEN count(*) = 0 THEN 'passed' ELSE 'failed' END AS status, count(*) AS violating_rows, coalesce((SELECT string_agg(message_id, ',' ORDER BY message_id) FROM (SELECT DISTINCT message_id FROM parsed WHERE {c} ORDER BY 1 LIMIT 5)), '') AS samples FROM parsed WHERE {c}" for k, c in _bad.items()))
add("dq_bronze_first_outbound", lambda s, d: Q.first_outbound(bronze(s, d)), f"SELECT count(*) AS conversations, count(*) FILTER (direction <> 'outbound') AS violating, (SELECT string_agg(conversation_id, ',' ORDER BY conversation_id) FROM (SELECT conversation_id FROM {_first} WHERE direction <> 'outbound' ORDER BY 1 LIMIT 5)) AS sample FROM {_first}")
_lead_at = lambda k, x: F.substring("lead_key", k, 1) == x
_leads_bad = lambda s, d: leads(s, d).withColumns({"lead_contact_ref": F.when(_lead_at(6, "1"), "fale com a@b.com").otherwise(F.col("lead_contact_ref")), "message_count": F.when(_lead_at(6, "2"), -1).otherwise(F.col("message_count")), "last_seen_at": F.when(~_lead_at(6, "3"), F.col("last_seen_at"))})
add("dq_silver_leads", lambda s, d: Q.silver_lead_checks(_leads_bad(s, d)), _union("silver_leads", {"lead_key_unique": ("count(*) - count(DISTINCT lead_key)", "leads"), "timestamps_present": (_f("substr(lead_key, 6, 1) = '3'"), "leads"), "counts_not_negative": (_f("substr(lead_key, 6, 1) = '2'"), "leads"), "no_leaks": (_f("substr(lead_key, 6, 1) = '1'"), "leads")}))
_leaked = {"email": "a@b.com", "phone": "+55 11 99999-0000", "cpf": "123.456.789-01", "cep": "04567-123", "plate": "ABC1D23"}
_id_at = lambda x: F.substring("message_id", 12, 1) == x


def _messages_bad(s, d):
    text = F.col("message_body_masked")
    for i, v in enumerate(_leaked.values()):
        text = F.when(_id_at(str(i)), v).otherwise(text)
    return silver(s, d).withColumns({"message_body_masked": text, "mentions_vehicle": F.col("mentions_vehicle") != _id_at("5"), "timestamp": F.when(~_id_at("6"), F.col("timestamp"))})


_digit_is = lambda x: f"substr(message_id, 12, 1) = '{x}'"
_keys_bad = ", ".join(f"CASE WHEN {_digit_is(6)} THEN NULL ELSE \"timestamp\" END" if k == "timestamp" else f'"{k}"' for k in C.DEDUPE_KEYS)
add("dq_silver_messages", lambda s, d: Q.silver_message_checks(_messages_bad(s, d)), _union("silver_messages", {"timestamp_present": (_f(_digit_is(6)), "silver"), "dedupe_keys_unique": (f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {_keys_bad} FROM silver))", "silver"), **{f"no_{k}_leak": (_f(_digit_is(i)), "silver") for i, k in enumerate(_leaked)}, "vehicle_consistent": (_f(_digit_is(5)), "silver")}))
add("dq_leak_scan", lambda s, d: Q.leaks(silver(s, d), ("message_body", "message_body_masked"), "message_id"), " UNION ALL ".join(f"SELECT 'message_body' AS column_name, '{k}' AS pii_class, count(*) AS rows, min(message_id) AS first_key FROM silver WHERE contains_{k} HAVING count(*) > 0" for k in C.FLAGS))
add("dq_conversations", lambda s, d: (lambda x: Q.conversation_checks(x.withColumn("audience_segment", F.when(F.col("inbound_count") == 0, "?").otherwise(F.col("audience_segment"))).unionByName(x.filter("inbound_count = 1"))))(semantics(s, d)), _union("conversations", {"conversation_id_unique": (_f("inbound_count = 1"), "semantics"), "audience_fits": (_f("inbound_count = 0"), "semantics")}))
_in = lambda c: f"{c} IS NULL OR {c} NOT IN ({', '.join(repr(x) for x in C.GOLD_DOMAINS[c])})"
add("dq_gold_domains", lambda s, d: Q.gold_domain_checks(gold(s, d)), _union("gold", {f"domain_{c}": (_f(_in(c)), "gold") for c in C.GOLD_DOMAINS}))
_gold_checks = {"lead_key_unique": ("count(*) - count(DISTINCT lead_key)", "gold"), "counts_not_negative": (_f("total_messages < 0"), "gold"), "duplicates_not_negative": (_f("duplicate_events_removed < 0"), "gold"), "persona_present": (_f("persona_profile IS NULL"), "gold"), "closure_flag": (_f("has_closed_outcome <> (closure_outcome_group = 'fechado')"), "gold"), "provider_needs_email": (_f("dominant_email_provider IS NOT NULL AND NOT contains_email"), "gold"), "persona_audience": (_f(f"{AUDIENCE('persona_profile')} <> audience_segment"), "gold"), "provenance": (_f("substr(lead_key, 6, 1) = 'a'"), "gold"), "sentiment_support": (_f("(conversation_sentiment_label = 'sem_evidencia') <> (conversation_sentiment_support = 'sem_evidencia')"), "gold"), "sentiment_evidence": (_f("positive_tone_hits + negative_tone_hits = 0 AND conversation_sentiment_label <> 'sem_evidencia'"), "gold")}
for _n, _cs in {"dq_gold_keys_counts": ("lead_key_unique", "counts_not_negative", "duplicates_not_negative", "persona_present"), "dq_gold_provenance": ("provenance",), "dq_gold_closure_flag": ("closure_flag",), "dq_gold_provider_null": ("provider_needs_email",), "dq_gold_persona_audience": ("persona_audience",), "dq_gold_sentiment_support": ("sentiment_support",), "dq_gold_sentiment_evidence": ("sentiment_evidence",)}.items():
    add(_n, (lambda cs: lambda s, d: Q.gold_key_checks(gold(s, d).withColumn("intent_stage_source_family", F.when(_lead_at(6, "a"), "?").otherwise("llm_provider"))).filter(F.col("check").isin(*cs)))(_cs), _union("gold", {c: _gold_checks[c] for c in _cs}))


_same = ("first_seen_at", "last_seen_at", "conversation_count", "message_count", *[f"has_{k}_signal" for k in ("vehicle", "competitor", "sinistro", *C.FLAGS)])


def _silver_reconcile(s, d):
    """Leads in which each column is wrong where the first digit of the key is that of the column; some leads lack, and so do
    the messages of others."""
    m = stored(s, d, *S.LEAD_COLUMNS)
    wrong = {c: F.when(~_lead_at(6, f"{i:x}"), F.col(c)) for i, c in enumerate(_same)}
    return Q.silver_reconcile(S.silver_leads(m).filter(~_lead_at(7, "f")).withColumns(wrong), m.filter(~_lead_at(7, "e")))


_both = "substr(lead_key, 7, 1) NOT IN ('e', 'f')"
_wrong = {f"same_{c}": (_f(f"{_both} AND substr(lead_key, 6, 1) = '{i:x}'"), "leads") for i, c in enumerate(_same)}
add("dq_silver_reconcile", _silver_reconcile, _union("silver_reconcile", {"keys_missing_right": (_f("substr(lead_key, 7, 1) = 'e'"), "leads"), "keys_missing_left": (_f("substr(lead_key, 7, 1) = 'f'"), "leads"), **_wrong}))
_checked = ("first_seen_at", "last_seen_at", "conversation_count")


_counted = {c: f"{i:x}" for i, c in enumerate((*Q.TOTALS, *Q.FOUND), len(_checked))}


def _gold_reconcile(s, d):
    """Gold in which each column is wrong where the first digit of the key is that of the column (times and conversations
    lack, totals are one too high, flags the other way round); some keys lack in gold, in leads or in messages, and some
    leads lack their outbound messages."""
    m = stored(s, d, *S.LEAD_COLUMNS, *G.MESSAGE_COLUMNS, "direction")
    ld = held(S.silver_leads(m), "leads")
    wrong = {c: F.when(~_lead_at(6, f"{i:x}"), F.col(c)) for i, c in enumerate(_checked)}
    wrong |= {c: F.col(c) + _lead_at(6, x).cast("long") if c in Q.TOTALS else F.col(c) != _lead_at(6, x) for c, x in _counted.items()}
    kept = m.filter(~_lead_at(7, "d") & ~(_lead_at(8, "0") & (F.col("direction") == "outbound")))
    return Q.gold_reconcile(G.gold_leads(ld, m).filter(~_lead_at(7, "f")).withColumns(wrong), ld.filter(~_lead_at(7, "e")), kept)


_wrong_sql = [f"CASE WHEN substr(lead_key, 6, 1) <> '{i:x}' THEN {c} END AS {c}" for i, c in enumerate(_checked)] + [f"{c} + CAST(substr(lead_key, 6, 1) = '{x}' AS INT) AS {c}" if c in Q.TOTALS else f"{c} <> (substr(lead_key, 6, 1) = '{x}') AS {c}" for c, x in _counted.items()]
_history = f"""(SELECT lead_key, min("timestamp") AS first_seen_at, max("timestamp") AS last_seen_at, count(DISTINCT conversation_id) AS conversation_count, count(*) AS total_messages, count(*) FILTER (direction = 'inbound') AS inbound_messages, count(*) FILTER (direction = 'outbound') AS outbound_messages, sum(dropped_duplicate_events) AS duplicate_events_removed,
    {', '.join(f'coalesce(bool_or({m}), FALSE) AS {f}' for f, m in Q.FOUND.items())} FROM silver WHERE substr(lead_key, 7, 1) <> 'd' AND NOT (substr(lead_key, 8, 1) = '0' AND direction = 'outbound') GROUP BY lead_key)"""
_differ = {f"same_history_{c}": f"h.lead_key IS NOT NULL AND g.{c} IS DISTINCT FROM h.{c}" for c in (*_checked, *_counted)} | {"same_sum_of_directions": "h.lead_key IS NOT NULL AND g.inbound_messages + g.outbound_messages <> g.total_messages", "keys_missing_messages": "h.lead_key IS NULL"}
_reconciled = f"""SELECT 'gold_reconcile' AS layer, u.k AS "check", CASE WHEN u.v = 0 THEN 'passed' ELSE 'failed' END AS status, u.v AS violating_rows FROM (SELECT unnest([{', '.join(f"{{'k': '{k}', 'v': {_f(w)}}}" for k, w in _differ.items())}]) AS u
    FROM (SELECT * REPLACE ({', '.join(_wrong_sql)}) FROM gold WHERE {_both}) g LEFT JOIN {_history} h USING (lead_key))"""


add("dq_gold_reconcile", _gold_reconcile, _union("gold_reconcile", {"keys_missing_right": (_f("substr(lead_key, 7, 1) = 'e'"), "leads"), "keys_missing_left": (_f("substr(lead_key, 7, 1) = 'f'"), "leads"), **{f"same_{c}": (_f(f"{_both} AND substr(lead_key, 6, 1) = '{i:x}'"), "leads") for i, c in enumerate(_checked)}}) + f" UNION ALL {_reconciled}")
_coherent = ("engagement_bucket", "response_latency_band", "closure_outcome_group", "price_objection_intensity", "commercial_urgency_signal", "competitor_pressure_level", "lead_temperature", "price_sensitivity", "contact_readiness", "risk_signal")
add("dq_gold_coherence", lambda s, d: Q.gold_coherence(gold(s, d).withColumns({c: F.when(_lead_at(6, f"{i:x}"), "?").otherwise(F.col(c)) for i, c in enumerate(_coherent)})), _union("gold_coherence", {f"same_{c}": (_f(f"substr(lead_key, 6, 1) = '{i:x}'"), "gold") for i, c in enumerate(_coherent)}))


def _macro_bad(s, d):
    c, of = F.col, lambda x: F.col("dimension") == x
    macro = G.gold_macro(gold(s, d)).filter(~of("lead_temperature"))
    return macro.withColumns({"lead_pct": F.when(of("intent_stage"), 1.5).otherwise(c("lead_pct")), "lead_count": F.when(of("engagement_bucket"), -1).otherwise(c("lead_count")), "rank": F.when(of("persona_profile"), 0).otherwise(c("rank")), "dimension_value": F.when(~of("audience_segment"), c("dimension_value"))})


_of = lambda x: _f(f"dimension = '{x}'")
add("dq_macro", lambda s, d: Q.macro_checks(_macro_bad(s, d)), _union("gold_macro", {"pairs_unique": (f"{_of('audience_segment')} - 1", "macro"), "share_in_range": (_of("intent_stage"), "macro"), "count_not_negative": (_of("engagement_bucket"), "macro"), "rank_from_one": (_of("persona_profile"), "macro"), "no_nulls": (_of("audience_segment"), "macro"), "dimensions_present": ("1", "(SELECT 1)")}))


def audited(s, d, planted: bool = False):
    """All checks over all layers as they are published; with planted errors, if asked for."""
    b = held(bronze(s, d), "bronze")
    raw = held(S.silver_messages(b), "silver")
    ld = held(S.silver_leads(raw), "leads")
    x = V.conversation_semantics(V.conversation_features(raw)).withColumn("input_hash", F.lit("h"))
    conversations = held(N.enriched(x, None), "conversations")
    g = held(G.gold_leads(ld, raw), "gold")
    macro = held(G.gold_macro(g), "macro")
    m = P.sanitize(raw)
    if planted:
        c, at = F.col, lambda k, x: F.substring("lead_key", k, 1) == x
        b = b.withColumn("channel", F.when(F.substring("message_id", 12, 1) == "9", "sms").otherwise(c("channel")))
        m = m.withColumn("message_body_masked", F.when(F.substring("message_id", 12, 1) == "7", "cpf 123.456.789-01").otherwise(c("message_body_masked")))
        g = g.withColumns({f: F.when(at(6, f"{i:x}"), "?").otherwise(c(f)) for i, f in enumerate(C.GOLD_DOMAINS)})
        ld = ld.filter(~at(8, "f")).withColumns(
            {
                "message_count": c("message_count") + at(7, "0").cast("int"),
                "first_seen_at": F.when(~at(7, "1"), c("first_seen_at")),
                "conversation_count": F.when(at(7, "2"), -1).otherwise(c("conversation_count")),
                "has_email_signal": c("has_email_signal") != at(7, "3"),
                "lead_contact_ref": F.when(at(7, "4"), "ana@x.com").otherwise(c("lead_contact_ref")),
            }
        )
    return A.audit(b, ld, m, conversations, g, macro)


def _fails(layer: str, check: str, table: str, where: str, key: str = "lead_key") -> str:
    few = f"(SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT DISTINCT {key} AS k FROM {table} WHERE {where} ORDER BY 1 LIMIT 5))"
    return f"SELECT '{layer}' AS layer, '{check}' AS \"check\", count(*) AS violating_rows, {few} AS detail FROM {table} WHERE {where} HAVING count(*) > 0"


_at = lambda k, x: f"substr(lead_key, {k}, 1) = '{x}'"
_digit = {f: f"{i:x}" for i, f in enumerate(C.GOLD_DOMAINS)}
_there = f"NOT {_at(8, 'f')}"
_planted = [
    _fails("bronze", "channel_whatsapp_only", "bronze", "substr(message_id, 12, 1) = '9'", "message_id"),
    _fails("silver_messages", "masked_cpf_not_leaking", "silver", "substr(message_id, 12, 1) = '7'", "message_id"),
    *[_fails("gold", f"{f}_valid", "gold", _at(6, x)) for f, x in _digit.items()],
    *[_fails("gold", f"{f}_coherent", "gold", f"{_at(6, _digit[f])} AND {_there}") for f in A.BY_RULE],
    _fails("gold", "persona_audience_semantic_alignment", "gold", f"{_at(6, _digit['persona_profile'])} OR {_at(6, _digit['audience_segment'])}"),
    _fails("gold", "closure_outcome_flag_coherent", "gold", f"{_at(6, _digit['closure_outcome_group'])} AND has_closed_outcome"),
    _fails("gold", "closure_outcome_coherent", "gold", f"{_at(6, _digit['closure_outcome_group'])} AND has_closed_outcome AND {_there}"),
    _fails("gold", "conversation_sentiment_support_alignment", "gold", f"({_at(6, _digit['conversation_sentiment_label'])} AND conversation_sentiment_support = 'sem_evidencia') OR ({_at(6, _digit['conversation_sentiment_support'])} AND conversation_sentiment_label = 'sem_evidencia')"),
    _fails("gold", "gold_lead_keys_in_silver", "gold", _at(8, "f")),
    _fails("silver", "silver_message_count_matches_messages", "leads", f"{_at(7, '0')} AND {_there}"),
    *[_fails("silver", n, "leads", f"{_at(7, '1')} AND {_there}") for n in ("lead_timestamps_not_null", "silver_timestamps_match_messages")],
    *[_fails("silver", n, "leads", f"{_at(7, '2')} AND {_there}") for n in ("lead_counts_non_negative", "silver_conversation_count_matches_messages")],
    _fails("silver", "silver_signal_flags_match_messages", "leads", f"{_at(7, '3')} AND {_there}"),
    _fails("silver", "masked_text_fields_not_leaking", "leads", f"{_at(7, '4')} AND {_there}"),
]
add("dq_violations", lambda s, d: audited(s, d, planted=True).filter("status = 'failed'").drop("status"), " UNION ALL ".join(_planted))
add("dq_summary", lambda s, d: Q.summary(audited(s, d)), "SELECT 'passed' AS status, 86 AS checks, '' AS failed FROM (SELECT count(*) FROM bronze)")
add("dq_diagnose", lambda s, d: Q.diagnosed(Q.results(silver(s, d), "silver", {"no_email_leak": F.count_if("contains_email"), "same_status": F.count_if(F.col("status") != "read")})), "SELECT 'silver' AS layer, 'no_email_leak' AS \"check\", 'privacy' AS kind, 'critical' AS severity, 'mask the column and rebuild silver' AS remedy FROM (SELECT 1 FROM silver WHERE contains_email LIMIT 1) UNION ALL SELECT 'silver', 'same_status', 'consistency', 'high', 'rebuild the layer' FROM (SELECT 1 FROM silver WHERE status <> 'read' LIMIT 1)")
# --- statistical drift ----------------------------------------------------------------------------------------------------
_rates = lambda t, cols: " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(count(*) FILTER (\"{c}\" IS NULL) / greatest(count(*), 1), 6) AS null_rate FROM {t}" for c in cols)
add("qd_snapshot", lambda s, d: D.null_rates(bronze(s, d), ("timestamp", "message_body", "conversation_outcome")).select("column_name", F.lit("null_rate").alias("value"), F.col("null_rate").alias("x")).unionByName(D.frequencies(bronze(s, d), COLS).select("column_name", "value", F.col("freq").alias("x"))), f"SELECT column_name, 'null_rate' AS value, null_rate AS x FROM ({_rates('bronze', ('timestamp', 'message_body', 'conversation_outcome'))} ) UNION ALL SELECT * FROM {_freq('bronze')}")
_gap = lambda s, d: (lambda cols: D.null_rate_rise(D.null_rates(_after(s, d).withColumn("status", F.when(F.col("direction") == "inbound", F.col("status"))), cols), D.null_rates(_before(s, d), cols)))(("status", "channel"))
_rise = f"""SELECT 'status' AS column_name, 0.0 AS before, r AS null_rate, r AS rise FROM (SELECT round(count(*) FILTER (direction <> 'inbound' OR status IS NULL) / count(*), 6) AS r FROM {_after_sql}) WHERE r >= 0.1"""
add("qd_null_rate", _gap, _rise)
add("qd_record_drop", lambda s, d: D.record_drop(_before(s, d).filter("direction = 'inbound'"), _before(s, d)), f"SELECT count(*) AS before, count(*) FILTER (direction = 'inbound') AS rows, (count(*) - count(*) FILTER (direction = 'inbound')) / count(*) >= 0.2 AS dropped FROM {_before_sql}")
add("qd_distribution_shift", lambda s, d: D.distribution_shift(changes(s, d)), f"SELECT column_name, max(abs(diff)) AS shift FROM ({_changes_sql}) GROUP BY 1 HAVING max(abs(diff)) >= 0.15")
_dropped = lambda s, d: D.record_drop(_before(s, d).filter("direction = 'inbound'"), _before(s, d))
add("qd_detect", lambda s, d: D.drift_triggers(D.distribution_shift(changes(s, d)), _gap(s, d), _dropped(s, d)), f"""SELECT string_agg(t, ',' ORDER BY t) AS triggers FROM (SELECT 'distribution_shift:' || column_name AS t FROM ({_changes_sql}) GROUP BY column_name HAVING max(abs(diff)) >= 0.15 UNION ALL SELECT 'null_rate:' || column_name FROM ({_rise})
    UNION ALL SELECT 'record_drop' FROM {_before_sql} HAVING count(*) FILTER (direction <> 'inbound' OR direction IS NULL) / count(*) >= 0.2)""")  # fmt: skip
add("md_bool_strings", lambda s, d: D.boolean_strings(bronze(s, d)), f"""SELECT k AS key, count(*) AS rows FROM {_pairs_sql} WHERE json_type(metadata, '$."' || k || '"') = 'VARCHAR' AND lower(json_extract_string(metadata, '$."' || k || '"')) IN ('true', 'false', 'sim', 'nao') GROUP BY k""")
add("md_key_normalization", lambda s, d: D.key_renames(bronze(s, d)), f"SELECT DISTINCT k AS key, {_snake('k')} AS normalized FROM {_pairs_sql} WHERE k <> {_snake('k')}")
add("md_new_fields", lambda s, d: B.drift_metadata_keys(bronze(s, d)).select("column_name"), f"SELECT k AS column_name FROM {_new_keys}")
add("md_field_discovery", lambda s, d: B.metadata_keys(bronze(s, d)).agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("keys")).join(B.quarantine_counts(bronze(s, d)).select("invalid_metadata")), "SELECT (SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT DISTINCT unnest(json_keys(metadata)) AS k FROM bronze WHERE json_valid(metadata))) AS keys, count(*) FILTER (NOT json_ok) AS invalid_metadata FROM parsed")
add("outcome_gap", lambda s, d: D.outcome_gap(bronze(s, d), ("venda_fechada",)), "SELECT count(*) FILTER (contains(conversation_outcome, 'negoci')) AS uncovered, count(*) FILTER (contains(conversation_outcome, 'negoci')) AS rows FROM bronze")
# --- streaming ----------------------------------------------------------------------------------------------------------
add("stream_ingest", lambda s, d: replay_ingest(s, bronze(s, d)), "SELECT DISTINCT message_id FROM bronze")
add("stream_refresh", lambda s, d: replay_refresh(s, bronze(s, d)).select("lead_key", "message_count", "conversation_count", "latest_outcome"), "SELECT lead_key, message_count, conversation_count, latest_outcome FROM leads")
add("stream_idle", lambda s, d: replay_idle(s, bronze(s, d)), "SELECT count(DISTINCT message_id) AS rows, 1 AS batches, count(*) AS rows_read FROM bronze")
_back = lambda: F.coalesce((F.substring("message_id", 12, 1) == "4") & (F.col("timestamp") < "2024-01-20"), F.lit(False))
_back_sql = """coalesce(substr(message_id, 12, 1) = '4' AND "timestamp" < TIMESTAMP '2024-01-20', FALSE)"""
add("stream_late", lambda s, d: replay_late(s, bronze(s, d), _back()), f"""SELECT message_id, CASE WHEN "timestamp" IS NULL THEN 'invalid_timestamp' WHEN {_back_sql} AND epoch_ms("timestamp") <= (SELECT max(epoch_ms("timestamp")) - 86400000 FROM bronze WHERE NOT {_back_sql}) THEN 'late' ELSE 'stored' END AS outcome FROM bronze""")
# --- sorts, limits, unions ----------------------------------------------------------------------------------------------
add("sort_silver_messages", lambda s, d: silver(s, d).orderBy("conversation_id", "timestamp", "message_id").select("conversation_id", "timestamp", "message_id"), """SELECT conversation_id, "timestamp", message_id FROM silver ORDER BY ALL""")
add("sort_gold_messages", lambda s, d: silver(s, d).orderBy("lead_key", "timestamp", "conversation_id", "message_id").select("lead_key", "timestamp", "message_id"), """SELECT lead_key, "timestamp", message_id FROM silver""")
add("sort_enrichment", lambda s, d: semantics(s, d).orderBy("lead_key", "conversation_last_message_at", "conversation_id").select("lead_key", "conversation_last_message_at", "conversation_id"), "SELECT lead_key, conversation_last_message_at, conversation_id FROM semantics")
add("topk_values", lambda s, d: B.top_values(bronze(s, d), "message_body"), "SELECT message_body AS value, count(*) AS count FROM bronze GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10")
add("sample_bounded", lambda s, d: bounded_sample(bronze(s, d).filter("timestamp IS NULL").withColumn("message_id", F.when(F.substring("message_id", 12, 1) != "0", F.col("message_id"))), "message_id"), """SELECT DISTINCT coalesce(CASE WHEN substr(message_id, 12, 1) <> '0' THEN message_id END, '<null>') AS key FROM bronze WHERE "timestamp" IS NULL ORDER BY 1 LIMIT 5""")
add("set_union_blocks", lambda s, d: G.gold_macro(gold(s, d)).select("dimension", "dimension_value", "lead_count"), f"SELECT dimension, dimension_value, lead_count FROM macro UNION ALL SELECT dimension, dimension_value, lead_count FROM ({_numeric})")
