"""Silver: deduplicated messages with context and signals, and leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.signals import mention_signals, message_signals
from convolake.functions.text import mask_body, mask_digits, mask_name, match_norm, safe_string
from convolake.operators.bronze import parse_metadata, passthrough_names, quarantine
from convolake.operators.common import any_flag, first_by, last_by, non_empty, ordered, sorted_set

TIME = ("timestamp", "message_id")
LEAD_ORDER = ("conversation_id", "timestamp", "message_id")


def conversation_context(df: DataFrame) -> DataFrame:
    """First known inbound name, outbound name and inbound phone of each conversation, on each of its rows. The names are
    found by partial aggregation and joined back, so that a conversation with many rows is no hot spot."""
    key, inbound, outbound = ordered(*TIME), F.col("direction") == "inbound", F.col("direction") == "outbound"
    context = df.filter("conversation_id IS NOT NULL").groupBy("conversation_id").agg(
        first_by(F.col("sender_name"), key, inbound).alias("conversation_lead_name"),
        first_by(F.col("sender_name"), key, outbound).alias("conversation_agent_name"),
        first_by(F.col("sender_phone"), key, inbound).alias("conversation_lead_phone"),
    )
    return df.join(context, "conversation_id", "left").withColumns({c: safe_string(F.col(c)) for c in context.columns[1:]})


def dedup_events(df: DataFrame, keys=C.DEDUPE_KEYS) -> DataFrame:
    """One row for each event: the gravest delivery status, then the smallest message_id."""
    status = F.create_map(*[F.lit(x) for kv in C.STATUS_PRIORITY.items() for x in kv])
    w = Window.partitionBy(*keys)
    rank = F.row_number().over(w.orderBy(F.coalesce(status[F.col("status")], F.lit(-1)).desc(), F.asc_nulls_last("message_id")))
    d = df.withColumns({"__rank": rank, "duplicate_event_group_size": F.count("*").over(w)}).filter("__rank = 1").drop("__rank")
    return d.withColumns({"had_status_duplication": F.col("duplicate_event_group_size") > 1, "dropped_duplicate_events": F.col("duplicate_event_group_size") - 1})


def stable_key(prefix: str, *parts: Column) -> Column:
    joined = F.concat_ws("|", *[F.nullif(match_norm(p), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.coalesce(F.nullif(joined, F.lit("")), F.lit("unknown")), 256), 1, 16))


def lead_context(df: DataFrame) -> DataFrame:
    phone, name = F.col("conversation_lead_phone"), F.col("conversation_lead_name")
    return df.withColumns(
        {
            "lead_phone_masked": mask_digits(phone),
            "lead_name_raw": name,
            "lead_key": stable_key("lead", F.when(phone != "", phone).otherwise(name), F.col("metadata_city"), F.col("metadata_state")),
        }
    )


def with_signals(df: DataFrame) -> DataFrame:
    # the normalised body is a column of its own, so that the many patterns share it
    return df.withColumn("__words", match_norm(F.col("message_body"))).withColumns(
        {
            "sender_name_normalized": match_norm(F.col("sender_name")),
            "sender_name_masked": mask_name(F.col("sender_name")),
            "sender_phone_masked": mask_digits(F.col("sender_phone")),
            "message_body_masked": mask_body(safe_string(F.col("message_body")), F.col("sender_name"), F.col("conversation_lead_name"), F.col("conversation_agent_name")),
            **message_signals(F.col("__words")),
        }
    ).drop("__words").withColumns(mention_signals())


def silver_messages(bronze: DataFrame) -> DataFrame:
    """From raw messages (quarantined ones left out) to silver messages."""
    good, _ = quarantine(bronze)
    d = lead_context(with_signals(dedup_events(conversation_context(passthrough_names(parse_metadata(good, accepted=True))))))
    return d.withColumns({"is_inbound": F.coalesce(F.col("direction") == "inbound", F.lit(False)), "is_outbound": F.coalesce(F.col("direction") == "outbound", F.lit(False))})


#: What silver_leads() reads of a message; whoever stores messages for it alone can leave the others out.
LEAD_COLUMNS = (
    "lead_key", "message_id", "conversation_id", "timestamp", "lead_name_raw", "lead_phone_masked", "metadata_city", "metadata_state",
    "metadata_lead_source", "metadata_response_time_sec", "metadata_is_business_hours", "campaign_id", "conversation_outcome",
    "mentions_vehicle", "mentions_competitor", "mentions_sinistro", *[f"contains_{k}" for k in C.FLAGS],
    "vehicle_make", "vehicle_model", "vehicle_year", "competitor_mentioned", "quoted_price",
)


def silver_leads(messages: DataFrame) -> DataFrame:
    """One row per lead: its aggregates in one pass; first and last by conversation, time and message. Distinct counts are
    made beside them from three columns: within one aggregation Spark would expand every row to three, with a group of all
    aggregates for each message. Messages are so read twice: hold them where they are dear to make."""
    key = ordered(*LEAD_ORDER)
    first = lambda c: first_by(non_empty(F.col(c)), key)
    observed = {f"{c}_observed": F.coalesce(first_by(F.col(c), key), F.lit("")) for c in ("vehicle_make", "vehicle_model", "vehicle_year")}
    flags = {"vehicle": "mentions_vehicle", "competitor": "mentions_competitor", "sinistro": "mentions_sinistro"} | {k: f"contains_{k}" for k in C.FLAGS}
    leads = messages.groupBy("lead_key").agg(
        F.coalesce(mask_name(first("lead_name_raw")), F.lit("")).alias("canonical_lead_name_masked"),
        F.coalesce(first("lead_phone_masked"), F.lit("")).alias("lead_contact_ref"),
        F.coalesce(first("metadata_city"), F.lit("")).alias("city"),
        F.coalesce(first("metadata_state"), F.lit("")).alias("state"),
        F.min("timestamp").alias("first_seen_at"),
        F.max("timestamp").alias("last_seen_at"),
        sorted_set(F.col("campaign_id")).alias("observed_campaign_ids"),
        sorted_set(F.col("metadata_lead_source")).alias("observed_lead_sources"),
        sorted_set(F.col("conversation_outcome")).alias("observed_outcomes"),
        *[any_flag(F.col(c)).alias(f"has_{k}_signal") for k, c in flags.items()],
        F.coalesce(first("campaign_id"), F.lit("")).alias("primary_campaign_id"),
        F.coalesce(last_by(non_empty(F.col("conversation_outcome")), key), F.lit("")).alias("latest_outcome"),
        *[c.alias(n) for n, c in observed.items()],
        F.coalesce(first_by(F.col("competitor_mentioned"), key), F.lit("")).alias("primary_competitor_observed"),
        F.min("quoted_price").alias("quoted_price_min"),
        F.max("quoted_price").alias("quoted_price_max"),
        last_by(F.col("quoted_price"), key).alias("quoted_price_last"),
        F.avg("metadata_response_time_sec").alias("avg_response_time_sec"),
        F.avg(F.col("metadata_is_business_hours").cast("int")).alias("business_hours_ratio"),
    )
    counts = messages.groupBy(F.col("lead_key").alias("__lead")).agg(F.count_distinct("conversation_id").alias("conversation_count"), F.count_distinct("message_id").alias("message_count"))
    leads = leads.join(counts, F.col("lead_key").eqNullSafe(F.col("__lead"))).withColumn("lead_contact_ref", F.coalesce(non_empty(F.col("lead_contact_ref")), F.col("lead_key")))
    at = leads.columns.index("last_seen_at") + 1
    rest = [c for c in leads.columns if c not in (*counts.columns,)]
    return leads.select(*rest[:at], "conversation_count", "message_count", *rest[at:])


#: Rules for further columns per lead.
def extra_aggregates(messages: DataFrame, rules: dict[str, str]) -> DataFrame:
    key = ordered(*LEAD_ORDER)
    how = {
        "first_non_null": lambda c: first_by(c, key),
        "last_non_null": lambda c: last_by(c, key),
        "max": F.max,
        "mean": F.avg,
        "sum": F.sum,
        "any": any_flag,
        "all": lambda c: F.bool_and(F.coalesce(c, F.lit(False))),
        "mode": lambda c: F.mode(c, True),
    }
    return messages.groupBy("lead_key").agg(*[how[r](F.col(c)).alias(f"{c}_{r}") for c, r in rules.items()])
