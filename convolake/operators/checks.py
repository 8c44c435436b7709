"""Data-quality checks: each is one row (layer, check, status, violating_rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.text import unmasked_classes
from convolake.operators.common import any_flag, smallest
from convolake.operators.gold import audience_of, with_measures, with_segments


def results(df: DataFrame, layer: str, checks: dict[str, Column]) -> DataFrame:
    """All checks of a table from one aggregation; a check is an aggregate that counts violations."""
    one = df.agg(*[F.coalesce(v.cast("long"), F.lit(0)).alias(k) for k, v in checks.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").alias("violating_rows")) for k in checks])).alias("x")
    return one.select(rows).select(F.lit(layer).alias("layer"), "x.check", F.when(F.col("x.violating_rows") == 0, "passed").otherwise("failed").alias("status"), "x.violating_rows")


def columns_result(df: DataFrame, layer: str, required: tuple[str, ...]) -> DataFrame:
    """Required columns that a table lacks; the schema says it, no row is read."""
    missing = [c for c in required if c not in df.columns]
    row = (layer, "required_columns", "failed" if missing else "passed", len(missing))
    return df.sparkSession.createDataFrame([row], "layer string, check string, status string, violating_rows long")


def violating_keys(df: DataFrame, layer: str, key: str, checks: dict[str, Column], n: int = 5) -> DataFrame:
    """Of checks on single rows (conditions that hold for violations): violating rows and the n smallest of their keys."""
    found = df.select(F.coalesce(F.col(key).cast("string"), F.lit("<null>")).alias("key"), F.explode(F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in checks.items()]))).alias("check"))
    counts = found.groupBy("check").agg(F.count("*").alias("violating_rows"))
    named = df.sparkSession.createDataFrame([(k,) for k in checks], "check string")
    d = named.join(counts, "check", "left").join(smallest(found, "check", "key", n), "check", "left")
    rows = F.coalesce("violating_rows", F.lit(0)).cast("long")
    return d.select(F.lit(layer).alias("layer"), "check", F.when(rows == 0, "passed").otherwise("failed").alias("status"), rows.alias("violating_rows"), F.coalesce("samples", F.lit("")).alias("samples"))


def repeated(*keys: str) -> Column:
    """Rows beyond the first of each key (nulls are a value)."""
    return F.count("*") - F.count_distinct(F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]))


def outside(column: str, domain: tuple[str, ...]) -> Column:
    return F.count_if(~F.coalesce(F.col(column).isin(*domain), F.lit(False)))


def bronze_checks(bronze: DataFrame) -> DataFrame:
    return results(bronze, "bronze", {"message_id_unique": repeated("message_id"), "channel_supported": outside("channel", C.DOMAINS["channel"])})


def first_outbound(bronze: DataFrame) -> DataFrame:
    """One row: conversations, and those whose first message is not outbound (a diagnosis, never a failure)."""
    from convolake.operators.common import ordered

    first = bronze.groupBy("conversation_id").agg(F.min_by("direction", ordered("timestamp", "message_id")).alias("direction"))
    bad = ~F.col("direction").eqNullSafe(F.lit("outbound"))
    few = first.filter(bad).select(F.coalesce("conversation_id", F.lit("<null>")).alias("c")).orderBy("c").limit(5).agg(F.array_join(F.array_sort(F.collect_list("c")), ",").alias("sample"))
    return first.agg(F.count("*").alias("conversations"), F.count_if(bad).alias("violating")).join(F.broadcast(few))  # one row each


def leaks(df: DataFrame, columns: tuple[str, ...], key: str, classes=C.FLAGS) -> DataFrame:
    """column, class, rows and the first key of unmasked personal data in text columns."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("x")
    d = df.select(F.col(key).alias("key"), cells).select("key", "x.*").select("key", "column_name", F.explode(unmasked_classes(F.col("value"), classes)).alias("pii_class"))
    return d.groupBy("column_name", "pii_class").agg(F.count("*").alias("rows"), F.min("key").alias("first_key"))


def leaking_rows(*columns: str) -> Column:
    return F.count_if(reduce(lambda a, b: a | b, [F.size(unmasked_classes(F.col(c))) > 0 for c in columns]))


def silver_lead_checks(leads: DataFrame) -> DataFrame:
    return results(
        leads,
        "silver_leads",
        {
            "lead_key_unique": repeated("lead_key"),
            "timestamps_present": F.count_if(F.col("first_seen_at").isNull() | F.col("last_seen_at").isNull()),
            "counts_not_negative": F.count_if((F.col("conversation_count") < 0) | (F.col("message_count") < 0)),
            "no_leaks": leaking_rows("canonical_lead_name_masked", "lead_contact_ref"),
        },
    )


def silver_message_checks(messages: DataFrame) -> DataFrame:
    vehicle = F.col("vehicle_make").isNotNull() | F.col("vehicle_model").isNotNull() | F.col("vehicle_year").isNotNull() | F.col("contains_plate")
    leak = lambda k: F.count_if(F.size(unmasked_classes(F.col("message_body_masked"), (k,))) > 0)
    return results(
        messages,
        "silver_messages",
        {
            "timestamp_present": F.count_if(F.col("timestamp").isNull()),
            "dedupe_keys_unique": repeated(*C.DEDUPE_KEYS),
            **{f"no_{k}_leak": leak(k) for k in C.FLAGS},
            "vehicle_consistent": F.count_if(~vehicle.eqNullSafe(F.col("mentions_vehicle"))),
        },
    )


def gold_domain_checks(gold: DataFrame) -> DataFrame:
    return results(gold, "gold", {f"domain_{c}": outside(c, d) for c, d in C.GOLD_DOMAINS.items()})


def gold_key_checks(gold: DataFrame) -> DataFrame:
    c = F.col
    return results(
        gold,
        "gold",
        {
            "lead_key_unique": repeated("lead_key"),
            "counts_not_negative": F.count_if((c("total_messages") < 0) | (c("inbound_messages") < 0) | (c("outbound_messages") < 0)),
            "duplicates_not_negative": F.count_if(c("duplicate_events_removed") < 0),
            "persona_present": F.count_if(c("persona_profile").isNull()),
            "closure_flag": F.count_if(c("has_closed_outcome") != (c("closure_outcome_group") == "fechado")),
            "provider_needs_email": F.count_if(c("dominant_email_provider").isNotNull() & ~c("contains_email")),
            "persona_audience": F.count_if(~audience_of(c("persona_profile")).eqNullSafe(c("audience_segment"))),
            "provenance": outside("intent_stage_source_family", ("llm_provider", "deterministic_fallback", "mixed")),
            "sentiment_support": F.count_if((c("conversation_sentiment_label") == "sem_evidencia") != (c("conversation_sentiment_support") == "sem_evidencia")),
            "sentiment_evidence": F.count_if((c("positive_tone_hits") + c("negative_tone_hits") == 0) & (c("conversation_sentiment_label") != "sem_evidencia")),
        },
    )


def _sides(left: DataFrame, right: DataFrame, columns: tuple[str, ...], more: tuple[str, ...] = ()) -> DataFrame:
    """Both tables by key: l_ and r_ columns (of left more ones, as they are), and __l and __r where a side has the key."""
    there = left.select("lead_key", *[F.col(c).alias(f"l_{c}") for c in columns], *more, F.lit(True).alias("__l"))
    other = right.select("lead_key", *[F.col(c).alias(f"r_{c}") for c in columns], F.lit(True).alias("__r"))
    return there.join(other, "lead_key", "full")


def _side_checks(columns: tuple[str, ...]) -> dict[str, Column]:
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    return {
        "keys_missing_right": F.count_if(F.col("__r").isNull()),
        "keys_missing_left": F.count_if(F.col("__l").isNull()),
        **{f"same_{c}": F.count_if(both & ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))) for c in columns},
    }


def reconciled(left: DataFrame, right: DataFrame, layer: str, columns: tuple[str, ...]) -> DataFrame:
    """Keys that miss on either side, and null-safe differences of columns on common keys."""
    return results(_sides(left, right, columns), layer, _side_checks(columns))


def silver_reconcile(leads: DataFrame, messages: DataFrame) -> DataFrame:
    flags = {"has_vehicle_signal": "mentions_vehicle", "has_competitor_signal": "mentions_competitor", "has_sinistro_signal": "mentions_sinistro", **{f"has_{k}_signal": f"contains_{k}" for k in C.FLAGS}}
    again = messages.groupBy("lead_key").agg(
        F.min("timestamp").alias("first_seen_at"),
        F.max("timestamp").alias("last_seen_at"),
        F.count_distinct("conversation_id").alias("conversation_count"),
        F.count("*").alias("message_count"),
        *[any_flag(F.col(m)).alias(f) for f, m in flags.items()],
    )
    return reconciled(leads, again, "silver_reconcile", tuple(again.columns[1:]))


#: What gold has from leads, and what it counts and finds in messages.
SEEN = ("first_seen_at", "last_seen_at", "conversation_count")
TOTALS = ("total_messages", "inbound_messages", "outbound_messages", "duplicate_events_removed")
FOUND = {f"contains_{k}": f"contains_{k}" for k in C.FLAGS} | {f"mentioned_{k}": f"mentions_{k}" for k in ("vehicle", "competitor", "sinistro")}


def gold_history(messages: DataFrame) -> DataFrame:
    """What messages say of gold's times, counts and flags, per lead."""
    return messages.groupBy("lead_key").agg(
        F.min("timestamp").alias("first_seen_at"),
        F.max("timestamp").alias("last_seen_at"),
        F.count_distinct("conversation_id").alias("conversation_count"),
        F.count("*").alias("total_messages"),
        F.count_if(F.col("direction") == "inbound").alias("inbound_messages"),
        F.count_if(F.col("direction") == "outbound").alias("outbound_messages"),
        F.sum(F.col("dropped_duplicate_events").cast("long")).alias("duplicate_events_removed"),
        *[any_flag(F.col(m)).alias(f) for f, m in FOUND.items()],
    )


def gold_reconcile(gold: DataFrame, leads: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """Gold against leads and, on keys that both have, against what messages say; inbound and outbound make the total. Without
    messages gold is compared with leads alone."""
    if messages is None:
        return reconciled(gold, leads, "gold_reconcile", SEEN)
    counted = (*SEEN, *TOTALS, *FOUND)
    history = gold_history(messages).select("lead_key", *[F.col(c).alias(f"h_{c}") for c in counted], F.lit(True).alias("__h"))
    directions = F.col("inbound_messages") + F.col("outbound_messages")
    differ = {f"same_history_{c}": F.col("__h").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"h_{c}")) for c in counted}
    differ |= {"same_sum_of_directions": F.col("__h").isNotNull() & ~directions.eqNullSafe(F.col("total_messages")), "keys_missing_messages": F.col("__h").isNull()}
    d = _sides(gold.join(history, "lead_key", "left").withColumns(differ), leads, SEEN, tuple(differ))
    return results(d, "gold_reconcile", _side_checks(SEEN) | {k: F.count_if(F.col("__r").isNotNull() & F.col(k)) for k in differ})


def gold_coherence(gold: DataFrame) -> DataFrame:
    """Classifications of a gold table made by rules alone, compared with the same rules applied again."""
    names = ("engagement_bucket", "response_latency_band", "closure_outcome_group", "price_objection_intensity", "commercial_urgency_signal", "competitor_pressure_level", "lead_temperature", "price_sensitivity", "contact_readiness", "risk_signal")
    kept = gold.withColumns({f"was_{c}": F.col(c) for c in names})
    return results(with_segments(with_measures(kept)), "gold_coherence", {f"same_{c}": F.count_if(~F.col(c).eqNullSafe(F.col(f"was_{c}"))) for c in names})


def macro_checks(macro: DataFrame) -> DataFrame:
    c = F.col
    return results(
        macro,
        "gold_macro",
        {
            "pairs_unique": repeated("dimension", "dimension_value"),
            "share_in_range": F.count_if((c("lead_pct") < 0) | (c("lead_pct") > 1)),
            "count_not_negative": F.count_if(c("lead_count") < 0),
            "rank_from_one": F.count_if(c("rank") < 1),
            "no_nulls": F.count_if(c("dimension").isNull() | c("dimension_value").isNull()),
            "dimensions_present": F.lit(len(C.MACRO_DIMENSIONS)) - F.count_distinct(F.when(c("dimension").isin(*C.MACRO_DIMENSIONS), c("dimension"))),
        },
    )


def conversation_checks(conversations: DataFrame) -> DataFrame:
    return results(conversations, "conversations", {"conversation_id_unique": repeated("conversation_id"), "audience_fits": F.count_if(~audience_of(F.col("persona_profile")).eqNullSafe(F.col("audience_segment")))})


def summary(checks: DataFrame) -> DataFrame:
    failed = F.when(F.col("status") == "failed", F.concat_ws(".", "layer", "check"))
    return checks.agg(F.when(F.count(failed) > 0, "failed").otherwise("passed").alias("status"), F.count("*").alias("checks"), F.array_join(F.array_sort(F.collect_set(failed)), ",").alias("failed"))


#: What to do about a failed check, by the start of its name. Fixed values.
REMEDIES = (("no_", "privacy", "critical", "mask the column and rebuild silver"), ("same_", "consistency", "high", "rebuild the layer"), ("domain_", "vocabulary", "medium", "extend the domain or fix the rule"), ("", "integrity", "high", "inspect the rows"))


def diagnosed(checks: DataFrame) -> DataFrame:
    pick = lambda i: F.coalesce(*[F.when(F.col("check").startswith(r[0]), F.lit(r[i])) for r in REMEDIES])
    return checks.filter("status = 'failed'").select("layer", "check", pick(1).alias("kind"), pick(2).alias("severity"), pick(3).alias("remedy"))
