"""Gold: leads with message aggregates, segments and consolidated semantics, and the macro table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.signals import sentiment_label, sentiment_support, tone_hits
from convolake.functions.text import match_norm, safe_string
from convolake.operators.common import any_flag, last_by, ordered

ORDER = ("timestamp", "conversation_id", "message_id")


#: What message_aggregates() reads of a message.
MESSAGE_COLUMNS = (
    "lead_key", "message_id", "conversation_id", "timestamp", "message_body", "is_inbound", "is_outbound", "dropped_duplicate_events",
    *[f"contains_{k}" for k in C.FLAGS], "mentions_vehicle", "mentions_competitor", "mentions_sinistro", "quoted_price", "email_provider",
    "competitor_mentioned_inbound", "price_objection_signal_inbound", "urgency_strength_inbound", "mentions_competitor_inbound",
    "competitor_comparison_signal_inbound", "vehicle_make", "vehicle_model", "vehicle_year", "sinistro_type",
)


def message_aggregates(messages: DataFrame) -> DataFrame:
    """Counts, flags and last values per lead, vehicle and claim context included, in one aggregation. Published messages
    have no body; their tone is that of the masked one."""
    key = ordered(*ORDER)
    said = "message_body" if "message_body" in messages.columns else "message_body_masked"
    body = F.when(F.col("is_inbound"), safe_string(F.col(said))).otherwise("")
    words = F.col("__words")  # a column of its own, so that both tones share it and no lambda is interpreted
    total = lambda c: F.sum(F.col(c).cast("long"))
    return messages.withColumn("__words", match_norm(body)).groupBy("lead_key").agg(
        F.count("message_id").alias("total_messages"),
        total("is_inbound").alias("inbound_messages"),
        total("is_outbound").alias("outbound_messages"),
        total("dropped_duplicate_events").alias("duplicate_events_removed"),
        *[any_flag(F.col(f"contains_{k}")).alias(f"contains_{k}") for k in C.FLAGS],
        *[any_flag(F.col(f"mentions_{k}")).alias(f"mentioned_{k}") for k in ("vehicle", "competitor", "sinistro")],
        F.avg("quoted_price").alias("avg_quoted_price"),
        last_by(F.col("competitor_mentioned_inbound"), key).alias("primary_competitor"),
        last_by(F.col("email_provider"), key).alias("email_provider_seen"),
        F.count("quoted_price").alias("quoted_price_mentions"),
        total("price_objection_signal_inbound").alias("price_objection_hits"),
        F.count_if(F.col("urgency_strength_inbound") > 0).alias("urgency_hits"),
        F.max("urgency_strength_inbound").cast("long").alias("urgency_strength_max"),
        total("mentions_competitor_inbound").alias("competitor_mentions_count"),
        total("competitor_comparison_signal_inbound").alias("competitor_comparison_hits"),
        F.sum(tone_hits(body, C.POSITIVE, words)).alias("positive_tone_hits"),
        F.sum(tone_hits(body, C.NEGATIVE, words)).alias("negative_tone_hits"),
        *[last_by(F.col(c), key, F.col("mentions_vehicle")).alias(c) for c in ("vehicle_make", "vehicle_model", "vehicle_year")],
        last_by(F.col("sinistro_type"), key, F.col("mentions_sinistro")).alias("primary_sinistro_type"),
    )


def outcome_group(outcomes: Column) -> Column:
    known = F.transform(outcomes, lambda o: F.replace(match_norm(o), F.lit(" "), F.lit("_")))
    meets = lambda names: F.arrays_overlap(known, F.array(*[F.lit(n) for n in names]))
    return F.when(meets(C.CLOSED), "fechado").when(meets(C.LOST), "perdido").otherwise("aberto")


def objection_level(hits: Column, competitor: Column, quotes: Column) -> Column:
    strong = (hits >= 2) | ((hits >= 1) & (competitor >= 1)) | (quotes >= 2)
    return F.when(strong, "forte").when((hits >= 1) | (quotes >= 1) | (competitor >= 1), "leve").otherwise("nenhuma")


def urgency_level(strength: Column, hits: Column) -> Column:
    return F.when((strength >= 2) | (hits >= 2), "alta").when(strength >= 1, "moderada").otherwise("nenhuma")


def pressure_level(primary: Column, mentions: Column, comparisons: Column) -> Column:
    nothing = (F.trim(safe_string(primary)) == "") & (mentions == 0) & (comparisons == 0)
    return F.when(nothing, "nenhuma").when((comparisons >= 1) | (mentions >= 2), "alta").otherwise("leve")


def latency_band(seconds: Column) -> Column:
    return F.when(seconds.isNull(), "sem_evidencia").when(seconds <= 300, "rapida").when(seconds <= 1800, "moderada").otherwise("lenta")


def engagement(total: Column) -> Column:
    return F.when(total <= 0, None).when(total <= 4, "lead_frio").when(total <= 10, "curta").when(total <= 20, "media").when(total > 20, "longa")


def audience_of(persona: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in C.AUDIENCE_OF.items() for x in kv])[persona]


def with_measures(gold: DataFrame) -> DataFrame:
    """What the segments are made of."""
    c = F.col
    hours = F.timestamp_diff("MICROSECOND", "first_seen_at", "last_seen_at") / 3.6e9
    return gold.withColumns(
        {
            "engagement_bucket": engagement(c("total_messages")),
            "data_shared_score": reduce(lambda a, b: a + b, [c(f"contains_{k}").cast("int") for k in C.FLAGS]),
            "lead_lifecycle_hours": hours,
            "business_hours_message_ratio": c("business_hours_ratio"),
            "response_latency_band": latency_band(c("avg_response_time_sec")),
            "closure_outcome_group": outcome_group(c("observed_outcomes")),
            "dominant_email_provider": F.when(c("contains_email"), c("email_provider_seen")),
            "price_objection_intensity": objection_level(c("price_objection_hits"), c("competitor_mentions_count"), c("quoted_price_mentions")),
            "commercial_urgency_signal": urgency_level(c("urgency_strength_max"), c("urgency_hits")),
            "competitor_pressure_level": pressure_level(c("primary_competitor"), c("competitor_mentions_count"), c("competitor_comparison_hits")),
            "conversation_sentiment_label": sentiment_label(c("positive_tone_hits"), c("negative_tone_hits")),
            "conversation_sentiment_support": sentiment_support(c("positive_tone_hits"), c("negative_tone_hits")),
        }
    ).withColumn("has_closed_outcome", c("closure_outcome_group") == "fechado")


def with_segments(gold: DataFrame, negotiation_label: str | None = None) -> DataFrame:
    """Segments by rule precedence: the rule that is asked first wins."""
    c = F.col
    score, claim, rival, quoted = c("data_shared_score"), c("mentioned_sinistro"), c("mentioned_competitor"), c("avg_quoted_price").isNotNull()
    hot = F.coalesce(c("engagement_bucket").isin("media", "longa"), F.lit(False)) | (score >= 2)
    intent = F.when(quoted & ~claim, "cotacao_ativa").when(rival & ~claim, "pesquisa_mercado").when(claim, "pos_sinistro")
    if negotiation_label:
        intent = intent.when(F.lower("latest_outcome").contains("negoci"), negotiation_label)
    d = gold.withColumns(
        {
            "lead_temperature": F.when(hot, "quente").when((c("engagement_bucket") == "lead_frio") & (score == 0), "frio").otherwise("morno"),
            "price_sensitivity": F.when(rival | quoted, "alta").otherwise("baixa"),
            "contact_readiness": F.when(score >= 2, "alta").when(score == 1, "media").otherwise("baixa"),
            "intent_stage": intent.otherwise("descoberta_inicial"),
            "risk_signal": F.when(claim & c("contains_cpf"), "alto").when(claim | (c("duplicate_events_removed") > 0), "medio").otherwise("baixo"),
        }
    )
    engaged = (c("lead_temperature") == "quente") & (c("contact_readiness") == "alta")
    persona = F.when(engaged, "lead_engajado_com_dados").when(rival & quoted, "cotador_comparador").when(claim, "cliente_pos_sinistro").otherwise("lead_frio")
    d = d.withColumn("persona_profile", persona)
    return d.withColumn("audience_segment", audience_of(c("persona_profile")))


#: Columns that conversations may decide, where each is from, and measures that are not published. Fixed values.
SEMANTIC = ("intent_stage", "persona_profile", "audience_segment", "conversation_sentiment_label", "conversation_sentiment_support")
SOURCES = ("intent_stage_source_family", "persona_profile_source_family", "audience_segment_source_family", "conversation_sentiment_source_family")


def overlay(gold: DataFrame, consolidated: DataFrame) -> DataFrame:
    """Consolidated semantics where they say something, else the lead's own; an impossible pair of persona and audience
    falls back as a whole."""
    from_conversations = consolidated.select("lead_key", *[F.col(x).alias(f"__{x}") for x in (*SEMANTIC, *SOURCES)])
    d = gold.join(from_conversations, "lead_key", "left")
    said = lambda x: F.nullif(F.trim(f"__{x}"), F.lit(""))
    bad = F.coalesce((F.trim("__persona_profile") == "") | (F.trim("__audience_segment") == "") | ~F.coalesce(audience_of(F.col("__persona_profile")), F.lit("")).eqNullSafe(F.col("__audience_segment")), F.lit(True))
    pair = lambda x, other: F.when(bad, other).otherwise(F.coalesce(said(x), other))
    new = {x: F.coalesce(said(x), F.col(x)) for x in SEMANTIC if x not in ("persona_profile", "audience_segment")}
    new |= {x: pair(x, F.col(x)) for x in ("persona_profile", "audience_segment")}
    fallback = F.lit("deterministic_fallback")
    new |= {x: F.coalesce(said(x), fallback) for x in SOURCES}
    new |= {x: F.when(bad, fallback).otherwise(F.coalesce(said(x), fallback)) for x in ("persona_profile_source_family", "audience_segment_source_family")}
    return d.withColumns(new).drop(*from_conversations.columns[1:])


INTERNAL = ("quoted_price_mentions", "price_objection_hits", "urgency_hits", "urgency_strength_max", "competitor_mentions_count", "competitor_comparison_hits", "lead_lifecycle_hours")


def gold_leads(leads: DataFrame, messages: DataFrame, consolidated: DataFrame | None = None) -> DataFrame:
    """The gold table, intermediate measures included (public_gold() drops them)."""
    d = with_segments(with_measures(leads.join(message_aggregates(messages), "lead_key", "left")))
    if consolidated is None:
        return d.withColumns({x: F.lit("deterministic_fallback") for x in SOURCES})
    return overlay(d, consolidated)


def hidden_columns(gold: DataFrame, promoted: tuple[str, ...] = ()) -> list[str]:
    """Passthrough columns that were not promoted (by either name)."""
    return [c for c in gold.columns if c.startswith(C.PASSTHROUGH) and c not in promoted and c.removeprefix(C.PASSTHROUGH) not in promoted]


def public_gold(gold: DataFrame, promoted: tuple[str, ...] = ()) -> DataFrame:
    """Without intermediate measures and passthrough columns that were not promoted."""
    return gold.drop(*INTERNAL, *hidden_columns(gold, promoted))


def partition_events(gold: DataFrame, promoted: tuple[str, ...] = ()) -> DataFrame:
    """A drift event for each passthrough column that public_gold() drops, with the rows in which it was filled."""
    hidden = hidden_columns(gold, promoted)
    schema = "column_name string, drift_class string, policy string, reason string, filled_rows long"
    if not hidden:
        return gold.sparkSession.createDataFrame([], schema)
    one = gold.agg(*[F.count(c).alias(c) for c in hidden])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled_rows")) for c in hidden])).alias("x")
    return one.select(rows).select("x.column_name", F.lit("unknown").alias("drift_class"), F.lit("passthrough_with_alert").alias("policy"), F.lit("not_in_gold_contract").alias("reason"), "x.filled_rows")


def dimension_counts(gold: DataFrame, dimensions=C.MACRO_DIMENSIONS) -> DataFrame:
    """dimension, value, leads, share of all leads, rank: all dimensions in one scan. Missing columns and empty tables
    get one row that says so."""
    spark = gold.sparkSession
    there = [d for d in dimensions if d in gold.columns]
    value = lambda d: F.coalesce(F.nullif(F.col(d), F.lit("")), F.lit("sem_informacao"))
    pairs = [F.struct(F.lit(d).alias("dimension"), value(d).alias("dimension_value"), (F.col("contains_email") if d == "dominant_email_provider" else F.lit(True)).alias("counts")) for d in there]
    counts = gold.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter("counts").groupBy("dimension", "dimension_value").agg(F.count("*").alias("lead_count"))
    total = gold.agg(F.count("*").alias("total"))
    named = spark.createDataFrame([(d, d in there) for d in dimensions], "dimension string, there boolean")
    d = named.join(counts, "dimension", "left").join(F.broadcast(total))  # the total is one row
    w = Window.partitionBy("dimension").orderBy(F.desc("lead_count"), "dimension_value")
    return d.select(
        "dimension",
        F.coalesce("dimension_value", F.when(F.col("there"), "sem_informacao").otherwise("sem_contrato")).alias("dimension_value"),
        F.coalesce("lead_count", F.lit(0)).alias("lead_count"),
        F.when(F.col("total") > 0, F.coalesce("lead_count", F.lit(0)) / F.col("total")).otherwise(0.0).alias("lead_pct"),
        F.row_number().over(w).cast("long").alias("rank"),
        F.lit(None).cast("double").alias("metric_value"),
    )


def numeric_snapshot(gold: DataFrame) -> DataFrame:
    """Means and rates as rows, unrounded."""
    share = lambda c: F.avg(F.col(c).cast("int"))
    metrics = {
        "avg_total_messages": F.avg("total_messages"),
        "avg_conversation_count": F.avg("conversation_count"),
        "avg_data_shared_score": F.avg("data_shared_score"),
        "total_leads": F.count("*").cast("double"),
        "leads_with_email_pct": share("contains_email"),
        "leads_with_competitor_signal_pct": share("mentioned_competitor"),
        "leads_with_sinistro_signal_pct": share("mentioned_sinistro"),
        "leads_closed_pct": share("has_closed_outcome"),
    }
    one = gold.agg(*[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in metrics.items()])
    rows = F.posexplode(F.array(*[F.struct(F.lit(k).alias("dimension_value"), F.col(k).alias("metric_value")) for k in metrics])).alias("at", "m")
    return one.select(rows).select(
        F.lit("numeric_snapshot").alias("dimension"), "m.dimension_value", F.lit(0).cast("long").alias("lead_count"), F.lit(0.0).alias("lead_pct"), (F.col("at") + 1).cast("long").alias("rank"), "m.metric_value"
    )


def gold_macro(gold: DataFrame) -> DataFrame:
    return dimension_counts(gold).unionByName(numeric_snapshot(gold))
