"""Conversations: features, rule-based semantics, cached results, and semantics consolidated per lead."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.signals import sentiment_label, sentiment_support, tone_hits
from convolake.functions.text import match_norm, safe_string, unmasked_classes
from convolake.operators.common import any_flag, last_by, ordered
from convolake.operators.gold import audience_of, latency_band, objection_level, pressure_level, urgency_level

TIME = ("timestamp", "message_id")


#: What conversation_features() and conversation_input_hash() read of a message.
MESSAGE_COLUMNS = (
    "conversation_id", "lead_key", "message_id", "timestamp", "direction", "message_type", "message_body_masked", "quoted_price", "metadata_response_time_sec",
    "mentions_competitor_inbound", "competitor_comparison_signal_inbound", "competitor_mentioned_inbound", "price_objection_signal_inbound",
    "urgency_strength_inbound", *[f"contains_{k}" for k in C.FLAGS], "mentions_vehicle", "mentions_sinistro", "mentions_competitor",
)


def conversation_features(messages: DataFrame) -> DataFrame:
    """One row per conversation, a model's input: counts and signals, and its masked messages in order (an array as long as the
    conversation); its lead is that of its first message. Where messages are dropped Spark gathers none."""
    key, inbound = ordered(*TIME), F.col("direction") == "inbound"
    body = F.when(inbound, F.col("message_body_masked")).otherwise("")
    words = F.col("__words")
    said = {"direction": "direction", "message_type": "message_type", "text": "message_body_masked"}
    message = F.struct(key.alias("at"), *[safe_string(F.col(c)).alias(n) for n, c in said.items()])
    shown = lambda m: F.struct(m["at"]["timestamp"].alias("timestamp"), *[m[n].alias(n) for n in said])
    return messages.withColumn("__words", match_norm(body)).groupBy("conversation_id").agg(
        F.min_by("lead_key", key).alias("lead_key"),
        F.min("timestamp").alias("conversation_first_message_at"),
        F.max("timestamp").alias("conversation_last_message_at"),
        F.count("*").alias("message_count"),
        F.count_if(inbound).alias("inbound_count"),
        F.count_if(F.col("direction") == "outbound").alias("outbound_count"),
        F.sum(tone_hits(body, C.POSITIVE, words)).alias("positive_tone_hits"),
        F.sum(tone_hits(body, C.NEGATIVE, words)).alias("negative_tone_hits"),
        F.count("quoted_price").alias("quoted_price_mentions"),
        last_by(F.col("quoted_price"), key).alias("last_price"),
        F.avg("metadata_response_time_sec").alias("avg_response_time_sec"),
        F.count_if("mentions_competitor_inbound").alias("competitor_mentions_count"),
        F.count_if("competitor_comparison_signal_inbound").alias("competitor_comparison_hits"),
        last_by(F.col("competitor_mentioned_inbound"), key).alias("primary_competitor"),
        F.count_if("price_objection_signal_inbound").alias("price_objection_hits"),
        F.count_if(F.col("urgency_strength_inbound") > 0).alias("urgency_hits"),
        F.max("urgency_strength_inbound").alias("urgency_strength_max"),
        *[any_flag(F.col(f"contains_{k}")).alias(f"contains_{k}") for k in C.FLAGS],
        any_flag(F.col("mentions_vehicle")).alias("has_vehicle_signal"),
        any_flag(F.col("mentions_sinistro")).alias("has_sinistro_signal"),
        any_flag(F.col("mentions_competitor")).alias("has_competitor_signal"),
        F.transform(F.array_sort(F.collect_list(message)), shown).alias("messages"),
    ).withColumn("response_latency_band", latency_band(F.col("avg_response_time_sec")))


def conversation_input_hash(messages: DataFrame) -> DataFrame:
    """A stable hash of each conversation's input, from sums over its messages (no conversation is gathered)."""
    h = F.xxhash64("timestamp", "message_id", "direction", "message_body_masked")
    sums = messages.groupBy("conversation_id").agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s"))
    return sums.select("conversation_id", F.sha2(F.concat_ws("|", "conversation_id", "n", "x", "s"), 256).alias("input_hash"))


def conversation_semantics(features: DataFrame) -> DataFrame:
    """Sentiment, intent, persona, audience, objection, pressure, urgency and next action by rules."""
    c = F.col
    score = reduce(lambda a, b: a + b, [c(f"contains_{k}").cast("int") for k in C.FLAGS])
    d = features.drop("messages").withColumns(
        {
            "data_shared_score": score,
            "sentiment_label": sentiment_label(c("positive_tone_hits"), c("negative_tone_hits")),
            "sentiment_confidence_band": sentiment_support(c("positive_tone_hits"), c("negative_tone_hits")),
            "intent_stage": F.when(c("has_sinistro_signal"), "pos_sinistro")
            .when(c("quoted_price_mentions") > 0, "cotacao_ativa")
            .when(c("has_competitor_signal"), "pesquisa_mercado")
            .otherwise("descoberta_inicial"),
            "persona_profile": F.when(c("has_sinistro_signal"), "cliente_pos_sinistro")
            .when(c("has_competitor_signal"), "cotador_comparador")
            .when((score >= 2) & (c("message_count") >= 3), "lead_engajado_com_dados")
            .otherwise("lead_frio"),
            "price_objection_intensity": objection_level(c("price_objection_hits"), c("competitor_mentions_count"), c("quoted_price_mentions")),
            "competitor_pressure_level": pressure_level(c("primary_competitor"), c("competitor_mentions_count"), c("competitor_comparison_hits")),
            "commercial_urgency_signal": urgency_level(c("urgency_strength_max"), c("urgency_hits")),
        }
    )
    action = (
        F.when(c("intent_stage") == "pos_sinistro", "acionar_fluxo_pos_sinistro")
        .when(c("commercial_urgency_signal") == "alta", "priorizar_contato_imediato")
        .when(c("price_objection_intensity") == "forte", "reforcar_diferenciais_e_retirar_objecao_preco")
        .when(c("intent_stage") == "cotacao_ativa", "enviar_cotacao_objetiva")
        .when(c("intent_stage") == "descoberta_inicial", "avancar_coleta_de_contexto")
        .otherwise("seguir_nutricao_basica")
    )
    return d.withColumns({"audience_segment": audience_of(c("persona_profile")), "recommended_next_action": action, "source_family": F.lit("deterministic_fallback")})


def reuse_cached(semantics: DataFrame, cache: DataFrame, keys=("conversation_id", "input_hash", "prompt_version", "model")) -> DataFrame:
    """Rows with the cached result where the same input was seen before."""
    known = cache.dropDuplicates(list(keys)).select(*keys, F.col("intent_stage").alias("__intent"))
    d = semantics.join(known, list(keys), "left")
    return d.withColumns({"cache_hit": F.col("__intent").isNotNull(), "intent_stage": F.coalesce("__intent", "intent_stage")}).drop("__intent")


def mode_with_recency(conversations: DataFrame, *values: str) -> DataFrame:
    """The most frequent value (or pair) of each lead; ties go to the latest, then the smallest. Blanks do not count."""
    filled = conversations.filter(reduce(lambda a, b: a & b, [F.trim(safe_string(F.col(v))) != "" for v in values]))
    counts = filled.groupBy("lead_key", *values).agg(F.count("*").alias("n"), F.max("conversation_last_message_at").alias("latest"))
    w = Window.partitionBy("lead_key").orderBy(F.desc("n"), F.desc_nulls_last("latest"), *values)
    return counts.withColumn("r", F.row_number().over(w)).filter("r = 1").select("lead_key", *values)


def severity(c: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in C.SEVERITY.items() for x in kv])[c], F.lit(-1))


def consolidate(conversations: DataFrame) -> DataFrame:
    """Semantics per lead from those of its conversations."""
    pair = mode_with_recency(conversations, "persona_profile", "audience_segment")
    fits = audience_of(F.col("persona_profile")).eqNullSafe(F.col("audience_segment"))
    pair = pair.filter(fits)
    mood = mode_with_recency(conversations, "sentiment_label")
    support = (
        conversations.join(mood.withColumnRenamed("sentiment_label", "__label"), "lead_key")
        .filter("sentiment_label = __label AND trim(sentiment_confidence_band) <> ''")
        .groupBy("lead_key")
        .agg(F.max(F.struct(severity(F.col("sentiment_confidence_band")).alias("s"), F.col("sentiment_confidence_band").alias("v")))["v"].alias("conversation_sentiment_support"))
    )
    latest = F.struct("conversation_last_message_at", F.col("conversation_id"))
    lead = conversations.groupBy("lead_key").agg(
        F.max_by("intent_stage", F.when(F.col("intent_stage").isNotNull(), latest)).alias("intent_stage"),
        F.when(F.count_distinct("source_family") > 1, "mixed").otherwise(F.min("source_family")).alias("family"),
    )
    d = lead.join(pair, "lead_key", "left").join(mood, "lead_key", "left").join(support, "lead_key", "left")
    text = lambda x, name: safe_string(F.col(x)).alias(name)
    return d.select(
        "lead_key",
        *[text(x, x) for x in ("intent_stage", "persona_profile", "audience_segment")],
        text("sentiment_label", "conversation_sentiment_label"),
        text("conversation_sentiment_support", "conversation_sentiment_support"),
        *[F.col("family").alias(f"{x}_source_family") for x in ("intent_stage", "persona_profile", "audience_segment", "conversation_sentiment")],
    )


def first_violation(df: DataFrame, vocabularies: dict[str, tuple[str, ...]], explanation: str | None = None, longest: int = 280) -> DataFrame:
    """df with violation: the first rule that a model's answer breaks, or null."""
    rules = [F.when(F.trim(safe_string(F.col(c))) == "", F.lit(f"missing:{c}")) for c in vocabularies]
    rules += [F.when(~F.col(c).isin(*v), F.lit(f"vocabulary:{c}")) for c, v in vocabularies.items()]
    if explanation:
        rules += [F.when(F.length(explanation) > longest, F.lit("too_long")), F.when(F.size(unmasked_classes(F.col(explanation))) > 0, F.lit("pii"))]
    return df.withColumn("violation", F.coalesce(*rules))


def normalized_output(df: DataFrame, column: str, vocabulary: tuple[str, ...], synonyms: dict[str, str], ratio: float = 0.9) -> DataFrame:
    """column mapped to the vocabulary: itself, a synonym, or the one word that is close enough (Ratcliff ratio).

    The ratio is computed in Python for the distinct values only, which are joined back."""
    token = F.regexp_replace(F.lower(F.trim(column)), r"[\s-]+", "_")

    def close(values: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        def one(v: str | None) -> str | None:
            scored = sorted(((SequenceMatcher(None, v or "", w).ratio(), w) for w in vocabulary), reverse=True)
            best = [w for r, w in scored if r >= ratio and r == scored[0][0]]
            return best[0] if len(best) == 1 else None

        return values.map(one)

    d = df.withColumn("__token", token)
    mapped = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])[F.col("__token")] if synonyms else F.lit(None)
    known = F.coalesce(F.when(F.col("__token").isin(*vocabulary), F.col("__token")), mapped)
    values = d.select("__token").distinct().withColumn("__word", F.coalesce(known, F.pandas_udf(close, "string")("__token")))
    return d.join(values, "__token", "left").withColumn(f"{column}_normalized", F.col("__word")).drop("__token", "__word")


def error_summaries(errors: DataFrame, by: str, *parts: str) -> DataFrame:
    """by and errors: each distinct error of a row group as its filled parts joined by colons, all in order joined; groups
    without any are left out."""
    one = F.concat_ws(":", *[F.nullif(F.trim(safe_string(F.col(p))), F.lit("")) for p in parts])
    said = errors.select(by, one.alias("e")).filter("e <> ''").distinct()
    return said.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list("e")), " | ").alias("errors"))
