"""DuckDB SQL for the layers; each query's SQL selects from them."""

from __future__ import annotations

from convolake import contract as C
from convolake.sources.messages import MESSAGES_SQL


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re_(expr: str, pattern: str, ignore_case: bool = True) -> str:
    return f"regexp_matches({expr}, {q(('(?i)' if ignore_case else '') + pattern)})"


def first(value: str, order: str, where: str = "TRUE") -> str:
    return f"first({value} ORDER BY {order}) FILTER (WHERE ({value}) IS NOT NULL AND {where})"


def last(value: str, order: str, where: str = "TRUE") -> str:
    return f"last({value} ORDER BY {order}) FILTER (WHERE ({value}) IS NOT NULL AND {where})"


PHONE = r"(^|[^A-Za-z0-9_])(\+55\s?)?(\(?\d{2}\)?\s?)?(9?\d{4})-?\d{4}($|[^A-Za-z0-9_])"
PII = {"email": re_("body", C.EMAIL), "phone": re_("body", PHONE, False), "cpf": re_("body", C.CPF, False), "cep": re_("body", C.CEP, False), "plate": re_("body", C.PLATE)}
_bare = lambda p, masked: f"len(list_filter(regexp_extract_all(body, {q('(?i)' + p)}), lambda x: NOT regexp_full_match(x, {q(masked)}))) > 0"
#: Whether a body holds personal data that is not masked.
UNMASKED = f"({_bare(C.EMAIL, '[xX._%+-]+@[xX.-]+[.][xX]{2,}')} OR {_bare(C.PLATE, '[Xx9-]+')} OR {PII['phone']} OR {PII['cpf']} OR {PII['cep']})"
NORM = lambda c: f"trim(regexp_replace(lower(strip_accents(coalesce({c}, ''))), '[^a-z0-9]+', ' ', 'g'))"
#: silver with its bodies masked: in turn, each match of a pattern is replaced by its mask.
_name = lambda c: f"'(?i)\\b' || nullif(array_to_string(list_filter(string_split({NORM(c)}, ' '), lambda w: length(w) >= 2), '\\s+'), '') || '\\b'"
_mask = lambda m, chars, x: f"regexp_replace({m}, '{chars}', '{x}', 'g')"
MASKED = "silver"
for _pattern, _masked in (
    (q("(?i)" + C.EMAIL), _mask("m", "[A-Za-z0-9]", "x")),
    *[(q(p), _mask("m", "[0-9]", "X")) for p in (C.CPF, C.CEP, PHONE)],
    (q("(?i)" + C.PLATE), _mask(_mask("m", "[A-Za-z]", "X"), "[0-9]", "9")),
    *[(f"CASE WHEN length({NORM(c)}) >= 3 THEN {_name(c)} END", _mask("m", "[[:alpha:]]", "X")) for c in ("sender_name", "conversation_lead_name", "conversation_agent_name")],
):
    MASKED = f"(SELECT * REPLACE (list_reduce(list_prepend(body, regexp_extract_all(body, {_pattern})), lambda a, m: replace(a, m, {_masked})) AS body) FROM {MASKED})"
TIME = '"timestamp" NULLS LAST, message_id'
LEAD_ORDER = 'conversation_id NULLS LAST, "timestamp" NULLS LAST, message_id NULLS LAST'
GOLD_ORDER = '"timestamp" NULLS LAST, conversation_id NULLS LAST, message_id NULLS LAST'
_case = lambda rules: "CASE " + " ".join(f"WHEN {w} THEN {q(v)}" for w, v in rules) + " END"
_tone = lambda patterns: " + ".join(f"CAST({re_('norm', p, False)} AS INT)" for p in patterns)
_valid = "coalesce(json_valid(metadata), FALSE)"
_text = lambda k: f"CASE WHEN {_valid} THEN coalesce(json_extract_string(metadata, '$.{k}'), '') END"
_flags = " + ".join(f"CAST(contains_{k} AS INT)" for k in C.FLAGS)
_any = lambda c: f"coalesce(bool_or(coalesce({c}, FALSE)), FALSE)"
AUDIENCE = lambda c: "CASE " + c + " " + " ".join(f"WHEN {q(p)} THEN {q(a)}" for p, a in C.AUDIENCE_OF.items()) + " END"
_label = lambda p, n: f"CASE WHEN {p} + {n} = 0 THEN 'sem_evidencia' WHEN {p} - {n} >= 2 THEN 'positivo' WHEN {n} - {p} >= 2 THEN 'negativo' ELSE 'neutro' END"
_support = lambda p, n: f"CASE WHEN {p} + {n} = 0 THEN 'sem_evidencia' WHEN greatest({p}, {n}) >= 2 OR abs({p} - {n}) >= 3 THEN 'forte' WHEN {p} + {n} >= 2 OR abs({p} - {n}) >= 1 THEN 'moderado' ELSE 'fraco' END"
_objection = "CASE WHEN price_objection_hits >= 2 OR (price_objection_hits >= 1 AND competitor_mentions_count >= 1) OR quoted_price_mentions >= 2 THEN 'forte' WHEN price_objection_hits >= 1 OR quoted_price_mentions >= 1 OR competitor_mentions_count >= 1 THEN 'leve' ELSE 'nenhuma' END"
_urgency = "CASE WHEN urgency_strength_max >= 2 OR urgency_hits >= 2 THEN 'alta' WHEN urgency_strength_max >= 1 THEN 'moderada' ELSE 'nenhuma' END"
_pressure = "CASE WHEN trim(coalesce(primary_competitor, '')) = '' AND competitor_mentions_count = 0 AND competitor_comparison_hits = 0 THEN 'nenhuma' WHEN competitor_comparison_hits >= 1 OR competitor_mentions_count >= 2 THEN 'alta' ELSE 'leve' END"

_provider = "CASE WHEN domain IS NULL THEN NULL " + " ".join(f"WHEN {' OR '.join(f'ends_with(domain, {q(e)})' for e in ends)} THEN {q(n)}" for n, ends in C.PROVIDERS) + " ELSE 'other' END"

LAYERS: list[tuple[str, str]] = [
    ("bronze", MESSAGES_SQL),
    (
        "parsed",
        f"""SELECT * EXCLUDE (metadata), {_text("device")} AS metadata_device, {_text("city")} AS metadata_city, {_text("state")} AS metadata_state,
            {_text("lead_source")} AS metadata_lead_source,
            CASE WHEN {_valid} THEN TRY_CAST(json_extract_string(metadata, '$.response_time_sec') AS BIGINT) END AS metadata_response_time_sec,
            CASE WHEN {_valid} THEN TRY_CAST(json_extract_string(metadata, '$.is_business_hours') AS BOOLEAN) END AS metadata_is_business_hours,
            {_valid} AS json_ok FROM bronze""",
    ),
    ("good", """SELECT * EXCLUDE (json_ok) FROM parsed WHERE json_ok AND "timestamp" IS NOT NULL"""),
    (
        "context",
        f"""SELECT conversation_id, {first("sender_name", TIME, "direction = 'inbound'")} AS lead_name,
            {first("sender_name", TIME, "direction = 'outbound'")} AS agent_name, {first("sender_phone", TIME, "direction = 'inbound'")} AS lead_phone
            FROM good GROUP BY conversation_id""",
    ),
    (
        "deduped",
        f"""SELECT * EXCLUDE (rank_), dupes AS duplicate_event_group_size, dupes > 1 AS had_status_duplication, dupes - 1 AS dropped_duplicate_events FROM (
            SELECT *, count(*) OVER (PARTITION BY {", ".join(f'"{k}"' for k in C.DEDUPE_KEYS)}) AS dupes,
              row_number() OVER (PARTITION BY {", ".join(f'"{k}"' for k in C.DEDUPE_KEYS)} ORDER BY CASE status WHEN 'read' THEN 3 WHEN 'delivered' THEN 2 WHEN 'sent' THEN 1 WHEN 'failed' THEN 0 ELSE -1 END DESC, message_id) AS rank_
            FROM good) WHERE rank_ = 1""",
    ),
    (
        "texted",
        f"""SELECT d.* EXCLUDE (dupes), coalesce(lead_name, '') AS conversation_lead_name, coalesce(agent_name, '') AS conversation_agent_name, coalesce(lead_phone, '') AS conversation_lead_phone,
            coalesce(message_body, '') AS body, {NORM("message_body")} AS norm FROM deduped d LEFT JOIN context USING (conversation_id)""",
    ),
    (
        "signals",
        f"""SELECT *, length(body) AS message_length, len(list_filter(regexp_split_to_array(body, '\\s+'), lambda x: x <> '')) AS word_count, trim(body) = '' AS is_empty_message,
            {", ".join(f"{PII[k]} AS contains_{k}" for k in C.FLAGS)},
            {_case([(re_("norm", rf"\b{m}\b", False), m) for m in C.MAKES])} AS vehicle_make,
            {_case([(f"contains(replace(norm, 't cross', 't-cross'), {q(m.replace(' ', '-'))})", m) for m in C.MODELS])} AS vehicle_model,
            {_case([(re_("body", p), n) for n, p in C.COMPETITORS])} AS competitor_mentioned,
            lower(nullif(regexp_extract(body, {q("(?i)" + C.EMAIL_DOMAIN)}, 1), '')) AS domain,
            TRY_CAST(replace(replace(regexp_extract(body, {q("(?i)" + C.PRICE)}, 1), '.', ''), ',', '.') AS DOUBLE) AS quoted_price,
            {re_("body", C.OBJECTION)} AS price_objection_signal,
            CASE WHEN {re_("body", C.URGENT_STRONG)} THEN 2 WHEN {re_("body", C.URGENT_MODERATE)} THEN 1 ELSE 0 END AS urgency_strength,
            {re_("body", C.COMPARISON)} AS competitor_comparison_signal,
            CASE WHEN direction = 'inbound' AND NOT (contains(lower(body), 'cobertura') AND NOT contains(lower(body), 'tive') AND NOT contains(lower(body), 'bati'))
              THEN {_case([(re_("lower(body)", p), n) for n, p in C.CLAIMS])} END AS sinistro_type,
            nullif(regexp_extract(norm, '\\bano\\s+(19\\d{{2}}|20\\d{{2}})\\b', 1), '') AS year_stated, nullif(regexp_extract(norm, '\\b(19\\d{{2}}|20\\d{{2}})\\b', 1), '') AS year_any,
            {_tone(C.POSITIVE)} AS pos, {_tone(C.NEGATIVE)} AS neg FROM texted""",
    ),
    (
        "silver",
        f"""SELECT s.*, coalesce(year_stated, CASE WHEN vehicle_make IS NOT NULL OR vehicle_model IS NOT NULL OR contains_plate THEN year_any END) AS vehicle_year,
            {_provider} AS email_provider,
            vehicle_make IS NOT NULL OR vehicle_model IS NOT NULL OR year_stated IS NOT NULL OR contains_plate AS mentions_vehicle,
            competitor_mentioned IS NOT NULL AS mentions_competitor, sinistro_type IS NOT NULL AS mentions_sinistro,
            direction = 'inbound' AS is_inbound, direction = 'outbound' AS is_outbound,
            {", ".join(f'''CASE WHEN direction = '{d}' THEN price_objection_signal ELSE FALSE END AS price_objection_signal_{d}, CASE WHEN direction = '{d}' THEN urgency_strength ELSE 0 END AS urgency_strength_{d},
            CASE WHEN direction = '{d}' THEN competitor_comparison_signal ELSE FALSE END AS competitor_comparison_signal_{d}, CASE WHEN direction = '{d}' THEN competitor_mentioned END AS competitor_mentioned_{d},
            CASE WHEN direction = '{d}' THEN competitor_mentioned END IS NOT NULL AS mentions_competitor_{d}''' for d in ("inbound", "outbound"))},
            regexp_replace(conversation_lead_phone, '[0-9]', 'X', 'g') AS lead_phone_masked, conversation_lead_name AS lead_name_raw,
            'lead_' || substr(sha256(coalesce(nullif(concat_ws('|', nullif({NORM("CASE WHEN conversation_lead_phone <> '' THEN conversation_lead_phone ELSE conversation_lead_name END")}, ''), nullif({NORM("metadata_city")}, ''), nullif({NORM("metadata_state")}, '')), ''), 'unknown')), 1, 16) AS lead_key
            FROM signals s""",
    ),
    (
        "leads0",
        f"""SELECT lead_key, regexp_replace(coalesce({first("nullif(trim(lead_name_raw), '')", LEAD_ORDER)}, ''), '[A-Za-z]', 'X', 'g') AS canonical_lead_name_masked,
            coalesce({first("nullif(trim(lead_phone_masked), '')", LEAD_ORDER)}, '') AS contact,
            coalesce({first("nullif(trim(metadata_city), '')", LEAD_ORDER)}, '') AS city, coalesce({first("nullif(trim(metadata_state), '')", LEAD_ORDER)}, '') AS state,
            min("timestamp") AS first_seen_at, max("timestamp") AS last_seen_at, count(DISTINCT conversation_id) AS conversation_count, count(DISTINCT message_id) AS message_count,
            {", ".join(f"array_to_string(coalesce(list_sort(list(DISTINCT nullif(trim({c}), '')) FILTER (WHERE nullif(trim({c}), '') IS NOT NULL)), []), ',') AS {n}" for c, n in (("campaign_id", "observed_campaign_ids"), ("metadata_lead_source", "observed_lead_sources"), ("conversation_outcome", "observed_outcomes")))},
            {", ".join(f"{_any('mentions_' + k)} AS has_{k}_signal" for k in ("vehicle", "competitor", "sinistro"))}, {", ".join(f"{_any('contains_' + k)} AS has_{k}_signal" for k in C.FLAGS)},
            coalesce({first("nullif(trim(campaign_id), '')", LEAD_ORDER)}, '') AS primary_campaign_id, coalesce({last("nullif(trim(conversation_outcome), '')", LEAD_ORDER)}, '') AS latest_outcome,
            {", ".join(f"coalesce({first(c, LEAD_ORDER)}, '') AS {c}_observed" for c in ("vehicle_make", "vehicle_model", "vehicle_year"))},
            coalesce({first("competitor_mentioned", LEAD_ORDER)}, '') AS primary_competitor_observed,
            min(quoted_price) AS quoted_price_min, max(quoted_price) AS quoted_price_max, {last("quoted_price", LEAD_ORDER)} AS quoted_price_last,
            avg(metadata_response_time_sec) AS avg_response_time_sec, avg(CAST(metadata_is_business_hours AS INT)) AS business_hours_ratio FROM silver GROUP BY lead_key""",
    ),
    ("leads", "SELECT * EXCLUDE (contact), coalesce(nullif(trim(contact), ''), lead_key) AS lead_contact_ref FROM leads0"),
    (
        "aggregates",
        f"""SELECT lead_key, count(message_id) AS total_messages, CAST(sum(CAST(is_inbound AS INT)) AS BIGINT) AS inbound_messages, CAST(sum(CAST(is_outbound AS INT)) AS BIGINT) AS outbound_messages, CAST(sum(dropped_duplicate_events) AS BIGINT) AS duplicate_events_removed,
            {", ".join(f"{_any('contains_' + k)} AS contains_{k}" for k in C.FLAGS)}, {", ".join(f"{_any('mentions_' + k)} AS mentioned_{k}" for k in ("vehicle", "competitor", "sinistro"))},
            avg(quoted_price) AS avg_quoted_price, {last("competitor_mentioned_inbound", GOLD_ORDER)} AS primary_competitor, {last("email_provider", GOLD_ORDER)} AS email_provider_seen,
            count(quoted_price) AS quoted_price_mentions, CAST(sum(CAST(price_objection_signal_inbound AS INT)) AS BIGINT) AS price_objection_hits, count(*) FILTER (urgency_strength_inbound > 0) AS urgency_hits,
            CAST(max(urgency_strength_inbound) AS BIGINT) AS urgency_strength_max, CAST(sum(CAST(mentions_competitor_inbound AS INT)) AS BIGINT) AS competitor_mentions_count,
            CAST(sum(CAST(competitor_comparison_signal_inbound AS INT)) AS BIGINT) AS competitor_comparison_hits,
            CAST(sum(CASE WHEN is_inbound THEN pos ELSE 0 END) AS BIGINT) AS positive_tone_hits, CAST(sum(CASE WHEN is_inbound THEN neg ELSE 0 END) AS BIGINT) AS negative_tone_hits,
            {", ".join(f"{last(c, GOLD_ORDER, 'mentions_vehicle')} AS {c}" for c in ("vehicle_make", "vehicle_model", "vehicle_year"))}, {last("sinistro_type", GOLD_ORDER, "mentions_sinistro")} AS primary_sinistro_type
            FROM silver GROUP BY lead_key""",
    ),
    (
        "measured",
        f"""SELECT l.*, a.* EXCLUDE (lead_key), CASE WHEN total_messages <= 0 THEN NULL WHEN total_messages <= 4 THEN 'lead_frio' WHEN total_messages <= 10 THEN 'curta' WHEN total_messages <= 20 THEN 'media' ELSE 'longa' END AS engagement_bucket,
            {_flags} AS data_shared_score, date_diff('microsecond', first_seen_at, last_seen_at) / 3.6e9 AS lead_lifecycle_hours, business_hours_ratio AS business_hours_message_ratio,
            CASE WHEN avg_response_time_sec IS NULL THEN 'sem_evidencia' WHEN avg_response_time_sec <= 300 THEN 'rapida' WHEN avg_response_time_sec <= 1800 THEN 'moderada' ELSE 'lenta' END AS response_latency_band,
            CASE WHEN list_has_any(list_transform(string_split(observed_outcomes, ','), lambda o: replace({NORM("o")}, ' ', '_')), {list(C.CLOSED)}) THEN 'fechado'
                 WHEN list_has_any(list_transform(string_split(observed_outcomes, ','), lambda o: replace({NORM("o")}, ' ', '_')), {list(C.LOST)}) THEN 'perdido' ELSE 'aberto' END AS closure_outcome_group,
            CASE WHEN contains_email THEN email_provider_seen END AS dominant_email_provider,
            {_objection} AS price_objection_intensity, {_urgency} AS commercial_urgency_signal, {_pressure} AS competitor_pressure_level,
            {_label("positive_tone_hits", "negative_tone_hits")} AS conversation_sentiment_label, {_support("positive_tone_hits", "negative_tone_hits")} AS conversation_sentiment_support
            FROM leads l LEFT JOIN aggregates a USING (lead_key)""",
    ),
    (
        "segmented",
        """SELECT *, closure_outcome_group = 'fechado' AS has_closed_outcome,
            CASE WHEN engagement_bucket IN ('media', 'longa') OR data_shared_score >= 2 THEN 'quente' WHEN engagement_bucket = 'lead_frio' AND data_shared_score = 0 THEN 'frio' ELSE 'morno' END AS lead_temperature,
            CASE WHEN mentioned_competitor OR avg_quoted_price IS NOT NULL THEN 'alta' ELSE 'baixa' END AS price_sensitivity,
            CASE WHEN data_shared_score >= 2 THEN 'alta' WHEN data_shared_score = 1 THEN 'media' ELSE 'baixa' END AS contact_readiness,
            CASE WHEN avg_quoted_price IS NOT NULL AND NOT mentioned_sinistro THEN 'cotacao_ativa' WHEN mentioned_competitor AND NOT mentioned_sinistro THEN 'pesquisa_mercado' WHEN mentioned_sinistro THEN 'pos_sinistro' ELSE 'descoberta_inicial' END AS intent_stage,
            CASE WHEN mentioned_sinistro AND contains_cpf THEN 'alto' WHEN mentioned_sinistro OR duplicate_events_removed > 0 THEN 'medio' ELSE 'baixo' END AS risk_signal FROM measured""",
    ),
    (
        "gold",
        f"""SELECT *, {AUDIENCE("persona_profile")} AS audience_segment FROM (SELECT *, CASE WHEN lead_temperature = 'quente' AND contact_readiness = 'alta' THEN 'lead_engajado_com_dados'
            WHEN mentioned_competitor AND avg_quoted_price IS NOT NULL THEN 'cotador_comparador' WHEN mentioned_sinistro THEN 'cliente_pos_sinistro' ELSE 'lead_frio' END AS persona_profile FROM segmented)""",
    ),
    (
        "features",
        f"""SELECT conversation_id, {first("lead_key", TIME)} AS lead_key, min("timestamp") AS conversation_first_message_at, max("timestamp") AS conversation_last_message_at, count(*) AS message_count, count(*) FILTER (is_inbound) AS inbound_count,
            CAST(sum(CASE WHEN is_inbound THEN pos ELSE 0 END) AS BIGINT) AS positive_tone_hits, CAST(sum(CASE WHEN is_inbound THEN neg ELSE 0 END) AS BIGINT) AS negative_tone_hits,
            count(quoted_price) AS quoted_price_mentions, {last("quoted_price", TIME)} AS last_price, avg(metadata_response_time_sec) AS avg_response_time_sec,
            count(*) FILTER (mentions_competitor_inbound) AS competitor_mentions_count, count(*) FILTER (competitor_comparison_signal_inbound) AS competitor_comparison_hits, {last("competitor_mentioned_inbound", TIME)} AS primary_competitor,
            count(*) FILTER (price_objection_signal_inbound) AS price_objection_hits, count(*) FILTER (urgency_strength_inbound > 0) AS urgency_hits, max(urgency_strength_inbound) AS urgency_strength_max,
            {", ".join(f"{_any('contains_' + k)} AS contains_{k}" for k in C.FLAGS)}, {_any("mentions_sinistro")} AS has_sinistro_signal, {_any("mentions_competitor")} AS has_competitor_signal FROM silver GROUP BY conversation_id""",
    ),
    (
        "semantics",
        f"""SELECT *, {AUDIENCE("persona_profile")} AS audience_segment, CASE WHEN intent_stage = 'pos_sinistro' THEN 'acionar_fluxo_pos_sinistro' WHEN commercial_urgency_signal = 'alta' THEN 'priorizar_contato_imediato'
              WHEN price_objection_intensity = 'forte' THEN 'reforcar_diferenciais_e_retirar_objecao_preco' WHEN intent_stage = 'cotacao_ativa' THEN 'enviar_cotacao_objetiva' WHEN intent_stage = 'descoberta_inicial' THEN 'avancar_coleta_de_contexto' ELSE 'seguir_nutricao_basica' END AS recommended_next_action
            FROM (SELECT *, {_flags} AS data_shared_score, {_label("positive_tone_hits", "negative_tone_hits")} AS sentiment_label, {_support("positive_tone_hits", "negative_tone_hits")} AS sentiment_confidence_band,
              CASE WHEN has_sinistro_signal THEN 'pos_sinistro' WHEN quoted_price_mentions > 0 THEN 'cotacao_ativa' WHEN has_competitor_signal THEN 'pesquisa_mercado' ELSE 'descoberta_inicial' END AS intent_stage,
              CASE WHEN has_sinistro_signal THEN 'cliente_pos_sinistro' WHEN has_competitor_signal THEN 'cotador_comparador' WHEN {_flags} >= 2 AND message_count >= 3 THEN 'lead_engajado_com_dados' ELSE 'lead_frio' END AS persona_profile,
              {_objection} AS price_objection_intensity, {_urgency} AS commercial_urgency_signal, {_pressure} AS competitor_pressure_level FROM features)""",
    ),
    (
        "pair_mode",
        """SELECT lead_key, persona_profile, audience_segment FROM (SELECT *, row_number() OVER (PARTITION BY lead_key ORDER BY n DESC, latest DESC, persona_profile, audience_segment) AS r FROM
            (SELECT lead_key, persona_profile, audience_segment, count(*) AS n, max(conversation_last_message_at) AS latest FROM semantics GROUP BY ALL)) WHERE r = 1""",
    ),
    (
        "mood_mode",
        """SELECT lead_key, sentiment_label FROM (SELECT *, row_number() OVER (PARTITION BY lead_key ORDER BY n DESC, latest DESC, sentiment_label) AS r FROM
            (SELECT lead_key, sentiment_label, count(*) AS n, max(conversation_last_message_at) AS latest FROM semantics GROUP BY ALL)) WHERE r = 1""",
    ),
    (
        "severity",
        """SELECT lead_key, last(sentiment_confidence_band ORDER BY sev, sentiment_confidence_band) AS support FROM (SELECT s.*, CASE sentiment_confidence_band WHEN 'fraco' THEN 1 WHEN 'moderado' THEN 2 WHEN 'forte' THEN 3 ELSE -1 END AS sev
            FROM semantics s JOIN mood_mode m USING (lead_key) WHERE s.sentiment_label = m.sentiment_label) GROUP BY lead_key""",
    ),
    ("intent_latest", "SELECT lead_key, last(intent_stage ORDER BY conversation_last_message_at, conversation_id) AS intent_stage FROM semantics GROUP BY lead_key"),
    (
        "consolidated",
        """SELECT lead_key, i.intent_stage, p.persona_profile, p.audience_segment, m.sentiment_label AS conversation_sentiment_label, s.support AS conversation_sentiment_support
            FROM intent_latest i JOIN pair_mode p USING (lead_key) JOIN mood_mode m USING (lead_key) JOIN severity s USING (lead_key)""",
    ),
    (
        "macro",
        "SELECT *, lead_count / (SELECT count(*) FROM gold) AS lead_pct, row_number() OVER (PARTITION BY dimension ORDER BY lead_count DESC, dimension_value) AS rank FROM ("
        + " UNION ALL ".join(
            f"SELECT {q(d)} AS dimension, coalesce(nullif({d}, ''), 'sem_informacao') AS dimension_value, count(*) AS lead_count FROM gold {'WHERE contains_email' if d == 'dominant_email_provider' else ''} GROUP BY ALL"
            for d in C.MACRO_DIMENSIONS
        )
        + ")",
    ),
]


def sql(body: str) -> str:
    """body with the layers that it needs in front."""
    names = [n for n, _ in LAYERS]
    needed, text = set(), body
    import re

    for name in reversed(names):
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            needed.add(name)
            text += " " + dict(LAYERS)[name]
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in LAYERS if n in needed) + "\n" + body if needed else body
