"""The audit: clean layers pass every check, and each check finds the one row that violates it."""

import pytest
from pyspark.sql import functions as F
from test_messages import frame, message

from convolake.operators import audit as A
from convolake.operators import conversations as V
from convolake.operators import enrichment as N
from convolake.operators import gold as G
from convolake.operators import publication as P
from convolake.operators import silver as S


def null(t="string"):
    return F.lit(None).cast(t)


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("layers"))
    bodies = ["tive um sinistro, cpf 123.456.789-01", "oi", "obrigado, perfeito", "a@gmail.com", "placa ABC1D23"]
    rows = [message(k, conversation_id=f"c{k % 40}", sender_phone=f"+551199999{k % 40:04d}", message_body=bodies[k % 5] + f" {'abcde'[k // 40 % 5]}") for k in range(80)]
    raw = frame(spark, rows)
    m = S.silver_messages(raw)
    m.write.parquet(f"{at}/m")
    m = spark.read.parquet(f"{at}/m")
    ld = S.silver_leads(m)
    g = G.gold_leads(ld, m)
    x = N.enriched(V.conversation_semantics(V.conversation_features(m)).withColumn("input_hash", F.lit("h")), None)
    out = {"bronze": raw, "silver": ld, "silver_messages": P.sanitize(m), "silver_conversations_llm": x, "gold": g, "gold_macro": G.gold_macro(g)}
    for name, df in out.items():
        df.write.parquet(f"{at}/{name}")
    return {name: spark.read.parquet(f"{at}/{name}") for name in out}


def failed(results):
    return {(r.layer, r.check): (r.violating_rows, r.detail) for r in results.filter("status = 'failed'").collect()}


def test_clean_layers_pass(layers):
    got = A.audit(*layers.values()).collect()
    assert [r for r in got if r.status == "failed"] == [] and len(got) == 86 and len({(r.layer, r.check) for r in got}) == 86
    diagnosis = next(r for r in got if r.check == "first_message_outbound")
    assert diagnosis.violating_rows == 40 and diagnosis.detail == "c0,c1,c10,c11,c12"


#: What makes a row violate a check: columns and their new values.
ROW = {
    "bronze": {"channel_whatsapp_only": {"channel": "sms"}},
    "silver": {
        "lead_timestamps_not_null": {"last_seen_at": None},
        "lead_counts_non_negative": {"conversation_count": -1},
        "masked_text_fields_not_leaking": {"canonical_lead_name_masked": "mail a@b.com"},
    },
    "silver_messages": {
        "timestamp_not_null": {"timestamp": None},
        "masked_email_not_leaking": {"message_body_masked": "a@b.com"},
        "masked_phone_not_leaking": {"sender_phone_masked": "+55 11 99999-0000"},
        "masked_cpf_not_leaking": {"sender_name_masked": "123.456.789-01"},
        "masked_cep_not_leaking": {"message_body_masked": "04567-123"},
        "masked_plate_not_leaking": {"message_body_masked": "ABC1D23"},
        "vehicle_mentions_consistent": {"vehicle_year": "2020", "mentions_vehicle": False},
    },
    "silver_conversations_llm": {
        "conversation_enrichment_contract_valid": {"sentiment_label": "?"},
        "masked_text_fields_not_leaking": {"explanation_short": "a@b.com"},
    },
    "gold": {
        "conversation_count_non_negative": {"conversation_count": None},
        "message_totals_non_negative": {"total_messages": -1},
        "duplicate_events_removed_non_negative": {"duplicate_events_removed": -1},
        **{f"{f}_valid": {f: "?"} for f in A.C.GOLD_DOMAINS},
        "dominant_email_provider_valid": {"dominant_email_provider": "?", "contains_email": True},
        "persona_profile_not_null": {"persona_profile": None},
        "semantic_source_family_valid": {"intent_stage_source_family": "?"},
        "closure_outcome_flag_coherent": {"has_closed_outcome": True},
        "dominant_email_provider_nullability_coherent": {"dominant_email_provider": None, "contains_email": True},
        "persona_audience_semantic_alignment": {"persona_profile": "lead_frio", "audience_segment": "close_comercial"},
        "conversation_sentiment_support_alignment": {"conversation_sentiment_label": "sem_evidencia", "conversation_sentiment_support": "fraco", "positive_tone_hits": 0},
        "conversation_sentiment_evidence_compatibility": {"conversation_sentiment_label": "positivo", "conversation_sentiment_support": "fraco", "positive_tone_hits": 0, "negative_tone_hits": 2},
        "masked_text_fields_not_leaking": {"canonical_lead_name_masked": "a@b.com"},
    },
    "gold_macro": {
        "lead_pct_in_bounds": {"lead_pct": 1.5},
        "lead_count_non_negative": {"lead_count": -1},
        "rank_positive": {"rank": 0},
        "no_nulls_in_dimension": {"dimension": None},
    },
}
BETWEEN = {
    "silver_timestamps_match_messages": {"first_seen_at": None},
    "silver_conversation_count_matches_messages": {"conversation_count": 7},
    "silver_message_count_matches_messages": {"message_count": 70},
    "silver_signal_flags_match_messages": {"has_cep_signal": True},
}
GOLD_BETWEEN = {
    "gold_timestamps_match_published_history": {"last_seen_at": None},
    "gold_conversation_count_matches_history": {"conversation_count": 9},
    "gold_message_totals_match_history": {"inbound_messages": 0},
    "gold_signal_flags_match_history": {"contains_cep": True},
    **{f"{f}_coherent": {f: "?"} for f in A.BY_RULE},
    "dominant_email_provider_coherent": {"dominant_email_provider": None, "contains_email": True},
    "closure_outcome_coherent": {"has_closed_outcome": True},
    "gold_semantic_source_family_valid": {"audience_segment_source_family": None},
}


def broken(df, key, rules):
    """df in which the n-th row by key breaks the n-th rule, and the keys of these rows."""
    keys = [r[0] for r in df.select(key).orderBy(key).limit(len(rules)).collect()]
    kinds = dict(df.dtypes)
    df = df.withColumn("__key", F.col(key))
    for k, columns in zip(keys, rules.values(), strict=True):
        df = df.withColumns({c: F.when(F.col("__key") == k, F.lit(v).cast(kinds[c])).otherwise(F.col(c)) for c, v in columns.items()})
    return df.drop("__key"), keys


@pytest.mark.parametrize("layer", list(ROW))
def test_each_check_finds_its_row(layers, layer):
    df = layers[layer]
    if layer == "gold_macro":  # keys of the macro table are its values, which are unique within a dimension
        df = df.filter("dimension = 'numeric_snapshot'")
    key = A.KEYS[layer]
    bad, keys = broken(df, key, ROW[layer])
    names = {c.name for c in A.REGISTRY if c.layer == layer and c.violated is not None} | ({"masked_text_fields_not_leaking"} if layer == "gold" else set())
    assert names == set(ROW[layer])  # no check is left out
    got = {check: detail for (_, check), (n, detail) in failed(A.layer_results(bad, layer)).items()}
    for check, k in zip(ROW[layer], keys, strict=True):
        assert k in got[check].split(","), check
    clean = {r[0] for r in df.select(key).collect()} - set(keys)
    assert not any(set(detail.split(",")) & clean for check, detail in got.items() if not check.startswith("all_"))


def test_unique_checks(layers):
    for layer, df in layers.items():
        if layer == "silver_conversations_llm":
            want = {(layer, "conversation_id_unique")}
        else:
            want = {(layer, c.name) for c in A.REGISTRY if c.layer == layer and c.unique}
        one = df.limit(1)
        assert set(failed(A.layer_results(df.union(one), layer))) == want, layer


def test_between_layers(layers):
    bad, keys = broken(layers["silver"], "lead_key", BETWEEN)
    got = failed(A.silver_consistency(bad, layers["silver_messages"]))
    assert got == {("silver", n): (1, k) for n, k in zip(BETWEEN, keys, strict=True)}
    lost = layers["silver_messages"].filter(F.col("lead_key") != keys[0])
    assert failed(A.silver_consistency(layers["silver"], lost)) == {("silver", "silver_lead_keys_have_messages"): (1, keys[0])}
    bad, keys = broken(layers["gold"], "lead_key", GOLD_BETWEEN)
    got = failed(A.gold_consistency(bad, layers["silver"], layers["silver_messages"]))
    for name, k in zip(GOLD_BETWEEN, keys, strict=True):
        assert k in got["gold", name][1].split(","), name
    gone = layers["silver"].filter(F.col("lead_key") != keys[0])
    assert failed(A.gold_consistency(layers["gold"], gone, layers["silver_messages"])) == {("gold", "gold_lead_keys_in_silver"): (1, keys[0])}


def test_missing_and_forbidden_columns(layers):
    got = failed(A.layer_results(layers["gold"].drop("risk_signal").withColumn("sender_name", null()), "gold"))
    assert got == {("gold", "required_columns"): (1, "risk_signal"), ("gold", "forbidden_raw_columns_absent"): (1, "sender_name"), ("gold", "risk_signal_valid"): (0, "missing:risk_signal")}
    got = failed(A.layer_results(layers["silver_messages"].drop("message_body_masked"), "silver_messages"))
    assert got["silver_messages", "required_safe_columns_present"] == (1, "message_body_masked") and got["silver_messages", "masked_cpf_not_leaking"] == (0, "missing:message_body_masked")
    assert failed(A.layer_results(layers["bronze"].drop("direction"), "bronze")) == {("bronze", "required_columns"): (1, "direction"), ("bronze", "first_message_outbound"): (0, "missing:direction")}
    macro = layers["gold_macro"]
    assert failed(A.layer_results(macro.filter("dimension <> 'intent_stage'").withColumn("lead_key", null()), "gold_macro")) == {("gold_macro", "no_pii_identifier_columns"): (1, "lead_key"), ("gold_macro", "all_required_dimensions_present"): (1, "intent_stage")}
    assert failed(A.silver_consistency(layers["silver"].drop("message_count"), layers["silver_messages"])) == {("silver", "silver_lead_keys_have_messages"): (0, "missing:message_count")}
    assert failed(A.gold_consistency(layers["gold"], layers["silver"], layers["silver_messages"].drop("timestamp"))) == {("silver_messages", "gold_lead_keys_in_silver"): (0, "missing:timestamp")}


def test_tables_are_read_once(layers):
    """Counts and samples come from the stored keys of violating rows, and both checks between layers from one history."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    checks = tuple(k for k in A.REGISTRY if k.layer == "silver_messages" and k.violated is not None)
    assert "message_body_masked" not in plan(A.evaluated(layers["silver_messages"], "message_id", checks))
    whole = plan(A.audit(*layers.values()))
    assert "message_type" in whole  # in the count of unique keys
    assert "mentions_vehicle" not in whole and "observed_outcomes" not in whole
