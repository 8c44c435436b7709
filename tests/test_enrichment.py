"""Model answers: mapping, validation, provenance, the store between runs."""

import unicodedata
from datetime import datetime

from pyspark.sql import functions as F

from convolake.functions import text as T
from convolake.operators import conversations as V
from convolake.operators import enrichment as N

GOOD = dict(sentiment_label="positivo", sentiment_confidence_band="forte", intent_stage="cotacao_ativa", persona_profile="lead_frio", audience_segment="nutricao_basica", price_objection_intensity="leve", competitor_pressure_level="nenhuma", commercial_urgency_signal="alta", recommended_next_action="seguir_nutricao_basica", explanation_short="ok")
RULES = dict(GOOD, sentiment_label="neutro", intent_stage="descoberta_inicial")


def conversations(spark, *ids, hash_="h"):
    rows = [(i, f"lead{i[-1]}", hash_, *[RULES[f] for f in N.FIELDS]) for i in ids]
    return spark.createDataFrame(rows, "conversation_id string, lead_key string, input_hash string, " + ", ".join(f"{f} string" for f in N.FIELDS))


def answers(spark, *rows):
    out = []
    for r in rows:
        d = dict(conversation_id="c1", input_hash="h", prompt_version="v1", model="model", status="success", provider_name="alpha", attempted_providers=["alpha"], provider_errors=None, output=None, validation_error=None, trace_id=None, answered_at=datetime(2024, 1, 1)) | r
        if d["output"] is not None:
            d["output"] = tuple((GOOD | d["output"])[f] for f in (*N.FIELDS, "explanation_short"))
        out.append(tuple(d.values()))
    return spark.createDataFrame(out, N.ANSWERS)


def test_every_code_point_folds(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join("<" + chr(c) for c in codes[i : i + 2048]) for i in range(0, len(codes), 2048)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.ascii_only(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    one = spark.createDataFrame([("ﬁnal ½ ＡＢＣ ㎏ 𝒜𝓫 ação", None)], "t string, n string")
    assert tuple(one.select(T.match_norm(F.col("t")), T.ascii_only(F.col("n"))).first()) == ("final 12 abc kg ab acao", "")


def test_statuses_and_reasons(spark):
    error = [("alpha", "timeout", "30s"), ("beta", " ", None), (None, None, None)]
    said = answers(
        spark,
        dict(conversation_id="c1", output={}),
        dict(conversation_id="c1", output=dict(intent_stage="pos_sinistro"), answered_at=datetime(2023, 1, 1)),
        dict(conversation_id="c2", status="timeout", attempted_providers=["alpha", " ", "beta"], provider_errors=error),
        dict(conversation_id="c3", output=dict(intent_stage="comprar", persona_profile=None)),
        dict(conversation_id="c4", output=dict(intent_stage=" ")),
        dict(conversation_id="c5", output=dict(explanation_short="fale com ana@exemplo.com")),
        dict(conversation_id="c6", output=dict(explanation_short="x" * 281)),
        dict(conversation_id="c7", status="fallback", validation_error="bad", provider_name=None),
        dict(conversation_id="c8", input_hash="other", output={}),
        dict(conversation_id="c9", output=dict(recommended_next_action="Seguir_Nutricao_Basica")),
    )
    got = {r.conversation_id: r for r in N.enriched(conversations(spark, *[f"c{k}" for k in range(1, 10)]), said).collect()}
    assert len(got) == 9
    assert [got[f"c{k}"].inference_status for k in range(1, 10)] == ["success", "fallback", "invalid_output", "invalid_output", "invalid_output", "invalid_output", "fallback", "provider_error", "invalid_output"]
    assert [got[f"c{k}"].validation_error for k in (1, 3, 4, 5, 6, 7, 9)] == [None, "missing_fields:persona_profile", "invalid_intent_stage:<empty>", "explanation_privacy_leak", "explanation_too_long", "bad", "invalid_recommended_next_action:Seguir_Nutricao_Basica"]
    assert got["c2"].fallback_reason == got["c2"].provider_error_summary == "alpha:timeout:30s | beta" and got["c2"].provider_attempt_count == 2
    assert got["c7"].fallback_reason == "provider_graph_fallback" and got["c8"].fallback_reason == "no_answer"
    assert (got["c1"].intent_stage, got["c1"].source_family) == ("cotacao_ativa", "llm_provider")
    assert all(got[f"c{k}"].intent_stage == RULES["intent_stage"] and got[f"c{k}"].source_family == "deterministic_fallback" and got[f"c{k}"].explanation_short == N.FALLBACK_NOTE for k in range(2, 10))
    off = N.enriched(conversations(spark, "c1"), None).first()
    assert (off.inference_status, off.fallback_reason, off.provider_name) == ("disabled", "llm_enrichment_disabled", None)


def test_values_are_mapped(spark):
    said = answers(spark, dict(output=dict(sentiment_label=" Négative ", sentiment_confidence_band="STRONG", intent_stage="quote-request", persona_profile="cotador_comparadorr", audience_segment="Oferta Competitiva", price_objection_intensity="forte!", competitor_pressure_level="lev", commercial_urgency_signal="???")))
    out = N.mapped(said).first().output
    # "lev" is 6/7 like leve, less than nine tenths; "???" has nothing to compare
    assert (out.sentiment_label, out.sentiment_confidence_band, out.intent_stage, out.persona_profile, out.audience_segment, out.price_objection_intensity, out.competitor_pressure_level, out.commercial_urgency_signal) == ("negativo", "forte", "cotacao_ativa", "cotador_comparador", "oferta_competitiva", "forte", "lev", "???")


def test_second_run_is_all_hits(spark, tmp_path):
    store = N.AnswerStore(spark, str(tmp_path))
    people = conversations(spark, "c1", "c2", "c3")
    assert store.latest().count() == 0
    first = N.enriched(people, answers(spark, dict(conversation_id="c1", output={}), dict(conversation_id="c2", output=dict(intent_stage="?"))), store.latest())
    store.upsert(first)
    again = {r.conversation_id: r for r in N.enriched(people, None, store.latest(people)).collect()}
    assert {r.inference_status for r in again.values()} == {"skipped_cache_hit"}
    assert [again[c].source_family for c in ("c1", "c2", "c3")] == ["llm_provider", "llm_provider", "deterministic_fallback"]
    assert again["c1"].intent_stage == "cotacao_ativa" and again["c2"].validation_error == "invalid_intent_stage:?"
    # a changed input and another prompt are not known; a later version replaces an earlier one, before and after compaction
    changed = N.enriched(conversations(spark, "c1", hash_="new"), None, store.latest()).first()
    assert changed.inference_status == "disabled"
    assert N.enriched(people, None, store.latest(), prompt_version="v2").filter("inference_status = 'skipped_cache_hit'").count() == 0
    store.upsert(N.enriched(people.filter("conversation_id = 'c3'"), answers(spark, dict(conversation_id="c3", output=dict(intent_stage="pos_sinistro")))))
    stage = lambda: {r.conversation_id: r.intent_stage for r in store.latest().collect()}
    want = {"c1": "cotacao_ativa", "c2": "descoberta_inicial", "c3": "pos_sinistro"}
    assert stage() == want
    store.compact()
    assert stage() == want and len(store._live()) == 1
    store.upsert(N.enriched(people, None, store.latest()))  # nothing but hits: an empty version
    assert stage() == want and len(N.AnswerStore(spark, str(tmp_path))._live()) == 2


def test_families_of_leads(spark):
    people = conversations(spark, "a1", "b1", "a2", "b2", "a3").withColumn("conversation_last_message_at", F.lit("2024-01-01").cast("timestamp"))
    said = answers(spark, *[dict(conversation_id=c, output={}) for c in ("a1", "a2", "b2")])
    got = {r.lead_key: r.intent_stage_source_family for r in V.consolidate(N.enriched(people, said)).collect()}
    assert got == {"lead1": "mixed", "lead2": "llm_provider", "lead3": "deterministic_fallback"}
