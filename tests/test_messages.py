"""Text, signals, silver, gold, checks and drift on small tables with literal expectations."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions import signals as G
from convolake.functions import text as T
from convolake.operators import bronze as B
from convolake.operators import change as D
from convolake.operators import checks as Q
from convolake.operators import gold, silver
from convolake.plans.columns import Bucket, apply_columns, condition
from convolake.sources.messages import configured, publish, published

META = '{"device":"android","city":"Recife","state":"PE","response_time_sec":60,"is_business_hours":true,"lead_source":"ads"}'


def message(k, **over):
    row = dict(message_id=f"m{k}", conversation_id="c1", timestamp=datetime(2024, 1, 1, 10, k % 60), direction="inbound", sender_phone="+5511999990000", sender_name="Ana", message_type="text", message_body=f"oi {k}", status="sent", channel="whatsapp", campaign_id="camp", agent_id="a", conversation_outcome=None, metadata=META)
    return tuple((row | over).values())


def frame(spark, rows):
    return spark.createDataFrame(rows, C.BRONZE_SCHEMA)


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(
    "body, masked",
    [
        ("mail ana.b@x.com.br ok", "mail xxx.x@x.xxx.xx ok"),
        ("cpf 123.456.789-01 e cep 04567-123", "cpf XXX.XXX.XXX-XX e cep XXXXX-XXX"),
        ("placa abc1d23!", "placa XXX9X99!"),
        ("fone +55 11 99999-0000", "fone +XX XX XXXXX-XXXX"),
        ("", ""),
        (None, ""),
    ],
)
def test_mask_body_keeps_shape(spark, body, masked):
    assert one(spark, lambda c: T.mask_body(c), body) == masked


def test_names_are_masked(spark):
    d = spark.createDataFrame([("oi Ana  Paula, e Anapaula", "ana paula"), ("oi a", "a"), ("nada", "")], "t string, n string")
    assert [r.x for r in d.select(T.mask_known_names(F.col("t"), F.col("n")).alias("x")).collect()] == ["oi XXX  XXXXX, e Anapaula", "oi a", "nada"]


def test_normalisation(spark):
    assert one(spark, T.match_norm, " Ação  não-É ÇÜ 9! ") == "acao nao e cu 9"
    assert one(spark, T.match_norm, None) == ""


@pytest.mark.parametrize(
    "body, make, model, year",
    [("um golpe de 2019", None, "gol", "2019"), ("fiat ano 1999 de 2001", "fiat", None, "1999"), ("em 2020", None, None, None), ("T-Cross 2021", None, "t cross", "2021"), ("placa ABC1D23 2018", None, None, "2018")],
)
def test_vehicles(spark, body, make, model, year):
    d = spark.createDataFrame([(body,)], "t string").select(G.vehicle_make(F.col("t")), G.vehicle_model(F.col("t")), G.vehicle_year(F.col("t"))).first()
    assert tuple(d) == (make, model, year)


@pytest.mark.parametrize("body, value", [("R$ 1.234,50", 1234.5), ("r$150.50", 15050.0), ("sem", None), ("R$ 90 e R$ 80", 90.0)])
def test_price(spark, body, value):
    assert one(spark, G.price, body) == value


def test_tone(spark):
    assert one(spark, lambda c: G.tone_hits(c, C.POSITIVE), "obrigado, perfeito e ótima") == 2
    labels = [((0, 0), "sem_evidencia", "sem_evidencia"), ((2, 0), "positivo", "forte"), ((0, 3), "negativo", "forte"), ((1, 0), "neutro", "moderado"), ((1, 1), "neutro", "moderado")]
    for (p, n), label, support in labels:
        r = spark.range(1).select(G.sentiment_label(F.lit(p), F.lit(n)), G.sentiment_support(F.lit(p), F.lit(n))).first()
        assert tuple(r) == (label, support)


def test_json_and_quarantine(spark):
    good = ["{}", "[1]", "null", "3", '{"a":1,"a":2}']
    bad = ["", " ", "not-json", '{"a":1} x', "{'a':1}", "{", None, '{"a":1},{"b":2}']
    d = configured(spark).createDataFrame([(x,) for x in good + bad], "m string").select("m", B.valid_json(F.col("m")).alias("ok"))
    assert [r.ok for r in d.collect()] == [True] * len(good) + [False] * len(bad)
    rows = frame(spark, [message(1), message(2, timestamp=None), message(3, metadata="x"), message(4, timestamp=None, metadata="x")])
    kept, gone = B.quarantine(rows)
    assert [r.message_id for r in kept.collect()] == ["m1"]
    assert {r.message_id: r.quarantine_reason for r in gone.collect()} == {"m2": "invalid_timestamp", "m3": "invalid_metadata", "m4": "invalid_timestamp|invalid_metadata"}
    assert B.quarantine(rows, timestamps=False, metadata=False)[0].count() == 4


def test_metadata(spark):
    d = B.parse_metadata(frame(spark, [message(1), message(2, metadata='{"response_time_sec":"187"}'), message(3, metadata="x")])).orderBy("message_id").collect()
    assert [(r.metadata_city, r.metadata_response_time_sec, r.metadata_is_business_hours) for r in d] == [("Recife", 60, True), ("", 187, None), (None, None, None)]


def test_dedup_prefers_read_then_smallest_id(spark):
    same = dict(timestamp=datetime(2024, 1, 1), message_body="x")
    d = silver.dedup_events(frame(spark, [message(1, **same), message(2, status="read", **same), message(3, status="read", **same), message(4)]))
    assert {(r.message_id, r.duplicate_event_group_size, r.dropped_duplicate_events) for r in d.collect()} == {("m2", 3, 2), ("m4", 1, 0)}


def test_silver_and_leads(spark):
    rows = [
        message(1, direction="outbound", sender_name="Diego"),
        message(2, message_body="fiat 2019 R$ 10,00", conversation_outcome="fechado"),
        message(3, metadata=META.replace("Recife", "Olinda")),
        message(4, conversation_id=None),
    ]
    m = silver.silver_messages(frame(spark, rows))
    got = {r.message_id: r for r in m.collect()}
    assert got["m1"].conversation_lead_name == "Ana" and got["m1"].conversation_agent_name == "Diego"
    assert got["m4"].conversation_lead_phone == "" and got["m1"].lead_key == got["m2"].lead_key != got["m3"].lead_key
    assert got["m1"].sender_phone_masked == "+XXXXXXXXXXXXX"
    leads = {r.lead_key: r for r in silver.silver_leads(m).collect()}
    lead = leads[got["m1"].lead_key]
    assert (lead.message_count, lead.quoted_price_max, lead.vehicle_make_observed, lead.observed_outcomes, lead.latest_outcome) == (2, 10.0, "fiat", ["fechado"], "fechado")


def test_gold_macro_and_checks(spark):
    rows = [message(k, conversation_id=f"c{k % 3}", sender_phone=f"+551199999{k % 3:04d}", message_body="tive um sinistro, cpf 123.456.789-01" if k % 3 == 0 else f"oi {k}") for k in range(12)]
    m = silver.silver_messages(frame(spark, rows))
    leads = silver.silver_leads(m)
    g = gold.gold_leads(leads, m)
    macro = gold.gold_macro(g)
    sums = macro.filter("dimension <> 'numeric_snapshot' AND dimension <> 'dominant_email_provider'").groupBy("dimension").agg(F.sum("lead_count").alias("n"), F.sum("lead_pct").alias("p")).collect()
    assert all(r.n == 3 and abs(r.p - 1) < 1e-9 for r in sums) and len(sums) == 10
    assert {r.risk_signal for r in g.collect()} == {"alto", "baixo"}
    for checks in (Q.gold_key_checks(g), Q.gold_domain_checks(g), Q.gold_coherence(g), Q.silver_reconcile(leads, m), Q.gold_reconcile(g, leads), Q.macro_checks(macro), Q.silver_message_checks(m)):
        assert Q.summary(checks).first().failed == ""
    broken = Q.gold_domain_checks(g.withColumn("risk_signal", F.lit("?")))
    assert Q.summary(broken).first().failed == "gold.domain_risk_signal"
    assert Q.diagnosed(broken).first().kind == "vocabulary"
    failed = lambda checks: Q.summary(checks).first().failed
    lit = lambda v, t="string": F.lit(v).cast(t)
    assert failed(Q.gold_key_checks(g.union(g))) == "gold.lead_key_unique"
    assert failed(Q.gold_key_checks(g.withColumn("total_messages", lit(-1, "long")))) == "gold.counts_not_negative"
    assert "gold.closure_flag" in failed(Q.gold_key_checks(g.withColumn("has_closed_outcome", ~F.col("has_closed_outcome"))))
    assert "gold.persona_audience" in failed(Q.gold_key_checks(g.withColumn("audience_segment", lit("?"))))
    assert "gold.provenance" in failed(Q.gold_key_checks(g.withColumn("intent_stage_source_family", lit("?"))))
    assert failed(Q.gold_coherence(g.withColumn("risk_signal", lit("?")))) == "gold_coherence.same_risk_signal"
    assert failed(Q.silver_reconcile(leads.withColumn("message_count", F.col("message_count") + 1), m)) == "silver_reconcile.same_message_count"
    one = g.orderBy("lead_key").limit(1)
    assert failed(Q.gold_reconcile(g.join(one, "lead_key", "left_anti"), leads)) == "gold_reconcile.keys_missing_left"
    assert failed(Q.gold_reconcile(g, leads.join(one, "lead_key", "left_anti"))) == "gold_reconcile.keys_missing_right"
    assert failed(Q.macro_checks(macro.withColumn("lead_pct", F.lit(1.5)))) == "gold_macro.share_in_range"
    assert failed(Q.macro_checks(macro.filter("dimension <> 'engagement_bucket'"))) == "gold_macro.dimensions_present"
    assert "silver_messages.no_cpf_leak" in failed(Q.silver_message_checks(m.withColumn("message_body_masked", lit("cpf 123.456.789-01"))))
    assert "silver_leads.no_leaks" in failed(Q.silver_lead_checks(leads.withColumn("lead_contact_ref", lit("a@b.com"))))
    keys = {r.check: (r.status, r.violating_rows, r.samples) for r in Q.violating_keys(m, "silver", "message_id", {"odd": F.col("message_id").isin("m3", "m1", "m2"), "none": F.lit(False)}, 2).collect()}
    assert keys == {"odd": ("failed", 3, "m1,m2"), "none": ("passed", 0, "")}
    empty = gold.dimension_counts(g.limit(0), ("risk_signal", "nowhere")).orderBy("dimension").collect()
    assert [(r.dimension, r.dimension_value, r.lead_count) for r in empty] == [("nowhere", "sem_contrato", 0), ("risk_signal", "sem_informacao", 0)]


def test_engagement_edges(spark):
    got = spark.createDataFrame([(k,) for k in (0, 4, 5, 10, 11, 20, 21)], "n long").select(gold.engagement(F.col("n")).alias("b")).collect()
    assert [r.b for r in got] == [None, "lead_frio", "curta", "curta", "media", "media", "longa"]


def test_drift(spark):
    d = frame(spark, [message(1, message_type="video"), message(2, metadata='{"new":1}')]).withColumn("extra", F.lit(1)).drop("status")
    got = {(r.column_name, r.drift_class, r.policy) for r in B.drift_events(d).collect()}
    assert got == {("status", "missing_required", "block"), ("extra", "unknown", "passthrough_with_alert"), ("new", "unknown_metadata_key", "passthrough_with_alert"), ("message_type", "category_drift", "quarantine")}
    assert "bronze_passthrough__extra" in B.passthrough_names(d).columns
    now = spark.createDataFrame([("x",)] * 5 + [("y",)] * 5, "t string")
    was = spark.createDataFrame([("x",)] * 10, "t string")
    assert D.distribution_shift(D.frequency_changes(D.frequencies(now, ("t",)), D.frequencies(was, ("t",)))).first().shift == 0.5


def test_change_detection(spark):
    a, b = (spark.createDataFrame([(x,) for x in ids], "message_id string") for ids in (["1", "2", "3"], ["3", "1", "2", "2"]))
    c = spark.createDataFrame([("1",), ("9",)], "message_id string")
    assert not D.changed(D.fingerprint(a), D.fingerprint(b)).first().changed
    assert D.changed(D.fingerprint(a), D.fingerprint(c)).first().changed and D.changed(D.fingerprint(a), None).first().changed
    assert [r.message_id for r in D.missing_ids(a, c).collect()] == ["9"] and D.new_ids(a, c).count() == 2


def test_planned_columns(spark):
    g = spark.createDataFrame([("a", 5, None), ("b", 30, 2.0)], "lead_key string, n int, p double")
    got = apply_columns(g, [Bucket("size", (("n > 20", "big"), ("n > 3", "mid")))]).orderBy("lead_key").collect()
    assert [r["size"] for r in got] == ["mid", "big"]
    assert [r.x for r in g.select(condition(g, "p <> 3").alias("x")).collect()] == [False, True]
    assert not any(r.x for r in g.select(condition(g, "other = 1").alias("x")).collect())


def test_publish_stops_at_failed_checks(spark, tmp_path):
    d = spark.range(3)
    bad = Q.results(d, "x", {"none": F.count("*")})
    with pytest.raises(ValueError, match="none"):
        publish({"t": d}, str(tmp_path / "a"), bad)
    assert not (tmp_path / "a" / "versions").exists()
    assert spark.read.parquet(publish({"t": d}, str(tmp_path / "b"))["t"]).count() == 3
    with pytest.raises(ValueError, match="none"):
        publish({"t": d.limit(1)}, str(tmp_path / "b"), bad)
    assert spark.read.parquet(published(spark, str(tmp_path / "b"))["t"]).count() == 3
    assert spark.read.parquet(publish({"t": d.limit(2)}, str(tmp_path / "b"))["t"]).count() == 2
