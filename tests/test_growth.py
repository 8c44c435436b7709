"""Steps that grew faster than their input, or were made anew for each use; cheap conditions must never hide a match."""

from pyspark.sql import functions as F
from test_messages import frame, message

from convolake import contract as C
from convolake.functions import signals as G
from convolake.functions import text as T
from convolake.operators import publication as P
from convolake.operators import silver
from convolake.plans import queries as Q

TEXTS = [
    "", "oi", "ana@x.com", "ANA Paula e ana  paula", "Karla chegou", "carla", "Cárla", "Ａna paula", "cpf 123.456.789-01", "cpf ١٢٣456789-01", "cep 04567-123",
    "fone 99999-0000", "ABC1D23", "abc1234", "r$ 1.200,50", "R$950", "950", "azul", "hdi seguros e porto seguro", "bati o carro", "enchente", "alagamento", "fiat ano 1999 de 2001", "em 2020", "gol 2019",
    "placa ABC1D23 2018", "obrigado, perfeito", "nao quero, um absurdo", "a\tb\n c  d", " x ", "ÇA vai", "urgente",
]


def results(spark, *columns):
    d = spark.createDataFrame([(t,) for t in TEXTS], "t string").coalesce(1)
    return [tuple(r) for r in d.select(*columns).collect()]


def test_conditions_hide_no_match(spark):
    t = F.col("t")
    quick = results(spark, *[T.has_pii(t, k) for k in C.FLAGS], G.competitor(t), G.vehicle_make(t), G.price(t), G.email_provider(t), G.tone_hits(t, C.POSITIVE), G.tone_hits(t, C.NEGATIVE), G.claim_type(t, F.lit("inbound")))
    low, words = F.lower(t), T.match_norm(t)
    asks = low.contains("cobertura") & ~low.contains("tive") & ~low.contains("bati")
    label = lambda text, rules, flags: F.coalesce(*[F.when(text.rlike(f"{flags}{p}"), F.lit(n)) for n, p in rules])
    hits = lambda patterns: sum((words.rlike(p).cast("int") for p in patterns), F.lit(0))
    plain_price = F.translate(F.replace(F.regexp_extract(t, f"(?iU){C.PRICE}", 1), F.lit("."), F.lit("")), ",", ".").try_cast("double")
    slow = results(
        spark, *[t.rlike(C.PII[k]) for k in C.FLAGS], label(t, C.COMPETITORS, "(?iU)"), label(words, [(m, rf"\b{m}\b") for m in C.MAKES], ""), plain_price,
        F.when(t.rlike(f"(?iU){C.EMAIL_DOMAIN}"), "other"), hits(C.POSITIVE), hits(C.NEGATIVE), F.when(~asks, label(low, C.CLAIMS, "(?iU)")),
    )
    assert quick == slow


def test_names_are_found_as_by_the_pattern_alone(spark):
    t = F.col("t")
    x = lambda m: F.regexp_replace(m, r"\p{L}", "X")
    for name in ("Ana Paula", "carla", "k", "", "J. Karla", "Ca rla"):
        n = F.lit(name)
        assert results(spark, T.mask_known_names(t, n)) == results(spark, T.masked_matches(t, T.name_pattern(n), x))


def test_leads_expand_no_whole_rows(spark):
    """Two distinct counts beside the other aggregates would triple every message with all its columns."""
    m = silver.silver_messages(frame(spark, [message(k, conversation_id=f"c{k % 3}") for k in range(9)] + [message(1, conversation_id="c9")]))
    leads = silver.silver_leads(m)
    plan = leads._jdf.queryExecution().optimizedPlan().toString()
    assert all(line.count("#") < 20 for line in plan.splitlines() if "Expand" in line)
    assert [(r.conversation_count, r.message_count) for r in leads.collect()] == [(4, 9)]
    assert leads.columns[5:9] == ["first_seen_at", "last_seen_at", "conversation_count", "message_count"]


def test_silver_is_made_once(spark, tmp_path):
    """Gold with semantics reads stored messages and conversations, and only what it needs of them is stored."""
    spark.createDataFrame([(k, k % 5, None) for k in range(40)], "event_id long, user_id long, ts timestamp").withColumn("ts", F.lit("2024-01-03").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    for query in (Q.gold_overlaid, Q.leads, Q.gold, Q._planned, Q._gold_reconcile, Q._silver_reconcile, Q.hashed_conversations):
        plan = query(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert "event_id" not in plan and "sender_name_masked" not in plan, query.__name__


def test_published_layers_are_stored_once(spark, tmp_path, monkeypatch):
    """Beside the published layers only the messages are stored, with the private columns that leads and gold are made of."""
    spark.createDataFrame([(k, k % 5, None) for k in range(40)], "event_id long, user_id long, ts timestamp").withColumn("ts", F.lit("2024-01-03").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(Q, "scratch_folder", lambda s, name: f"{tmp_path}/stored/{name}")
    rows = {r.layer: (r.rows, r.keys) for r in Q._published(spark, str(tmp_path)).collect()}
    assert set(rows) == set(Q.PUBLISHED) and rows["silver_leads"] == rows["gold"]
    assert {p.name for p in (tmp_path / "stored").iterdir()} == {"silver", "layers"}
    stored = spark.read.parquet(f"{tmp_path}/stored/silver").columns
    assert set(stored) & {*P.FORBIDDEN} == {"message_body", "lead_name_raw"}


def test_beyond_ascii_is_told_from_bytes(spark):
    texts = spark.sql("SELECT * FROM VALUES (X''), (X'6162'), (X'C3A1'), (X'80'), (X'61FF'), (X'C3'), (X'F09F9880'), (X'7F00') AS t(b)").select(F.col("b").cast("string").alias("t")).coalesce(1)
    got = texts.select(T.beyond_ascii(F.col("t")).alias("quick"), F.col("t").rlike(r"[^\x00-\x7F]").alias("slow")).collect()
    assert [r.quick for r in got] == [r.slow for r in got] == [False, False, True, True, True, True, True, False]


def test_texts_without_anything_to_mask_stay(spark):
    t, n = F.col("t"), F.lit("Ana Paula")
    masked = T.mask_email(t)
    for kind in ("cpf", "cep", "phone"):
        masked = T.masked_matches(masked, C.PII[kind], lambda m: F.regexp_replace(m, "[0-9]", "X"))
    assert results(spark, T.mask_body(t, n)) == results(spark, T.mask_known_names(T.mask_plate(masked), n))
