"""Queries that once did a part of their job."""

import json
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import functions as F
from test_messages import frame, message

import __spark_entry__ as entry
from convolake.operators import checks as Q
from convolake.operators import conversations as V
from convolake.operators import gold, silver
from convolake.plans import queries as P

D1 = "/root/testdata/sf0.001"


def from_sql(name):
    """The rows of a query's SQL, as dictionaries."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(D1).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    found = con.sql(entry.oracle_sql()[name])
    return [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]


def test_conversations_hold_their_masked_messages_in_order(spark):
    at = lambda minute: datetime(2024, 1, 1, 10, minute)
    rows = [
        message(3, timestamp=at(9), direction="outbound", sender_name="Diego", message_body="oi Ana, fiat 2019", message_type="image"),
        message(2, timestamp=at(5), message_body="cpf 123.456.789-01"),
        message(1, timestamp=at(5), message_body="mail ana@x.com"),
        message(4, timestamp=at(7), message_body=None),
        message(5, conversation_id="c2", direction="outbound", metadata=None),
        message(6, conversation_id="c2", direction="outbound", message_body="tchau", metadata='{"device":"a"}'),
    ]
    m = silver.silver_messages(frame(spark, rows))
    got = {r.conversation_id: r for r in V.conversation_features(m).collect()}
    assert [tuple(x) for x in got["c1"].messages] == [
        (at(5), "inbound", "text", "mail xxx@x.xxx"),
        (at(5), "inbound", "text", "cpf XXX.XXX.XXX-XX"),
        (at(7), "inbound", "text", ""),
        (at(9), "outbound", "image", "oi XXX, fiat 2019"),
    ]
    assert [(r.message_count, r.inbound_count, r.outbound_count, r.has_vehicle_signal, r.response_latency_band) for r in (got["c1"], got["c2"])] == [(4, 3, 1, True, "rapida"), (1, 0, 1, False, "sem_evidencia")]
    late = m.withColumn("timestamp", F.when(F.col("message_id") != "m1", F.col("timestamp")))
    assert [x.text[:3] for x in V.conversation_features(late).filter("conversation_id = 'c1'").first().messages] == ["cpf", "", "oi ", "mai"]


def test_conv_features_returns_all_features_and_messages(spark):
    rows = entry.queries()["conv_features"](spark, D1)
    assert set(rows.columns) == set(V.conversation_features(P.silver(spark, D1)).columns)
    key = lambda r: r["conversation_id"]
    got = sorted((r.asDict() for r in rows.collect()), key=key)
    assert got == sorted(from_sql("conv_features"), key=key)
    assert sum(len(json.loads(r["messages"])) for r in got) == sum(r["message_count"] for r in got) == P.silver(spark, D1).count()


def test_semantics_gather_no_messages(spark):
    m = silver.silver_messages(frame(spark, [message(1)]))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toJSON()
    features = V.conversation_features(m)
    assert "CollectList" in plan(features) and "CollectList" not in plan(V.conversation_semantics(features))


def test_gold_is_reconciled_with_messages(spark):
    rows = [message(k, conversation_id=f"c{k % 4}", direction="outbound" if k % 3 == 0 else "inbound", sender_phone=f"+551199999{k % 2:04d}", message_body="cpf 123.456.789-01" if k % 2 else f"oi {k}") for k in range(12)]
    m = silver.silver_messages(frame(spark, [*rows, message(99, conversation_id="c1", timestamp=rows[1][2], sender_phone=rows[1][4], message_body=rows[1][7], status="read")])).cache()
    leads = silver.silver_leads(m).cache()
    g = gold.gold_leads(leads, m).cache()
    failed = lambda gold, leads=leads, messages=m: {r.check: r.violating_rows for r in Q.gold_reconcile(gold, leads, messages).filter("status = 'failed'").collect()}
    n = g.count()
    assert n > 1 and failed(g) == {} and g.agg(F.sum("duplicate_events_removed").alias("n")).first().n == 1
    assert failed(g.withColumn("total_messages", F.col("total_messages") + 1)) == {"same_history_total_messages": n, "same_sum_of_directions": n}
    assert failed(g.withColumns({"inbound_messages": F.col("outbound_messages") + 100, "outbound_messages": F.col("inbound_messages")})) == {"same_history_inbound_messages": n, "same_history_outbound_messages": n, "same_sum_of_directions": n}
    assert failed(g.withColumn("duplicate_events_removed", F.col("duplicate_events_removed") + 1)) == {"same_history_duplicate_events_removed": n}
    flags = [f"contains_{k}" for k in ("email", "phone", "cpf", "cep", "plate")] + [f"mentioned_{k}" for k in ("vehicle", "competitor", "sinistro")]
    assert failed(g.withColumns({f: ~F.col(f) for f in flags})) == {f"same_history_{f}": n for f in flags}
    # a mistake that gold took over from leads
    later = {"last_seen_at": F.col("last_seen_at") + F.expr("INTERVAL 1 DAY"), "conversation_count": F.col("conversation_count") + 1}
    assert failed(g.withColumns(later), leads.withColumns(later)) == {"same_history_last_seen_at": n, "same_history_conversation_count": n}
    one = g.orderBy("lead_key").limit(1).select("lead_key")
    assert failed(g, messages=m.join(one, "lead_key", "left_anti")) == {"keys_missing_messages": 1}
    assert failed(g, leads.join(one, "lead_key", "left_anti"), m.join(one, "lead_key", "left_anti")) == {"keys_missing_right": 1}


def test_dq_gold_reconcile_finds_what_is_planted(spark):
    got = {r.check: r.violating_rows for r in entry.queries()["dq_gold_reconcile"](spark, D1).collect()}
    assert got == {r["check"]: r["violating_rows"] for r in from_sql("dq_gold_reconcile")}
    assert len(got) == 22 and all(got.values())
