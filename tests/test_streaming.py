"""Streams: late rows, bounded state, leads replaced bucket by bucket."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from test_messages import frame, message

from convolake.operators.silver import silver_leads, silver_messages
from convolake.streaming import refresh as R

START = datetime(2024, 1, 1)


def put(spark, at, rows):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{at}/in")


def test_late_rows_go_to_quarantine(spark, tmp_path):
    at = str(tmp_path)
    at_hour = lambda k, h, **over: message(k, timestamp=START + timedelta(hours=h), **over)
    run = lambda: R.ingest_watermarked(spark, f"{at}/in", f"{at}/out", f"{at}/checkpoint", delay_seconds=3600)
    put(spark, at, [at_hour(1, 0), at_hour(2, 10), at_hour(2, 10), message(3, timestamp=None)])
    first = run()
    # an hour before the latest is the watermark: 4 is at it (late), 5 just after, 2 comes again, 6 is new
    put(spark, at, [at_hour(4, 9), message(5, timestamp=START + timedelta(hours=9, milliseconds=1)), at_hour(2, 10), at_hour(6, 20), at_hour(7, 1)])
    second = run()
    put(spark, at, [at_hour(8, 30, message_body="later"), at_hour(9, 12)])
    third = run()
    got = sorted((r.message_id, r.outcome) for r in spark.read.schema(R.OUTCOMES).parquet(f"{at}/out").collect())
    assert got == [("m1", "stored"), ("m2", "stored"), ("m3", "invalid_timestamp"), ("m4", "late"), ("m5", "stored"), ("m6", "stored"), ("m7", "late"), ("m8", "stored"), ("m9", "late")]
    assert (first.batches, second.batches, third.batches) == (1, 1, 1)
    assert first.dropped + second.dropped + third.dropped == 3  # what Spark dropped is what is in quarantine
    # five ids have passed; those behind the watermark have left the state
    put(spark, at, [at_hour(10, 31)])
    assert run().state_rows <= 2
    assert run().batches == 0 and run().rows == 0


def leads_of(df):
    names = sorted(df.columns)
    return sorted(str([r[c] for c in names]) for r in df.collect())


def files(at):
    return {f"{d}/{f}" for d, _, names in os.walk(f"{at}/table/leads") for f in names if f.endswith(".parquet")}


def test_lead_table_equals_a_rebuild(spark, tmp_path):
    """Three micro-batches, the last of which moves a conversation from one lead to another and leaves one without messages."""
    at = str(tmp_path)
    table = R.LeadTable(spark, f"{at}/table", buckets=8)
    phone = lambda k: f"+5511999{k:06d}"
    batches = [
        [message(k, conversation_id=f"c{k % 5}", sender_phone=phone(k % 5)) for k in range(10)],
        [message(k, conversation_id=f"c{k % 4}", sender_phone=phone(k % 4), conversation_outcome="fechado") for k in range(10, 14)] + [message(90, conversation_id=None)],
        [message(95, conversation_id="c4", timestamp=datetime(2023, 1, 1), sender_phone=phone(77))],  # earlier than all: it names the lead
    ]
    rows, before = [], set()
    for n, batch in enumerate(batches):
        put(spark, at, batch)
        rows += batch
        run = table.follow(f"{at}/in", f"{at}/checkpoint")
        assert (run.batches, run.rows) == (1, len(batch))
        assert leads_of(table.leads()) == leads_of(silver_leads(silver_messages(frame(spark, rows)))), n
        if n == 2:
            touched = {f"bucket={b}/" for b in R._few(silver_messages(frame(spark, rows)).filter("conversation_id = 'c4'").union(silver_messages(frame(spark, rows[:-1])).filter("conversation_id = 'c4'")).select(table._bucket(F.col("lead_key")).alias("b")))}
            still = {f for f in before if not any(t in f for t in touched)}
            assert still and still <= files(at)  # buckets of other leads keep their files
        before = files(at)
    assert table.leads().count() == 6
    # a batch that runs again changes nothing
    was = leads_of(table.leads())
    table.apply(frame(spark, batches[2]), 2)
    assert leads_of(table.leads()) == was
    assert table.follow(f"{at}/in", f"{at}/checkpoint").batches == 0
