"""Registered queries that SQL cannot express, against plain Python over the whole of a small table."""

import hashlib
import re
import struct
from collections import defaultdict
from datetime import datetime
from difflib import SequenceMatcher

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from convolake import contract as C
from convolake.functions import signals as G
from convolake.operators import change as D
from convolake.operators import common, gold
from convolake.plans import queries as P
from convolake.sources.messages import read_bronze

D1 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return P.held(P.silver(spark, D1), "silver").collect()


def known_names(text, *names):
    for name in names:
        plain = re.sub("[^a-z0-9]+", " ", (name or "").lower()).strip()  # the table's names are plain
        words = [w for w in plain.split(" ") if len(w) >= 2]
        if len(plain) >= 3 and words:
            text = re.sub(r"\b" + r"\s+".join(words) + r"\b", lambda m: re.sub(r"[^\W\d_]", "X", m[0]), text, flags=re.I)
    return text


def masked(body, *names):
    text = re.sub(C.EMAIL, lambda m: re.sub("[A-Za-z0-9]", "x", m[0]), body or "", flags=re.I)
    for pattern in (C.CPF, C.CEP, C.PHONE):
        text = re.sub(pattern, lambda m: re.sub("[0-9]", "X", m[0]), text)
    text = re.sub(C.PLATE, lambda m: re.sub("[0-9]", "9", re.sub(r"[^\W\d_]", "X", m[0].upper())), text, flags=re.I)
    return known_names(text, *names)


def test_masks(spark, silver):
    q = entry.queries()
    bodies = {r.message_id: masked(r.message_body, r.sender_name, r.conversation_lead_name, r.conversation_agent_name) for r in silver}
    got = {r.message_id: r for r in q["mask_body"](spark, D1).collect()}
    assert {i: r.message_body_masked for i, r in got.items()} == bodies and all(r.same_length for r in got.values())
    assert any("XXX XXXXX" in b for b in bodies.values()) and any("xxx" in b for b in bodies.values())
    names = {r.message_id: known_names(r.message_body or "", r.conversation_lead_name, r.conversation_agent_name) for r in silver}
    assert {r.message_id: r.masked for r in q["mask_known_names"](spark, D1).collect()} == names


def test_input_hash(spark, silver):
    def row_hash(r):
        h = 42
        micros = int((r.timestamp - datetime(1970, 1, 1)).total_seconds() * 1_000_000 + 0.5)
        for part in (struct.pack("<q", micros), r.message_id.encode(), r.direction.encode(), r.message_body_masked.encode()):
            h = xxhash.xxh64_intdigest(part, h)
        return h - (h >> 63 << 64)

    found = defaultdict(lambda: [0, 0, 0])
    for r in silver:
        h = row_hash(r)
        n = found[r.conversation_id]
        n[0], n[1], n[2] = n[0] + 1, n[1] ^ h, n[2] + h
    want = {c: hashlib.sha256(f"{c}|{n}|{x}|{s}".encode()).hexdigest() for c, (n, x, s) in found.items()}
    assert {r.conversation_id: r.input_hash for r in entry.queries()["conv_input_hash"](spark, D1).collect()} == want


def test_normalized_outputs(spark):
    def one(value):
        token = re.sub(r"[\s-]+", "_", value.strip().lower())
        if token in P.VOCABULARY:
            return token
        if token == "proposta_enviada":
            return "em_negociacao"
        scored = [(SequenceMatcher(None, token, w).ratio(), w) for w in P.VOCABULARY]
        best = [w for s, w in scored if s >= 0.9 and s == max(scored)[0]]
        return best[0] if len(best) == 1 else None

    rows = entry.queries()["out_normalize"](spark, D1).collect()
    assert rows and all(r.outcome_normalized == one(r.outcome) for r in rows)
    assert {None, "fechado", "em_negociacao"} <= {r.outcome_normalized for r in rows}


def test_bad_timestamps_are_null(spark, tmp_path):
    rows = [("a", "2024-01-02 03:04:05"), ("b", "02/01/2024"), ("c", ""), ("d", None)]
    spark.createDataFrame(rows, "message_id string, timestamp string").write.parquet(f"{tmp_path}/x")
    got = {r.message_id: r.timestamp for r in read_bronze(spark, f"{tmp_path}/x").collect()}
    assert got["a"] is not None and got["b"] is got["c"] is got["d"] is None
    spark.createDataFrame(rows[:1], "message_id string, timestamp string").withColumn("timestamp", F.to_date("timestamp")).write.parquet(f"{tmp_path}/y")
    assert dict(read_bronze(spark, f"{tmp_path}/y").dtypes)["timestamp"] == "timestamp"


def test_gate_events_and_defaults(spark):
    d = spark.createDataFrame([("ok", "x", None), ("a@b.com", "y", None)], "free string, plain string, sender_name string")
    got = {r.column_name: (r.passed, r.reason) for r in D.privacy_gate(d, ("free", "plain", "sender_name"), ("sender_name",)).collect()}
    assert got == {"free": (False, "sensitive_pattern:email"), "plain": (True, None), "sender_name": (False, "forbidden_raw_column")}
    g = spark.createDataFrame([("l", 1, None)], f"lead_key string, {C.PASSTHROUGH}a int, {C.PASSTHROUGH}b int")
    assert [(r.column_name, r.filled_rows) for r in gold.partition_events(g, ("b",)).collect()] == [(f"{C.PASSTHROUGH}a", 1)]
    assert gold.partition_events(g, ("a", f"{C.PASSTHROUGH}b")).count() == 0 and gold.public_gold(g, ("b",)).columns == ["lead_key", f"{C.PASSTHROUGH}b"]
    old = spark.createDataFrame([("inbound", True, None), ("outbound", True, True), (None, None, None)], "direction string, price_objection_signal boolean, price_objection_signal_inbound boolean")
    rows = G.with_directional_defaults(old).collect()
    assert [(r.price_objection_signal_inbound, r.price_objection_signal_outbound, r.urgency_strength_inbound) for r in rows] == [(True, False, 0), (True, True, 0), (False, False, 0)]
    assert [r.key for r in common.bounded_sample(spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "k string"), "k", 2).collect()] == ["<null>", "a"]
