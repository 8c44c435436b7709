import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert {"dimension", "dimension_value", "lead_count", "lead_pct", "rank"} <= set(rows[0].asDict())


def test_streams_match_batches(spark):
    q, d = entry.queries(), "/root/testdata/sf0.001"
    key = lambda df: sorted(map(tuple, df.select("lead_key", "message_count", "latest_outcome").collect()))
    assert key(q["stream_refresh"](spark, d)) == key(q["silver_leads"](spark, d))
    assert q["stream_ingest"](spark, d).count() == q["src_ids"](spark, d).count()


def test_whole_tables_are_returned(spark):
    """Every row of bronze and silver, against plain Python and the SQL."""
    import re
    from pathlib import Path

    import duckdb

    from convolake import contract as C
    from convolake.plans import queries as P

    q, d = entry.queries(), "/root/testdata/sf0.001"
    kinds = {"email": (C.EMAIL, re.I), "phone": (C.PHONE, 0), "cpf": (C.CPF, 0), "cep": (C.CEP, 0), "plate": (C.PLATE, re.I)}
    found = lambda body: ",".join(k for k, (p, f) in kinds.items() if re.search(p, body or "", f))
    masked = {"email": r"[xX._%+-]+@[xX.-]+\.[xX]{2,}", "plate": "[Xx9-]+"}
    bare = lambda body: any(not re.fullmatch(masked.get(k, "(?!)"), m[0]) for k, (p, f) in kinds.items() for m in re.finditer(p, body or "", f))
    bodies = {r.message_id: r.message_body for r in P.bronze(spark, d).select("message_id", "message_body").collect()}
    got = {r.message_id: r.classes for r in q["pii_classes"](spark, d).collect()}
    assert got == {i: found(b) for i, b in bodies.items()} and any(i.endswith("d") for i in got)
    rows = P.silver(spark, d).select("message_id", "direction", "message_type", "message_body").collect()

    def rule(r):
        if r.direction != "inbound":
            return "vocabulary:direction"
        if r.message_type not in ("text", "image"):
            return "vocabulary:message_type"
        return "too_long" if len(r.message_body or "") > 280 else "pii" if bare(r.message_body) else None

    checked = {r.message_id: r.violation for r in q["out_validate"](spark, d).collect()}
    assert checked == {r.message_id: rule(r) for r in rows} and "pii" in checked.values()
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(d).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    for name, whole in (("pii_classes", got), ("out_validate", checked)):
        assert dict(con.execute(entry.oracle_sql()[name]).fetchall()) == whole
