"""Sketches, observation history, quarantine in one pass, profiles, samples and fingerprints."""

import math
import statistics

import pytest
from pyspark.sql import functions as F
from test_messages import frame, message

from convolake import contract as C
from convolake.operators import bronze as B
from convolake.operators import change as D
from convolake.plans.columns import row_sample, schema_sample


def test_merged_sketches_equal_one_pass(spark):
    """Large means with small spreads, which a difference of sums of squares would lose; text, nulls, nothing."""
    rows = [(str(1e9 + k % 7 / 10) if k % 3 else None, f"v{k}", "x", None) for k in range(30_000)]
    d = spark.createDataFrame(rows, "n string, many string, one string, none string")
    names = tuple(d.columns)
    parts = [d.filter(F.substring("many", 2, 9).cast("int") % 4 == k) for k in range(4)]
    log = D.column_sketches(parts[0], names, 0)
    for k in (1, 2, 3):
        log = log.unionByName(D.column_sketches(parts[k], names, k))
    merged = D.merged_sketches(log)
    twice = D.merged_sketches(D.merged_sketches(log.filter("cycle < 2")).unionByName(D.merged_sketches(log.filter("cycle >= 2"))))
    exact = {r.column_name: r for r in D.promotion_stats(d, names).collect()}
    numbers = [1e9 + k % 7 / 10 for k in range(30_000) if k % 3]
    for found in (merged, twice):
        got = {r.column_name: r for r in D.sketched_stats(found).collect()}
        assert {c: (r.density, r.numeric, r.value_class) for c, r in got.items()} == {c: (r.density, r.numeric, r.value_class) for c, r in exact.items()}
        assert math.isclose(got["n"].mean, statistics.fmean(numbers), rel_tol=1e-12) and math.isclose(got["n"].std, statistics.stdev(numbers), rel_tol=1e-6)
        assert got["none"].mean is None and got["many"].std is None
        # the error of the sketch, measured: 0.8 % is one standard error
        assert abs(got["many"].distinct_values - 30_000) < 30_000 * 0.04 and (got["n"].distinct_values, got["one"].distinct_values, got["none"].distinct_values) == (7, 1, 0)
    assert exact["n"].value_class == "numeric_continuous" and exact["one"].value_class == "categorical_text"
    empty = D.sketched_stats(D.merged_sketches(D.column_sketches(d.limit(0), names, 0))).count()
    assert empty == 0


def history(events, until):
    """The rule in plain Python: (cycle, dtype, class) of one column, cycle by cycle."""
    entry, seen = None, {c: (t, k) for c, t, k in events}
    for cycle in range(min(seen), until + 1):
        if cycle in seen:
            if entry and entry["kind"] == seen[cycle]:
                entry["cycles"] += 1
            else:
                entry = {"cycles": 1, "kind": seen[cycle], "wrong": entry["wrong"] if entry else 0}
            entry.update(absent=0, last=cycle, wrong=min(5, entry["wrong"] + 1) if seen[cycle][1] == "type_mismatch" else 0)
        elif entry:
            entry["absent"] += 1
            if entry["absent"] >= 20:
                entry = None
    return entry and (entry["cycles"], entry["last"], entry["absent"], entry["wrong"], *entry["kind"])


def test_observation_history(spark):
    u, m = ("int", "unknown"), ("int", "type_mismatch")
    log = {
        "steady": [(c, *u) for c in range(1, 41)],
        "gaps": [(c, *u) for c in (1, 2, 5, 24, 40)],  # 18 absences go, the run goes on
        "pruned": [(c, *u) for c in (1, 2, 3)],
        "back": [(c, *u) for c in (1, 2, 23, 30)],  # 20 absences end the run
        "edge": [(c, *u) for c in (1, 21, 22)],
        "retyped": [(c, "int" if c < 30 else "double", "unknown") for c in range(1, 41)],
        "wrong": [(c, *(m if c > 33 else u)) for c in range(20, 41)],
        "mended": [(c, *(m if c in (38, 39) else u)) for c in range(30, 41)],
        "late": [(40, *m)],
        "absent19": [(c, *u) for c in (20, 21)],
        "absent20": [(20, *u)],
    }
    rows = [(c, name, t, k) for name, events in log.items() for c, t, k in events]
    got = D.observation_runs(spark.createDataFrame(rows, "cycle int, column_name string, dtype string, drift_class string")).collect()
    have = {r.column_name: (r.cycles, r.last_cycle, r.absent_cycles, r.mismatches, r.dtype, r.drift_class) for r in got}
    assert have == {name: h for name, events in log.items() if (h := history(events, 40))}
    assert set(log) - set(have) == {"pruned", "absent20"}


@pytest.mark.parametrize("timestamps, metadata", [(True, True), (True, False), (False, True), (False, False)])
def test_quarantine_is_one_pass(spark, tmp_path, capsys, timestamps, metadata):
    rows = [message(k, **({"timestamp": None} if k % 3 == 0 else {}), **({"metadata": "x"} if k % 4 == 0 else {})) for k in range(24)]
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    reads = spark.read.parquet(f"{tmp_path}/in")
    report = B.quarantine_write(reads, f"{tmp_path}/out", timestamps, metadata).first()
    bad = {f"m{k}" for k in range(24) if (timestamps and k % 3 == 0) or (metadata and k % 4 == 0)}
    assert tuple(report) == (24, 8 * timestamps, 6 * metadata, len(bad)) == tuple(B.quarantine_counts(reads, timestamps, metadata).first())
    gone, kept = (B.quarantine_read(spark, f"{tmp_path}/out", C.BRONZE_SCHEMA, side) for side in (True, False))
    assert {r.message_id for r in gone.collect()} == bad and {r.message_id for r in kept.collect()} == {f"m{k}" for k in range(24)} - bad
    assert kept.columns == list(C.REQUIRED_COLUMNS) and gone.columns[-1] == "quarantine_reason"
    reads.withColumn("r", B.quarantine_reason(timestamps, metadata)).explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    gone.explain()
    assert "PartitionFilters: [isnotnull(quarantined" in capsys.readouterr().out


def test_profile_values(spark, capsys):
    rows = [message(k, status=f"s{k % 13:02d}" if k % 5 else None, direction="inbound" if k < 30 else "outbound") for k in range(52)]
    df = frame(spark, rows)
    got = {(r.column_name, r.value): (r.rows, r["rank"]) for r in B.profile_values(df, ("direction", "status", "conversation_outcome")).collect()}
    assert got["direction", "inbound"] == (30, 1) and got["direction", "outbound"] == (22, 2) and got["conversation_outcome", None] == (52, 1)
    assert got["status", None] == (11, 1) and sum(c == "status" for c, _ in got) == 10
    assert ("status", "s02") in got and ("status", "s12") not in got
    df.write.mode("overwrite").format("noop").save()
    B.profile_values(df).explain()
    assert capsys.readouterr().out.count("Expand") == 1  # all columns are counted together


def test_samples_do_not_depend_on_order(spark):
    d = spark.createDataFrame([(f"k{k % 40}", k % 3, "secret", "body") for k in range(200)], "k string, n int, s string, message_body string")
    for sample in (lambda x: schema_sample(x, hidden=("s",)), lambda x: row_sample(x, hidden=("s",))):
        one, other = (sorted(map(tuple, sample(x).collect()), key=str) for x in (d.coalesce(1), d.orderBy(F.rand(3)).repartition(7)))
        assert one == other
    samples = {r.column_name: (r.dtype, r.samples.split(",")) for r in schema_sample(d).collect()}
    assert set(samples) == {"k", "n", "s"} and samples["n"] == ("int", ["0", "1", "2"])
    assert len(samples["k"][1]) == 5 and samples["k"][1] != sorted(f"k{k}" for k in range(40))[:5]
    assert row_sample(d).count() == 10 and row_sample(d.limit(0)).count() == 0


def test_fingerprints_between_runs(spark, tmp_path):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "message_id string")
    at = D.Fingerprints(spark, str(tmp_path / "f"))
    assert at.stored() is None
    seen = [at.observe(x).first() for x in (ids("a", "b"), ids("b", "a", "a"), ids("a", "c"), ids("a", "c", None), ids())]
    assert [(r.run, r.changed, r.ids, r.added) for r in seen] == [(0, True, 2, 2), (1, False, 2, 0), (2, True, 2, 0), (3, True, 3, 1), (4, True, 0, -3)]
    assert (seen[1].xor_differs, seen[1].total_differs, seen[2].xor_differs, seen[2].total_differs) == (False, False, True, True)


def test_triggers(spark):
    rows = lambda n: spark.range(n)
    shifts = spark.createDataFrame([("channel", 0.2)], "column_name string, shift double")
    rises = spark.createDataFrame([("status", 0.0, 0.5, 0.5)], "column_name string, before double, null_rate double, rise double")
    assert D.drift_triggers(shifts, rises, D.record_drop(rows(8), rows(10))).first().triggers == "distribution_shift:channel,null_rate:status,record_drop"
    assert D.drift_triggers(shifts.limit(0), rises.limit(0), D.record_drop(rows(9), rows(10))).first().triggers == ""


def test_schema_ok(spark):
    d = frame(spark, [message(1)])
    assert {r.schema_ok for r in B.validation_report(d).collect()} == {True}
    assert {r.schema_ok for r in B.validation_report(d.drop("status")).collect()} == {False}


def test_suppressed_alerts_over_range_borders(spark):
    """One frequent key, one rare, one null: every alert against all earlier ones, whatever the ranges."""
    import random
    from datetime import datetime, timedelta

    rng, start = random.Random(1), datetime(2024, 1, 1, 23)
    rows = [(k, start + timedelta(minutes=rng.choice([1, 7, 29, 30, 31, 500]) * rng.randrange(60)), i) for i, k in enumerate(["a"] * 300 + ["b"] * 20 + [None] * 20)]
    rows += [("a", None, 1_000), ("b", None, 1_001)]
    want = set()
    for k, t, i in rows:
        past = [(u, j) for m, u, j in rows if m == k and u is not None and t is not None and (u, j) < (t, i)]
        if past and t - max(past)[0] <= timedelta(minutes=30, seconds=0.999):
            want.add(i)
    d = spark.createDataFrame(rows, "dedupe_key string, run_at timestamp, id int")
    for hours in (1, 24):
        got = D.suppressed_alerts(d, hours=hours).collect()
        assert len(got) == len(rows) and {r.id for r in got if r.suppressed} == want
