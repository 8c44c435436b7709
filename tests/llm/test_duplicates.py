"""Operators 7, 8 and 9 and the pipeline against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from convolake.llm import groups, line_dups, near_dups, repeats
from convolake.llm.common import Scratch

rng = random.Random(11)
WORDS = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(600)]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS) + "é"
    return " ".join(w)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def components(texts):
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}


@pytest.mark.parametrize("sizes", [{}, {"best": 1, "tile": 5, "sent": 0}])
def test_near_duplicates(spark, docs, sizes):
    base = prose(200)
    texts = [edited(base, rng.randint(0, 7)) for _ in range(60)] + [prose(80)] * 5 + ["a b c", "A  b c", "a b", "", None, " \n"]
    chain = prose(150)
    for _ in range(20):
        chain = edited(chain, 3)
        texts.append(chain)
    rng.shuffle(texts)
    d = docs(texts, n="x", regs=1, comp="y").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dups.near_duplicates(d, **sizes).collect()}
    assert got == components(texts)
    if sizes:
        return
    kept = near_dups.without_near_duplicates(d)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, v in got.items() if v[2]}
    assert sorted(r.doc_id for r in near_dups.without_near_duplicates(d, sent=0).collect()) == sorted(r.doc_id for r in kept.collect())


def test_near_duplicates_edges(spark, docs):
    assert near_dups.near_duplicates(docs([])).count() == 0
    d = docs(["a b c d e f", "a b c d e f"]).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dups.near_duplicates(d).collect()}
    assert got == {None: (None, True), 1: (1, True)}
    twice = docs(["a b c d e f"]).union(docs(["a b c d e f"]))
    assert [(r.component_id, r.kept) for r in near_dups.near_duplicates(twice).collect()] == [(0, True)] * 2


def test_rows_with_one_doc_id_are_one_node(spark, docs):
    a, b = prose(60), prose(60)
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, prose(60)), (4, None), (1, a)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dups.near_duplicates(d).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}
    kept = near_dups.without_near_duplicates(d).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id == 1) == [(1, min(a, b))] and {r.doc_id for r in kept} == {1, 4}


def test_many_pairs_just_below_the_threshold(spark, docs):
    """A bucket of documents that all share about 0.7 with each other, a few of them linked: the second comparison."""
    base = prose(120)
    texts = [edited(base, 4) for _ in range(60)]
    texts += [edited(t, 1) for t in texts[:9]] + [base]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dups.near_duplicates(docs(texts).repartition(3), best=1, tile=16).collect()}
    assert got == components(texts)


def test_registers_merge_and_bands_find_pairs():
    r = np.random.default_rng(3)
    found = wide = 0
    for _ in range(300):
        h = r.integers(0, 2**64, 460, dtype=np.uint64)
        a, b = np.sort(h[:402]), np.sort(h[57:])  # 345 of 460 values are shared: just the threshold
        x, y = near_dups.registers(np.concatenate((a, b)), np.array([0, len(a)]), near_dups.WIDE)
        union = near_dups.registers(np.sort(h), np.array([0]), near_dups.WIDE)[0]
        assert (near_dups.merged(x, y) == union).all()
        n, k = near_dups.BANDS, near_dups.ROWS
        found += (x[: n * k].reshape(n, k) == y[: n * k].reshape(n, k)).all(axis=1).any() and ((x ^ y)[: near_dups.REGISTERS] & 255 == 0).sum() >= near_dups.EQUAL
        wide += ((x ^ y) & 255 == 0).sum() >= near_dups.WIDE_EQUAL
    assert found == 300 and wide == 300


def test_estimate_is_close():
    a, b = list(range(1000)), list(range(200, 1200))
    h = near_dups.mix(np.array(a + b, np.uint64) + np.uint64(1))
    r = near_dups.registers(h, np.array([0, 1000]))
    assert abs(near_dups.estimate(np.array([1000.0]), np.array([1000.0]), r[:1], r[1:])[0] - 2 / 3) < 0.2


def removed_lines(texts):
    sets, first, gone = [], {}, set()
    lines = [(i, k, frozenset(words_of(x))) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    for x in lines:
        if x[2] not in first:
            first[x[2]] = x
            if any(1000 * len(x[2] & s) >= 800 * len(x[2] | s) for s in sets):
                gone.add(x[2])
            sets.append(x[2])
    out = defaultdict(list)
    for i, k, s in lines:
        if s in gone or first[s][:2] != (i, k):
            out[i].append(k)
    return out


@pytest.mark.parametrize("sizes", [{}, {"common": 12, "best": 1}, {"common": 4, "tile": 3, "best": 1, "sent": 0}])
def test_line_dedup(spark, docs, sizes):
    base = [prose(rng.randint(1, 40)) for _ in range(60)]
    texts = ["\n".join(edited(rng.choice(base), rng.randint(0, 3)) if rng.random() < 0.7 else prose(12) for _ in range(8)) for _ in range(40)]
    texts += [texts[0], None, "", "\n\n", "same\nsame\nSAME same", "x " * 5000]
    d = docs(texts, line=1, rid="x", removed=2).repartition(3)
    want = removed_lines(texts)
    got = defaultdict(list)
    for r in line_dups.duplicate_lines(d, **sizes).collect():
        got[r.doc_id] += r.removed
    assert got == want
    if sizes:
        return
    out = line_dups.without_duplicate_lines(d)
    assert out.columns == d.columns
    for r in out.collect():
        t = texts[r.doc_id]
        assert r.text == (t if r.doc_id not in want else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[r.doc_id]))
    shuffled = line_dups.without_duplicate_lines(d, sent=0)
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, out.collect()))
    assert line_dups.duplicate_lines(docs([])).count() == 0


@pytest.mark.parametrize("common", [2, 8, 30])
def test_long_lines_are_found_by_neighbours(spark, docs, common):
    def changed(words):
        n = rng.randint(0, len(words) // 8)
        words = [w for w in words if rng.random() > rng.choice([0, 0.05, 0.15])]
        return words + rng.sample(WORDS, n)

    base = [rng.sample(WORDS, rng.randint(30, 150)) for _ in range(25)]
    texts = ["\n".join(" ".join(changed(rng.choice(base))) for _ in range(5)) for _ in range(40)]
    got = {r.doc_id: r.removed for r in line_dups.duplicate_lines(docs(texts), common=common, best=1, tile=40).collect()}
    assert got == removed_lines(texts)


def test_keys_grow_with_the_line_only():
    for n in (100, 500, 2_000, 8_000):
        words = np.sort(line_dups.mix(np.arange(n, dtype=np.uint64))) >> np.uint64(8) | np.uint64(200 << 56)
        owner, _, _ = line_dups.prefix_keys(words, np.array([0]), np.array([n]), 0.8)
        prefix = n - 8 * n // 10 + 1
        assert prefix < len(owner) <= 3 * prefix


def pairs_of(batches):
    return {tuple(x.values()) for b in batches for x in b.to_pylist()}


def test_pairs_held_do_not_change_what_is_passed_on():
    sets = [set(rng.sample(range(30), 20)) for _ in range(3)]
    sets = [x ^ {rng.randrange(30)} for x in sets for _ in range(40)]
    maps = np.array([sum(1 << w for w in x) for x in sets], np.int64)
    n = len(sets)
    rows = line_dups.pa.table({"key": np.repeat([1, 2], n // 2), "doc_id": np.arange(n), "line": np.zeros(n, np.int32), "n": np.array([len(x) for x in sets], np.int32), "place": np.zeros(n, np.int32), "m1": maps, "m2": np.zeros(n, np.int64), "asked": np.ones(n, bool)})
    for best in (1, 2, None):
        whole = pairs_of(line_dups._partners(rows, 0.8, best))
        assert whole and pairs_of(line_dups._partners(rows, 0.8, best, 1)) == whole


def brute_repeats(texts, n=repeats.LENGTH):
    seen = Counter()
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        seen.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = []
    for b in raw:
        mark = np.zeros(len(b) + 1, int)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                mark[i] += 1
                mark[i + n] -= 1
        cover = np.cumsum(mark)[: len(b)] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~cover])
        out.append((len(b), int(cover.sum()), int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("sizes", [{}, {"bucket": 20, "group": 5}])
def test_repeats(spark, docs, sizes):
    base = prose(300)
    texts = [edited(base, rng.randint(1, 6)) for _ in range(40)] + [base] * 3 + ["a" * 1000, "ab" * 500, "a" * 399, "a" * 400, "b" * 401, "", None]
    texts += ["x" * 400 + "y" + "x" * 400] + [prose(60) + base[300 : 300 + rng.randint(350, 700)] + prose(60) for _ in range(10)]
    d = docs(texts, rid="clash", pos=1).repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in repeats.remove_repeats(d, **sizes).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)


def test_multikey_sort():
    r = np.random.default_rng(5)
    m = r.integers(0, 3, (3000, 16)).astype(np.uint8)
    m[500:1500] = m[7]
    assert [m[i].tobytes() for i in repeats.multikey_sort(m)] == sorted(x.tobytes() for x in m)
    g = r.integers(0, 4, 3000)
    assert [(g[i], m[i].tobytes()) for i in repeats.multikey_sort(m, g)] == sorted((k, x.tobytes()) for k, x in zip(g, m, strict=True))


def test_long_texts_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1500)
    base = prose(900)
    whole = [repeats.window_anchors(np.frombuffer(base.encode(), np.uint8), np.array([len(base.encode())]))]
    got = repeats.anchor_rows(iter([__import__("pandas").DataFrame({"rid": [1], "text": [base]})]))
    starts = {p - d for b in got for p, lo, hi in zip(b["pos"], b["dlo"], b["dhi"], strict=True) for d in range(lo, hi + 1)}
    assert starts == {x for a, first, last, *_ in whole for f, t in zip(first, last, strict=True) for x in range(f, t + 1)}


def test_repeats_edges(spark, docs):
    assert repeats.remove_repeats(docs([])).count() == 0
    twice = docs(["q" * 10 + prose(100)])
    got = repeats.remove_repeats(twice.union(twice)).collect()
    assert [(r.n_removed, r.n_spans) for r in got] == [(r.n_bytes, 1) for r in got]


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    leak = prose(20)
    good = [prose(60) for _ in range(6)]
    texts = [*good, good[0] + " more words", prose(5), prose(40) + " " + leak + " " + prose(40), None]
    spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 6}  # too short, leaked and empty documents are gone; 6 has lost its only line
    assert got[6].n_pieces == 0 and all(r.lossless for r in got.values())
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "sentence_pieces"]


def test_pairs_of_large_groups_are_held_in_little_memory():
    """A group in which each of 3,000 lines has all others as partners; the pairs are those of another buffer."""
    draw, n = np.random.default_rng(1), 3_000
    maps = draw.integers(0, 4, n)
    rows = pa.table({"key": np.zeros(n, np.int64), "n": draw.integers(20, 24, n).astype(np.int32), "place": np.zeros(n, np.int32), "line": np.arange(n, dtype=np.int32), "doc_id": np.arange(n), "m1": maps, "m2": maps})
    plain = pa.Table.from_batches(line_dups._partners(rows, 0.8, 2, 1 << 21))
    tracemalloc.start()
    try:
        got = pa.Table.from_batches(line_dups._partners(rows, 0.8, 2))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.equals(plain) and got.num_rows > n and peak < 80e6, (got.num_rows, peak)


def test_narrow_rows_are_not_measured_one_by_one(spark):
    """Spark asks for the bytes of a batch after each row, which took more time than the rows; the number of rows is limited."""
    limit, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"

    def seen(batches):
        from pyspark import TaskContext

        for b in batches:
            yield pa.RecordBatch.from_pydict({"limit": [TaskContext.get().getLocalProperty(limit)], "rows": [b.num_rows]})

    s, before = Scratch(spark), spark.conf.get(limit)
    found = lambda **how: [tuple(r) for r in s.written(spark.range(15_000).coalesce(1).mapInArrow(seen, "limit string, rows long"), "seen", **how).collect()]
    assert {x for x, _ in found(narrow=True)} == {str(2**31 - 1)}
    assert {x for x, _ in found()} != {str(2**31 - 1)} and spark.conf.get(limit) == before
    most = spark.conf.get(rows)
    try:
        spark.conf.set(rows, "0")
        assert {x for x, _ in found(narrow=True)} != {str(2**31 - 1)}
    finally:
        spark.conf.set(rows, most)
    s.clear()


def test_tiles_of_tiles_have_one_block(spark):
    """Groups that are still large are dealt once more; all pairs of their members still meet."""
    s = Scratch(spark)
    d = spark.range(40).select(F.lit(7).cast("long").alias("key"), "id")
    twice = groups.tiled(groups.tiled(d, "key", ["id"], 8, s), "key", ["id"], 2, s)
    assert twice.columns == ["key", "id", "block"]
    met = defaultdict(set)
    for r in twice.collect():
        met[r.key].add(r.id)
    assert {(a, b) for ids in met.values() for a in ids for b in ids} == {(a, b) for a in range(40) for b in range(40)}
    s.clear()
