"""The queries and the pipeline as they are registered, over a small folder of tables with awkward rows."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_repeats, components, edited, prose, removed_lines
from test_rules import base, quality_counts

import __spark_entry__ as entry
from convolake.llm import pii, registry

LEAK = prose(25)
LONG = prose(9_000)
TEXTS = [
    prose(60), prose(30) + "\n" + prose(30), None, "", " \n\t", LONG, edited(LONG, 5), prose(40) + " " + LEAK + " " + prose(40),
    "mail a.b@mail.example.com or +1 (499) 555-6503 now", "4111 1111 1111 1111 from 10.0.0.1", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "é😀 " * 300,
    "Licensed under the Apache License, Version 2.0.", prose(200), "x y z",
]
TEXTS += [edited(TEXTS[13], 2), TEXTS[13], TEXTS[0] + "\n" + TEXTS[0], TEXTS[0].upper()]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, start long, n int, line int, id long, comp long, spans string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None, len(t or ""), "clash", 1, 2, 3, 4, 5, "x") for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(0, LEAK), (1, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    vectors = [[float((i * 37 + k * k * 11 + i * i * k) % 101) / 100 for k in range(5)] for i in range(12)] + [None, [], [0.5, None, 0.1, 0.2, 0.3], [0.1] * 4 + [float("nan")], [float("inf")] + [0.1] * 4, [0.1, 0.2]]
    spark.createDataFrame([(i if i != 3 else None, v, 1, "clash", 2.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, y string, whitened double").write.parquet(f"{at}/embeddings.parquet")
    return at


@pytest.fixture(scope="module")
def results(spark, folder):
    return {n: [r.asDict() for r in q(spark, folder).collect()] for n, q in registry.queries().items()}


def by_id(rows):
    out = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_every_document_has_a_row(results):
    for name, rows in results.items():
        if name not in ("op4_decontamination", "op12_embedding_whitening"):
            assert sorted(r["doc_id"] for r in rows) == list(range(len(TEXTS))), name


def test_op1(results):
    for i, r in by_id(results["op1_pii"]).items():
        want = base(TEXTS[i])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == j for _, j, _ in want) for k in range(4)]
        spans = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        got = [x for x in r["spans"].split(",") if x]
        assert set(spans) <= set(got) and r["n_spans"] == len(got)
        assert got == sorted(got, key=lambda x: (int(x.split(":")[1]), pii.ALL_KINDS.index(x.split(":")[0])))
    assert any(x["spans"].startswith("secret:9:49") for x in results["op1_pii"] if x["doc_id"] == 10)


def test_op2(results):
    for i, r in by_id(results["op2_toxicity"]).items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op3(results):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = by_id(results["op3_token_records"])
    for i, t in enumerate(TEXTS):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op4_and_op5(results):
    assert {r["doc_id"] for r in results["op4_decontamination"]} == {7}
    assert all(r["lossless"] for r in results["op5_sentence_pieces"])


def test_queries_equal_their_sql(results, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    for name, sql in registry.oracle_sql().items():
        got = con.execute(sql)
        columns = [x[0] for x in got.description]
        assert sorted(map(str, got.fetchall())) == sorted(str(tuple(r[c] for c in columns)) for r in results[name])
    for i, r in by_id(results["op6_quality_rules"]).items():
        want = quality_counts(TEXTS[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want and (not r["base_failed"] or not r["kept"])


def test_op7(results):
    want = removed_lines(TEXTS)
    for i, r in by_id(results["op7_line_dedup"]).items():
        lines = [x for x in (TEXTS[i] or "").split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
        assert (r["n_lines"], r["n_removed"], r["removed"]) == (len(lines), len(want.get(i, [])), ",".join(map(str, want.get(i, []))))


def test_op8(results):
    want = components(TEXTS)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in by_id(results["op8_near_duplicates"]).items()} == want


def test_op9(results):
    want = brute_repeats(TEXTS)
    got = by_id(results["op9_repeated_passages"])
    assert [(got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) for i in range(len(TEXTS))] == want


def test_op11(results):
    for i, r in by_id(results["op11_language_mixtures"]).items():
        letters = any(c.isalpha() for c in TEXTS[i] or "")
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and r["lang_pred"] == ("en" if letters else "und") and r["score"] == float(letters)


def test_op12(results, spark, folder):
    rows = [r for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect() if r.embedding and len(r.embedding) == 5 and all(v is not None and np.isfinite(v) for v in r.embedding)]
    x = np.array([[int(np.floor(1024 * v)) + 100_000 for v in r.embedding] for r in rows])
    n, total = len(x), x.sum(0)
    want = sorted((r.vec_id is not None, r.vec_id or 0, k, n, int(v)) for r, v in zip(rows, ((n * x - total) ** 2).sum(1), strict=True) for k in range(1, 6))
    got = results["op12_embedding_whitening"]
    assert n == 12 and want == sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["component"], r["n"], r["deviation"]) for r in got)
    assert max(r["identity_error"] for r in got) < 1e-9 and abs(sum({r["component"]: r["explained"] for r in got}.values()) - 1) < 1e-12


def test_op13(results):
    from test_infill import brute

    for i, r in by_id(results["op13_fill_in_middle"]).items():
        n, form, prefix, middle, output = brute(i, TEXTS[i])
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert (r["output_sha256"], r["restored_sha256"]) == (digest(output), digest(TEXTS[i] or ""))


def test_null_ids_and_repeated_rows(spark, folder, tmp_path):
    """Each of the new operators gives a row for each row, whatever its key."""
    documents, vectors = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "embeddings"))
    few = documents.filter("doc_id IN (0, 1, 2, 3, 14)")
    few.union(few.filter("doc_id < 2")).union(few.withColumn("doc_id", F.lit(None).cast("long"))).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    vectors.union(vectors).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {n: registry.queries()[n](spark, str(tmp_path)).collect() for n in ("op11_language_mixtures", "op12_embedding_whitening", "op13_fill_in_middle")}
    assert len(got["op11_language_mixtures"]) == len(got["op13_fill_in_middle"]) == 12
    assert sum(r.doc_id is None for r in got["op11_language_mixtures"]) == 5 and sum(r.doc_id == 0 for r in got["op13_fill_in_middle"]) == 2
    assert len(got["op12_embedding_whitening"]) == 2 * 12 * 5 and sum(r.vec_id is None for r in got["op12_embedding_whitening"]) == 10
    assert max(r.identity_error for r in got["op12_embedding_whitening"]) < 1e-9


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels", "embeddings"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in registry.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert entry.queries()["pipeline"](spark, str(tmp_path)).count() == 0


def test_pipeline_stages_keep_columns(spark, folder):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    twice = docs.union(docs.filter("doc_id < 3"))
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, twice, folder).columns == docs.columns
    rows = pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in rows}
    # documents that line dedup has emptied stay, as empty ones
    assert len(rows) == len(kept) and {0, 1, 5, 13} <= kept and not kept & {2, 3, 4, 7, 8, 9, 10, 11, 12, 14, 17}
