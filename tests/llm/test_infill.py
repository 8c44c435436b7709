"""Fill-in-the-middle against a plain rendering of the rule."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from convolake.llm import infill


def brute(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in infill.SENTINELS.values()) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


PIECES = ["a", "é", "😀", "<", ">", "P", "<P", "S>", "<S>", "<P>", "\n", "\n", "\r", "\x00", " ", "word ", "x\n"]


@pytest.mark.parametrize("block", [1, 64, infill.BLOCK])
def test_texts_of_all_kinds(spark, docs, monkeypatch, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    rng = random.Random(block)
    weight = [6, 3, 2, 2, 2, 1, 1, 1, 0.05, 0.05, 3, 3, 1, 1, 1, 6, 4]
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "<M>", "x<P", "S>\n<", *["".join(rng.choices(PIECES, weight, k=rng.randrange(40))) for _ in range(300)], "line\n" * 30_000]
    for rate, spm in ((100, 50), (60, 0)):
        got = {r.doc_id: r for r in infill.restored(infill.infilled(docs(texts, output="clash"), rate=rate, spm_rate=spm)).collect()}
        for i, t in enumerate(texts):
            r = got[i]
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(i, t, rate, spm), i
            assert r.restored == (t or "")
    assert {r.form for r in got.values()} == {"plain", "psm"}


def test_restoring_needs_sentinels(spark):
    d = spark.createDataFrame([("psm", "<P>a<M>b")], "form string, output string")
    with pytest.raises(Exception, match="sentinel"):
        infill.restored(d).collect()
    d = spark.createDataFrame([("spm", "<P>a<S>b<M>c")], "form string, output string")
    with pytest.raises(Exception, match="do not fit"):
        infill.restored(d).collect()
    d = spark.createDataFrame([("plain", None), ("plain", "<P>"), ("psm", "<P><S><M>"), ("spm", "<S>c<P>a\n<M>é")], "form string, output string")
    assert [r.restored for r in d.transform(infill.restored).collect()] == ["", "<P>", "", "a\néc"]


def test_places():
    at = infill.places(np.array([0, 2, 2, 5]), np.array([3, 9, 0, 7]), 6)
    assert at.tolist() == [3, 4, 0, 1, 2, 7]


def test_other_columns_and_id_types(spark):
    d = spark.createDataFrame([("k1", "a\nb\nc", 5)], "doc_id string, text string, n int")
    r = infill.restored(infill.infilled(d)).withColumn("again", F.col("restored") == F.lit("a\nb\nc")).first()
    assert r.doc_id == "k1" and r.n == 3 and r.again and r.output == brute("k1", "a\nb\nc")[4]
