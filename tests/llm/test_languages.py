"""Language mixtures: counts against plain Python, EM against its definition, accuracy on texts of made-up languages."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from convolake.llm import languages as L

SYLLABLES = {"aa": "ka to mi re su pa".split(), "bb": "sch ung ein ber ach lich".split(), "cc": "é ouè tion eau ç ment".split()}


def prose(lang, words, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(words))


def plain_grams(text):
    folded = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode())
    folded = b" " + folded + b" "
    while b"  " in folded:
        folded = folded.replace(b"  ", b" ")
    code = lambda g: ((g[0] << 16 | g[1] << 8 | g[2]) * 0x9E3779B97F4A7C15 % 2**64) >> 48
    return Counter(code(folded[i : i + 3]) for i in range(len(folded) - 2))


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_counts(monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    texts = ["a", "ab  c, d!", "é ouè", "", "x" * 100, "ação não é", "one two three one two three", "Z-9-y"]
    text, bucket, count = L.gram_counts([t.lower() for t in texts])
    for i, t in enumerate(texts):
        here = text == i
        assert dict(zip(bucket[here].tolist(), count[here].tolist(), strict=True)) == plain_grams(t), t


def test_em_raises_likelihood_to_the_best_mixture():
    p, count = np.array([[0.7, 0.1], [0.2, 0.2], [0.1, 0.7]], np.float32), np.array([30, 10, 10])
    share, loglik = L.proportions(p, count, np.array([0]), np.ones((1, 2), bool))
    score = lambda x: sum(c * math.log(a * x + b * (1 - x)) for c, (a, b) in zip(count, p, strict=True))
    best = max(score(k / 1000) for k in range(1001))
    assert abs(loglik[0] - best) < 1e-2 and abs(score(share[0, 0]) - best) < 1e-2


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    rows = [(prose(lang, 200, rng), lang) for lang in SYLLABLES for _ in range(10)] + [(None, "aa"), ("ka to", None)]
    return L.learned(spark.createDataFrame(rows, "text string, lang string").repartition(4))


def test_learned_counts(spark):
    rows = [("ab ab", "x"), ("ab", "x"), ("éa", "y"), (None, "z")]
    m = L.learned(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert m.names == ["x", "y"]
    want = plain_grams("ab ab") + plain_grams("ab")
    p = (np.array([want.get(b, 0) for b in range(L.BUCKETS)]) + 0.5) / (sum(want.values()) + 0.5 * L.BUCKETS)
    assert np.allclose(m.likelihood[:, 0], p)


def test_sets_and_shares(spark, docs, model):
    rng = random.Random(4)
    texts = [prose(lang, 150, rng) for lang in SYLLABLES]
    texts += [prose("aa", 120, rng) + "\n" + prose("bb", 120, rng), prose("cc", 160, rng) + " " + prose("bb", 60, rng), " ".join(prose(x, 100, rng) for x in SYLLABLES)]
    texts += [None, "", "12 345 !?", "ka", prose("bb", 30_000, rng)]
    got = {r.doc_id: r for r in L.identified(docs(texts, lang_pred="clash", letters=1), model).collect()}
    sets = [{x.lang for x in got[i].languages} for i in range(len(texts))]
    assert sets[:6] == [{"aa"}, {"bb"}, {"cc"}, {"aa", "bb"}, {"bb", "cc"}, {"aa", "bb", "cc"}]
    shares = {x.lang: x.share for x in got[4].languages}
    part = len(" ".join(texts[4].split(" ")[:160]).encode()) / len(texts[4].encode())
    assert abs(shares["cc"] - part) < 0.05 and got[4].lang_pred == "cc" and abs(got[4].score - shares["cc"]) < 1e-9
    assert [(got[i].lang_pred, got[i].score, got[i].languages) for i in (6, 7, 8)] == [("und", 0.0, [])] * 3
    assert got[9].lang_pred == "aa" and sets[10] == {"bb"}


def test_a_text_is_judged_alone(spark, docs, model):
    """Blocks and neighbours change nothing."""
    rng = random.Random(5)
    texts = [prose(rng.choice(list(SYLLABLES)), rng.randrange(1, 60), rng) for _ in range(60)]
    together, _ = L.mixtures(model, texts)
    alone = np.concatenate([L.mixtures(model, [t])[0] for t in texts])
    assert np.array_equal(together > 0, alone > 0) and np.allclose(together, alone, atol=1e-5)


def test_nothing_learned(spark, docs):
    empty = L.learned(spark.createDataFrame([], "text string, lang string"))
    assert [(r.lang_pred, r.score) for r in L.identified(docs(["abc", None]), empty).collect()] == [("und", 0.0)] * 2
    single = L.learned(spark.createDataFrame([("abc", "q")], "text string, lang string"))
    assert [(r.lang_pred, r.score) for r in L.identified(docs(["abc", "zzz", "1"]), single).collect()] == [("q", 1.0), ("q", 1.0), ("und", 0.0)]
