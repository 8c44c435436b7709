"""Operators 2, 3, 4 and 5 against plain Python and the libraries."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from convolake.llm import decontaminate as D
from convolake.llm import pieces as P
from convolake.llm import records as R
from convolake.llm import toxicity as X
from convolake.llm.common import shared_dir

rng = random.Random(7)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_automaton_finds_misspelled_words():
    terms = ["idiot", "moron", "trash", "pathetic"]
    trie = X.Trie(terms)
    for _ in range(300):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice("abcxyz")
        w = "".join(w)
        d = min(distance(w, t) for t in terms)
        assert trie.near(w, 1) == (d if d <= 1 else None)
    lex = X.Lexicon(("idiot",), ("lowei",))
    assert [lex.kind(w) for w in ("idiot", "idiott", "1diot"[1:], "loweis", "lower", "iidot")] == ["w", "f", "f", "s", "", ""]


def test_digits_and_signs_are_letters_of_misspelled_words():
    terms = ("idiot", "moron", "trash", "stupid", "scum")
    lex = X.Lexicon(terms, ())
    fuzzy = lambda t: round(np.expm1(lex.features(t)[2]))
    for w in ("1diot", "m0ron", "tr@sh", "st*pid", "$cum", "scu*", "sc-um", "scvm", "id1ot"):
        assert lex.features(f"you ({w}), and more")[:2] == [0, 0] and fuzzy(f"you ({w}), and more") == 1
    assert lex.features("trash-talk 7moron7 scum's")[0] == np.log1p(3) and fuzzy("trash-talk 7moron7 scum's") == 0
    assert lex.features("a m0ron b-c 12.5 d_e")[6] == np.log1p(6) and fuzzy("12:30 don't b-c www.x.org m0r0n 2024") == 0
    for _ in range(2000):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(1, 2)):
            w[rng.randrange(len(w))] = rng.choice("a01@$*xu")
        w = "".join(w)
        pieces = [x for x in X._WORD.findall(w) if len(x) >= 4]
        near = any(distance(x, t) == 1 for x in [*pieces, w] for t in terms)
        exact = w in terms or any(x in terms for x in pieces)
        assert exact or (fuzzy(w) > 0) == near, w


def test_quoted_terms_score_lower_than_abuse():
    m = X.ToxicityModel(("idiot", "moron"), (), np.array([1.0, 1.0, 0.8, 0.5, 1.0, 0.0, 0.0, -2.0]))
    pad = " and so on with many more words of plain prose"
    for abuse, cited in (("you idiot" + pad, 'the "idiot" entry' + pad), ("what an idi0t you are" + pad, "they wrote “what an idi0t” you know" + pad), ("go away moron" + pad, "the word moron" + pad)):
        a, c = m.scores([abuse, cited])
        assert c < a - 0.2, (abuse, a, c)
    one, far = m.scores(['a " b idiot' + pad, '" ' + "x " * 300 + "idiot" + " x" * 300 + ' "'])
    assert abs(one - m.scores(["a b idiot" + pad])[0]) < 1e-9 and abs(one - far) < 1e-9  # no closing mark near by: not a quotation


def test_toxicity_held_out_accuracy(spark, docs):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    texts, bad = [], []
    for i in range(800):
        t = [rng.choice(words) for _ in range(60)]
        bad.append(i % 4 == 0)
        if bad[-1]:
            t[rng.randrange(60)] = rng.choice(["grumblor", "snorkelt"])
        texts.append(" ".join(t))
    d = docs([*texts, None, ""], score=1, held_out="x")
    labels = spark.createDataFrame([(i, int(b)) for i, b in enumerate(bad)] + [(5, None), (0, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in X.toxicity(d, X.fit_toxicity(d, labels)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert all(got[i].predicted == int(b) for i, b in enumerate(bad)) and got[800].score == got[801].score < 0.5
    flat = X.fit_toxicity(d, labels.limit(0))
    assert {r.predicted for r in X.toxicity(d, flat).collect()} in ({0}, {1})


TEXTS = ["a\x1cb İstanbul ΑΣ. क़. don't's <|endoftext|>x\x85\xa0　 5%6 é.̈", "", None, "x!!", " hi yo é.", "Don't DON'T it's word, Word... " * 50, "a" * 5000, "12,5 éà œuvre naïve ŉ İ"]


def test_word_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    plain, fast = Tokenizer.from_file(R.tokenizer_path()), R.WordEncoder(R.tokenizer_path())
    for t in TEXTS + TEXTS:
        assert np.frombuffer(fast.encode([t])[0], np.uint16).tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_records_round_trip(spark, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(R.tokenizer_path())
    texts = [rng.choice(TEXTS) for _ in range(60)]
    folder = f"{shared_dir(spark)}/records-test-{rng.random()}"
    index = R.write_records(docs(texts, shard="x").repartition(3), folder)
    got = {r.doc_id: r for r in R.read_records(spark, folder, index).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, R.END_ID]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    empty = f"{folder}-empty"
    assert R.read_records(spark, empty, R.write_records(docs([]), empty)).count() == 0


def test_records_are_read_in_shuffled_order(spark, docs):
    texts = [f"text {i} " + "w" * (i % 7) for i in range(50)] + [None]
    d = docs(texts + texts[:3]).withColumn("doc_id", F.when(F.col("doc_id") < 51, F.col("doc_id")))
    folder = f"{shared_dir(spark)}/records-test-{rng.random()}"
    index = R.write_records(d.repartition(3), folder)
    whole = sorted((r.n_tokens, r.ids_crc32) for r in R.read_records(spark, folder, index).collect())
    one, same, other = ([(r.doc_id, tuple(r.ids)) for r in R.read_shuffled(folder, index, seed).collect()] for seed in (1, 1, 2))
    assert one == same != other and sorted(one, key=str) == sorted(other, key=str)
    assert [x for x, _ in one if x is not None] != sorted(x for x, _ in one if x is not None)
    assert sorted((len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for _, i in one) == whole and len(one) == 54


def test_damaged_records_are_noticed():
    data = R.frame(b"hello") + R.frame(b"")
    assert [(at, bytes(p)) for at, p in R.frames(data)] == [(0, b"hello"), (21, b"")]
    for k in range(len(data)):
        with pytest.raises(ValueError):
            list(R.frames(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :]))


def test_pieces_are_the_librarys_without_dropout():
    import sentencepiece

    sp, c = sentencepiece.SentencePieceProcessor(model_file=P.model_path()), P.PieceCoder(P.model_path(), 0.0)
    texts = ["  a  b\nc\td 中 \n\n x   ", " ", "", "\n", " \n ", "😀 é x", "a" * 2000, " " * 50 + "b", "The quick brown fox; jumped"]
    for t in texts:
        assert np.frombuffer(c.encode([t], [0])[0], np.uint16).tolist() == sp.encode(t)


def agenda(c, unit, variant):
    """One unit by a plain agenda with the same keyed hash."""
    sym = [(k, c.char.get(x, -1)) for k, x in enumerate(unit)]
    key = P.mix(np.array([zlib.crc32(unit.encode()) | (zlib.adler32(unit.encode()) << 32)], np.uint64)) ^ c.seed ^ np.uint64(variant << 7)
    key = P.mix(np.array([zlib.crc32(unit.encode()) | (zlib.adler32(unit.encode()) << 32)], np.uint64) ^ c.seed ^ np.uint64(variant << 7))[0]
    table = {int(p): (int(r), int(m)) for p, r, m in zip(c.pair[:-1], c.rank[:-1], c.merged[:-1], strict=True)}
    while True:
        best = None
        for i in range(len(sym) - 1):
            (a, x), (b, y) = sym[i], sym[i + 1]
            end = sym[i + 2][0] if i + 2 < len(sym) else len(unit)
            got = table.get(x * c.size + y) if x >= 0 and y >= 0 else None
            spot = np.array([(a << 42) | (b << 21) | end], np.uint64)
            if got and P.mix(key ^ P.mix(spot + np.uint64(1)))[0] >= c.limit and (best is None or (got[0], a) < best[:2]):
                best = (got[0], a, i, got[1])
        if best is None:
            return [s for _, s in sym]
        i = best[2]
        sym[i : i + 2] = [(sym[i][0], best[3])]


def test_dropout_is_the_agendas_and_lossless():
    c = P.PieceCoder(P.model_path(), 0.3)
    units = [" thing", " international", " naïveté", "   spaced", " aaaaaa", " connection"]
    for v in range(P.VARIANTS):
        for u in units:
            assert np.frombuffer(c._merge([u], v)[0], np.uint16).tolist() == agenda(c, u, v)
    cuts = {c.encode(["international connection"], [v])[0] for v in range(P.VARIANTS)}
    assert len(cuts) > 1
    for t in ["  a ▁b\nc 😀", "", "\n\n", "x" * 3000, " é▁▁ "]:
        assert c.decode(np.frombuffer(c.encode([t], [1])[0], np.uint16)) == t


def test_dropout_varies_with_document_and_occurrence(spark, docs):
    c = P.PieceCoder(P.model_path(), 0.3)
    text = " ".join(["international connection naïveté"] * 40)
    for v in (0, 3, 2**64 - 5, -5):
        units = P._UNIT.findall(" " + text)
        keys = [int(P.mix(np.array([v & (2**64 - 1)], np.uint64) ^ P.mix(np.array([k + 1], np.uint64)))[0]) for k in range(len(units))]
        want = [i for u, k in zip(units, keys, strict=True) for i in np.frombuffer(c._merge([u], np.array([k], np.uint64))[0], np.uint16)]
        assert np.frombuffer(c.encode([text], [v])[0], np.uint16).tolist() == want
    one = [np.frombuffer(x, np.uint16) for x in c.encode([text, text], [1, 2])]
    assert one[0].tolist() != one[1].tolist() and all(c.decode(x) == text for x in one)
    got = P.piece_digests(docs(["international connection understanding"] * 60), rate=0.3).collect()
    assert len({r.variant for r in got}) == 60 and len({r.ids_crc32 for r in got}) > 4 and all(r.lossless for r in got)


def test_piece_digests(spark, docs):
    got = P.piece_digests(docs([*TEXTS, "plain words"], variant="clash", pieces=1)).collect()
    assert all(r.lossless for r in got) and {r.n_pieces for r in got if r.doc_id in (1, 2)} == {0}
    assert P.encoded(docs(["ab cd", None])).orderBy("doc_id").first().decoded == "ab cd"
    assert P.piece_digests(docs([])).count() == 0


def least_edits(item, text):
    col = np.arange(len(item) + 1)
    best = int(col[-1])
    for c in text:
        x = np.concatenate(([0], np.minimum(col[:-1] + (item != c), col[1:] + 1)))
        d = np.arange(len(x))
        col = np.minimum.accumulate(x - d) + d
        best = min(best, int(col[-1]))
    return best


def test_decontamination_finds_all_within_the_budget(spark, docs):
    letters = "abcdefgh "
    items = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(60, 150)))) for k in range(8)] + [(8, "short"), (9, None), (None, "x" * 90), (10, "")]
    index = D.Index(tuple((i, t) for i, t in items if i is not None and t))
    texts = [None, "", "zz" * 20000]
    for _ in range(60):
        s = list(rng.choice(items[:8])[1])
        for _ in range(rng.randint(0, len(s) // 7)):
            p, a = rng.randrange(len(s)), rng.random()
            s[p : p + (a > 0.3)] = [] if a > 0.6 else [rng.choice("XYZé")]
        texts.append("".join(rng.choice(letters) for _ in range(80)) + "".join(s).upper() + "  \n" + "".join(rng.choice(letters) for _ in range(80)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {}
    for r in D.contamination(docs(texts, start=1, edits="x"), bench).collect():
        found.setdefault((r.doc_id, r.item_id), []).append(r.edits)
    n = 0
    for i, t in enumerate(texts):
        c = D.codes(t or "")[0]
        for k, item in enumerate(index.ids):
            e = least_edits(index.codes[k], c)
            assert (e <= index.edits[k]) == ((i, item) in found)
            n += e <= index.edits[k]
            assert e > index.edits[k] or min(found[i, item]) == e
    assert n > 20
    clean = {r.doc_id for r in D.decontaminated(docs(texts), bench, block=300).collect()}
    assert clean == set(range(len(texts))) - {i for i, _ in found}
    assert D.contamination(docs(texts), bench.limit(0)).count() == 0


def test_short_items_are_found_word_for_word(spark, docs):
    import re

    items = [(0, "Who wrote it?"), (1, "the seven hills"), (2, "aa aa aa aa"), (3, "tiny"), (4, "the seven hills of Rome and the river"), (5, "谁写了这本关于河的书"), (6, "exactly8")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["So: who  WROTE\nit? The seven hills.", "the seven hillside", "bathe seven hills", "xthe seven hills, the seven hills", "aa " * 9, "tiny", "the seven hells", "The seven hills of Rome and the river", "他问谁写了这本关于河的书吗", "exactly8", "exactly80", None, ""]
    for _ in range(200):
        texts.append("".join(rng.choice(["the ", "seven ", "hills", " ", "aa ", "aa", ".", "who wrote it", "?"]) for _ in range(30)))
    want = set()
    for i, t in enumerate(texts):
        flat = re.sub(r"[ \t\n\r\f\v]+", " ", (t or "").lower())
        for k, item in items:
            edge = (r"\b" if item[0].isalnum() and ord(item[0]) < 0x2E80 else "", r"\b" if item[-1].isalnum() and ord(item[-1]) < 0x2E80 else "")
            if len(item) >= 8 and re.search(edge[0] + re.escape(item.lower()) + edge[1], flat):
                want.add((i, k))
    rows = D.contamination(docs(texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and {(0, 0), (0, 1), (3, 1), (7, 4), (8, 5), (9, 6)} <= want and all(r.edits == 0 for r in rows)
    assert [(r.start, r.stop) for r in rows if (r.doc_id, r.item_id) in ((0, 0), (3, 1))] == [(4, 18), (18, 33)]
    assert {r.doc_id for r in D.decontaminated(docs(texts), bench).collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert len(D.Index(((1, "the seven hills"),)).search("the seven hills " * 20_000)) == 20_000


def test_ways_with_one_skip_are_merged_once():
    """Occurrences that skip one candidate share the pieces of that way, and all have the pieces they have by themselves."""
    c = P.PieceCoder(P.model_path())
    texts = ["the water of small towns is not always clean é " * 400] * 4
    c.encode(texts, [1, 2, 3, 4])
    merged, plain = [], c._merge

    def counted(units, *args, key=None, **more):
        merged.extend(units if key is not None else [])
        return plain(units, *args, key=key, **more)

    c._merge = counted
    got = c.encode(texts, [5, 6, 7, 8])
    assert 0 < len(merged) < 0.25 * 4 * 400 * 10
    c._merge, c._skipped = plain, lambda ids, keys: (np.repeat(np.arange(len(ids)), 2), np.zeros(2 * len(ids), np.int64))  # each by itself
    assert c.encode(texts, [5, 6, 7, 8]) == got


def test_words_met_once_are_not_kept_and_memory_is_bounded():
    """Cached, partly cached and uncached runs agree; what a worker holds does not grow with words that never come again."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghijklmnopéß中") for _ in range(draw.randint(3, 12)))
    c = P.PieceCoder(P.model_path())
    rare = [" ".join(word() for _ in range(400)) for _ in range(20)]
    tracemalloc.start()
    try:
        got = c.encode(rare, list(range(20)))
        common = c.encode(["the water of small towns " * 20_000], [3])
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(c.number) < 1_000 and held < 30e6 and peak < 80e6, (len(c.number), held, peak)
    assert c.encode(rare, list(range(20))) == got == c.encode(rare, list(range(20))) and len(c.number) > 5_000
    assert c.encode(["the water of small towns " * 20_000], [3]) == common
    assert [c.decode(np.frombuffer(x, c.kind)) for x in got] == rare
    ids, ends = c.encoded([*rare, None, ""], list(range(22)))
    assert c.lossless([*rare, None, ""], ids, ends) == [True] * 22 and c.lossless([*rare[1:], rare[0], None, ""], ids, ends) == [False] * 20 + [True] * 2
