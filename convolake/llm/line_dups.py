"""Operator 7: line deduplication by an exact set-similarity join.

A line's set holds its distinct words (A-Z lower-cased). A line goes if an earlier line (by doc_id, then place) has a
set with Jaccard similarity of at least SIMILARITY (0.8). Lines without words stay.

1. Words are counted over all texts in a table of COUNTERS hashed counters (its size is fixed, so it is broadcast). The
   counter's magnitude goes into the top byte of the word's hash, so that hashes in ascending order are words in order
   of rarity.
2. Lines with equal sets are one class (counted by partial sums); its first line stands for it.
3. Each class sends the prefix of its ordered set: sets that are similar enough share a word there. A rare word is a key
   by itself. A common word (its counter is over COMMON) is a key only together with the next word that both sets share,
   which stands in the prefix or one place behind it (in long lines, with its neighbour, over a longer prefix), so that
   no group of classes hangs on a common word alone and keys grow with the line. Groups of
   rare words have at most COMMON classes; those of word pairs are counted, and large ones dealt over tiles of pairs of
   blocks.
4. Within a group, pairs of classes pass the length filter (a window over sizes), the positional filter (what can still
   be shared behind the shared words) and a bitmap filter (sets differ in at least as many words as their 128-bit parity
   maps in bits). A line only needs one earlier similar line: of each group, a class's BEST likeliest earlier partners
   are passed on and verified on the full sets. Classes that have further partners and none of whose passed ones was
   similar are compared with all their partners in a second pass.

Filters only drop pairs that cannot qualify, and the order of words is only a matter of speed, so the result is exact (up
to 56-bit hashes of words within a line and 128-bit keys of sets). Defined results: null and empty texts have no words to
remove; rows without doc_id are not compared and keep their text; rows with the same doc_id and text are one document;
of rows with the same doc_id and different texts, lines at the same place are not compared with one another; texts whose
every line goes keep the empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import Scratch, batch_words, mix, table, written
from convolake.llm.groups import HELD, apart, arranged, by_groups, dealt, large_groups, tiled

SIMILARITY = 0.8
#: Hashed counters (more of them only improve the order of words), in chunks that are summed in a tree.
COUNTERS, CHUNKS, FAN_IN = 1 << 20, 64, 1_000
#: Occurrences above which a word is common, and classes in a block of a large group.
COMMON, TILE = 4_096, 4_096
#: Words from which a line is long: its keys of two words are pairs of neighbours, so they grow with its length only.
LONG = 40
#: Partners that a group passes on for a class in the first pass.
BEST = 2
#: Lines to verify up to which their places are broadcast to the texts; beyond, texts and places are shuffled together.
SENT = 2_000_000
#: Pairs that are worked on at a time.
PAIRS = 1 << 17
_SHIFT = np.uint64(64 - 20)
_TOP, _LOW = np.uint64(56), np.uint64((1 << 56) - 1)
_PAIR = 1 << 30


def _by_line(words: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The order by number (ascending already), then word."""
    if len(number) and number[-1] >= 1 << 16:
        return np.lexsort((words, number))
    by = np.argsort(words)
    return by[np.argsort(number[by].astype(np.uint16), kind="stable")]


def line_sets(texts: list[str | None], rarity: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each line with words, rare ones first: word, and the first entry, text, place and size of each
    line."""
    words, text, line, _, _ = batch_words(texts)
    if not len(words):
        none = np.zeros(0, np.int64)
        return words, none, none, none, none
    words = words & _LOW if rarity is None else rarity[(words >> _SHIFT).astype(np.int64)] | (words & _LOW)
    new_line = np.concatenate(([True], (text[1:] != text[:-1]) | (line[1:] != line[:-1])))
    number = np.cumsum(new_line) - 1
    by = _by_line(words, number)
    words, number = words[by], number[by]
    once = np.concatenate(([True], (words[1:] != words[:-1]) | (number[1:] != number[:-1])))
    words, number = words[once], number[once]
    first = np.flatnonzero(np.diff(number, prepend=-1))
    return words, first, text[new_line], line[new_line], np.diff(np.append(first, len(words)))


def _slices(texts: list, chars: int = 1 << 19) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


# --- rarity -------------------------------------------------------------------------------------------------------------
def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    total = np.zeros(COUNTERS, np.int64)
    for b in batches:
        texts = b["text"].tolist()
        for a, e in _slices(texts):
            total += np.bincount((batch_words(texts[a:e])[0] >> _SHIFT).astype(np.int64), minlength=COUNTERS)
    if total.any():
        yield pd.DataFrame({"chunk": range(CHUNKS), "part": TaskContext.get().partitionId(), "counts": [x.tobytes() for x in np.split(total, CHUNKS)]})


def sum_counts(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.int64) for x in group["counts"])
    return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "part": [int(group["part"].iloc[0]) // FAN_IN], "counts": [total.tobytes()]})


def word_counts(docs: DataFrame) -> np.ndarray:
    """The counters over all texts: each task's are summed in a tree, so no task takes more than FAN_IN parts."""
    schema = "chunk int, part int, counts binary"
    parts = docs.select("text").mapInPandas(count_words, schema)
    for _ in range(2):
        parts = parts.groupBy("chunk", F.floor(F.col("part") / FAN_IN).alias("up")).applyInPandas(sum_counts, schema)
    rows = {r.chunk: r.counts for r in parts.collect()}  # CHUNKS rows
    none = np.zeros(COUNTERS // CHUNKS, np.int64).tobytes()
    return np.frombuffer(b"".join(rows.get(k, none) for k in range(CHUNKS)), np.int64)


def _magnitude(counts):
    return np.minimum(255, np.round(4 * np.log2(counts + 1))).astype(np.uint64)


# --- lines and keys -----------------------------------------------------------------------------------------------------
def set_keys(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = words & _LOW
    return np.add.reduceat(mix(words + np.uint64(11)), first).view(np.int64), np.add.reduceat(mix(words ^ np.uint64(0x1234567)), first).view(np.int64)


def needed(n, similarity: float = SIMILARITY):
    """The least overlap of two sets with n words together that are similar enough (in thousandths, so it is exact)."""
    t = round(similarity * 1000)
    return -(-(t * n) // (1000 + t))


def prefix_keys(words: np.ndarray, first: np.ndarray, size: np.ndarray, similarity: float, common_from: int = COMMON, long_from: int = LONG) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """owner (line), key and place of each key of each line; n less place bounds what a line can share with another that
    has this key, besides what earlier keys find. Pairs of words have places from _PAIR on.

    Common words of short lines (up to long_from / similarity words) are keys with each later word of the prefix. Those of
    long lines (from long_from on) are keys with the next word of the line only: similar sets A and B differ in at most
    d = (1 - t) / (1 + t) * (|A| + |B|) words, so that among the first 2 * d + 2 common words of their union two that
    stand side by side are shared, unless a rare word is. Sizes that are both short and long have both kinds of keys."""
    t = round(similarity * 1000)
    long_from = max(long_from, -(-2000 // (2 * t - 1000)))  # sets this large share d + 2 words
    reach = np.where(size >= -(-t // (1000 - t)), size - (-(-(t * size) // 1000)) + 1, 0)  # smaller sets have equal partners only
    owner, place = arranged(reach)
    at = first[owner] + place
    word = words[at]
    once, often = _magnitude(np.int64(1)), _magnitude(np.int64(common_from))
    rare = (word >> _TOP) <= often
    single = rare & ((word >> _TOP) > once)  # a word that occurs once joins nothing
    common = np.flatnonzero(~rare & (size[owner] * t <= long_from * 1000 + t))
    row, step = arranged(reach[owner[common]] - place[common])
    a = common[row]
    behind = place[a] + 1 + step
    second = words[first[owner[a]] + behind]
    lives = (second >> _TOP) > once
    a, behind, second = a[lives], behind[lives], second[lives]
    long = np.flatnonzero(size >= long_from)
    line, k = arranged(size[long])
    few = np.bincount(line, (words[first[long][line] + k] >> _TOP) <= often, len(long)).astype(np.int64)  # rare words of each
    most = (size[long] * (1000 - t)) // t - few  # common words in which a line and a similar one differ, at most
    count = np.where(most >= 0, np.minimum(2 * most + 1, size[long] - few - 1), 0)
    line, k = arranged(np.maximum(count, 0))
    left = first[long][line] + few[line] + k
    pairs = [(word[a], second), (words[left], words[left + 1])]
    pairs = [mix(mix(x ^ np.uint64(0x9E3779B97F4A7C15)) + y) for x, y in pairs]
    pairs[1] = mix(pairs[1] + np.uint64(1))
    key = np.concatenate((mix(word[single]), *pairs))
    return np.concatenate((owner[single], owner[a], long[line])), key.view(np.int64), np.concatenate((place[single], behind - 1 + _PAIR, few[line] + _PAIR))


def _line_rows(rarity, similarity: float, common_from: int):
    """Each line with words: where it stands, the key of its set and, at the first line of a batch with this set, its
    size, parity map and prefix keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            for a, e in _slices(texts):
                words, first, text, line, size = line_sets(texts[a:e], rarity.value)
                if not len(words):
                    continue
                s1, s2 = set_keys(words, first)
                bits = mix(words)
                low = (bits & np.uint64(64)) == 0
                one = np.uint64(1) << (bits & np.uint64(63))
                m1 = np.bitwise_xor.reduceat(np.where(low, one, np.uint64(0)), first).view(np.int64)
                m2 = np.bitwise_xor.reduceat(np.where(low, np.uint64(0), one), first).view(np.int64)
                owner, key, place = prefix_keys(words, first, size, similarity, common_from)
                sent = np.zeros(len(first), bool)
                sent[np.unique(s1, return_index=True)[1]] = True
                kept = sent[owner]
                owner, key, place = owner[kept], key[kept], place[kept]
                by = np.argsort(owner, kind="stable")
                ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(first))))).astype(np.int32)
                where = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").take(where),
                        b.column("rid").take(where),
                        *map(pa.array, (line.astype(np.int32), s1, s2, size.astype(np.int32), m1, m2)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(key[by])),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(place[by].astype(np.int32))),
                    ],
                    ["doc_id", "rid", "line", "s1", "s2", "n", "m1", "m2", "keys", "places"],
                )

    return run


# --- pairs within groups ------------------------------------------------------------------------------------------------
def group_pairs(key, n, place, m1, m2, similarity: float, rows: pa.Table | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows i and j (of one key) that pass the filters, with the bits in which their maps differ; PAIRS at a time."""
    t = round(similarity * 1000)
    by = np.lexsort((n, key))
    key, n, rest, m1, m2 = key[by], n[by].astype(np.int64), (n - place)[by], m1[by].view(np.uint64), m2[by].view(np.uint64)
    group = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1
    own = apart(rows, group, by) if rows is not None else lambda i, j: np.ones(len(i), bool)
    span = np.int64(n.max() + 1)
    code = group * span + n
    last = np.searchsorted(code, group * span + np.minimum(1000 * n // t, span - 1), side="right")
    partners = last - np.arange(len(key)) - 1
    least = needed(np.arange(2 * span, dtype=np.int64), similarity)
    edges = np.searchsorted(np.cumsum(partners), np.arange(PAIRS, partners.sum() + PAIRS, PAIRS))
    a = 0
    for e in np.unique(np.minimum(edges + 1, len(key))):
        i, step = arranged(partners[a:e])
        i += a
        j = i + 1 + step
        need = least[n[i] + n[j]]
        ok = np.flatnonzero((rest[i] >= need) & (rest[j] >= need))
        ok = ok[own(i[ok], j[ok])]
        i, j, need = i[ok], j[ok], need[ok]
        differ = np.bitwise_count(m1[i] ^ m1[j]).astype(np.int64) + np.bitwise_count(m2[i] ^ m2[j])
        ok = differ <= n[i] + n[j] - 2 * need
        yield by[i[ok]], by[j[ok]], differ[ok]
        a = e


def _likeliest(pairs: list[tuple], order: np.ndarray, n: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (early, late, differ, more), the best for each later row; more: whether that row had others, now or before."""
    early, late, differ, more = (np.concatenate(x) for x in zip(*pairs, strict=True))
    if not len(early):
        return early, late, differ, more
    by = np.lexsort((order[early], differ * 1000 // (n[early] + n[late]), late))
    early, late, differ, more = early[by], late[by], differ[by], more[by]
    start = np.flatnonzero(np.diff(late, prepend=-1))
    count = np.diff(np.append(start, len(late)))
    more = np.repeat(np.logical_or.reduceat(more, start) | (count > best), count)
    kept = np.arange(len(late)) - np.repeat(start, count) < best
    return early[kept], late[kept], differ[kept], more[kept]


def _pair_rows(rows: pa.Table, order: np.ndarray, early: np.ndarray, late: np.ndarray, more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The lines of pairs of rows, each pair of lines once."""
    if not len(early):
        return
    by = np.lexsort((~more, order[early], order[late]))
    once = np.concatenate(([True], np.diff(order[late][by]) != 0)) | np.concatenate(([True], np.diff(order[early][by]) != 0))
    early, late, more = (x[by][once] for x in (early, late, more))
    flat = lambda x: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
    pick = lambda c, at: flat(rows.column(c).take(pa.array(at)).combine_chunks())
    yield pa.RecordBatch.from_arrays([*(pick(c, at) for at in (early, late) for c in ("doc_id", "line")), pa.array(more)], ["a_doc", "a_line", "b_doc", "b_line", "more"])


def _partners(rows: pa.Table, similarity: float, best: int | None, most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Pairs of an earlier and a later class of complete groups. About most pairs are held at a time, besides the best
    for each row."""
    col = lambda c: rows.column(c).to_numpy()
    key, n, place, line = col("key"), col("n").astype(np.int64), col("place") % _PAIR, col("line")
    doc = np.unique(col("doc_id"), return_inverse=True)[1]
    order = doc.astype(np.int64) << 32 | line
    same = key[1:] == key[:-1]
    keep = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    if not len(keep):
        return
    asked = rows.column("asked").to_numpy(zero_copy_only=False) if best is None else None
    held, size = [], 0
    for i, j, differ in group_pairs(key[keep], n[keep], place[keep], col("m1")[keep], col("m2")[keep], similarity, rows.take(pa.array(keep)) if "block" in rows.schema.names else None):
        i, j = keep[i], keep[j]
        ahead = order[i] < order[j]
        early, late = np.where(ahead, i, j), np.where(ahead, j, i)
        ok = order[i] != order[j]
        if best is None:
            ok &= asked[late]
        held.append((early[ok], late[ok], differ[ok], np.zeros(int(ok.sum()), bool)))
        size += len(held[-1][0])
        if size >= most:
            if best is None:
                early, late, _, more = (np.concatenate(x) for x in zip(*held, strict=True))
                yield from _pair_rows(rows, order, early, late, more)
            held, size = [] if best is None else [_likeliest(held, order, n, best)], 0
    if held:
        early, late, _, more = (np.concatenate(x) for x in zip(*held, strict=True)) if best is None else _likeliest(held, order, n, best)
        yield from _pair_rows(rows, order, early, late, more)


def _candidates(entries: DataFrame, kind: str, similarity: float, best: int | None) -> DataFrame:
    """a and b (document and line) of pairs to verify, each once, and whether b has more partners."""
    rows = entries.repartition("key").sortWithinPartitions("key").mapInArrow(by_groups(lambda x: _partners(x, similarity, best), "key"), f"a_doc {kind}, a_line int, b_doc {kind}, b_line int, more boolean")
    return rows.groupBy("a_doc", "a_line", "b_doc", "b_line").agg(F.bool_or("more").alias("more"))


# --- verification -------------------------------------------------------------------------------------------------------
def _set_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The full sets of the lines asked for."""
    for b in batches:
        docs, places, lines = [], [], []
        for doc, text, asked in zip(b["doc_id"], b["text"], b["asked"], strict=True):
            of = (text or "").split("\n")
            there = [k for k in asked if k < len(of)]
            docs += [doc] * len(there)
            places += there
            lines += [of[k] for k in there]
        for a, e in _slices(lines):
            words, first, text, _, size = line_sets(lines[a:e])
            s1, s2 = set_keys(words, first)
            at = text + a
            yield pd.DataFrame({"doc": [docs[k] for k in at], "line": [places[k] for k in at], "s1": s1, "s2": s2, "words": [words[k : k + m].tobytes() for k, m in zip(first, size, strict=True)]})


def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a, b, strict=True)], dtype="int64")


def _verified(d: DataFrame, pairs: DataFrame, similarity: float, sent: int, s: Scratch) -> DataFrame:
    """doc, line, s1 and s2 of each later class of pairs, whether one of its partners is similar, and whether it has
    more."""
    kind, t = dict(d.dtypes)["doc_id"], round(similarity * 1000)
    lines = pairs.select(F.col("a_doc").alias("doc_id"), F.col("a_line").alias("line")).unionByName(pairs.select(F.col("b_doc").alias("doc_id"), F.col("b_line").alias("line")))
    at = s.written(lines.groupBy("doc_id").agg(F.collect_set("line").alias("asked")), "line-places")
    few = (at.agg(F.sum(F.size("asked"))).first()[0] or 0) <= sent
    sets = d.join(F.broadcast(at) if few else at, "doc_id").select("doc_id", "text", "asked").mapInPandas(_set_rows, f"doc {kind}, line int, s1 long, s2 long, words binary")
    sets = s.written(sets.repartition("doc", "line").dropDuplicates(["doc", "line", "s1", "s2"]), "line-sets")
    a = sets.select(F.col("doc").alias("a_doc"), F.col("line").alias("a_line"), F.col("words").alias("a_words"))
    b = sets.select(F.col("doc").alias("b_doc"), F.col("line").alias("b_line"), "s1", "s2", F.col("words").alias("b_words"))
    n = (F.length("a_words") + F.length("b_words")) / 8
    both = pairs.join(a, ["a_doc", "a_line"]).join(b, ["b_doc", "b_line"]).select("b_doc", "b_line", "s1", "s2", "more", n.cast("long").alias("n"), F.pandas_udf(_overlap, "long")("a_words", "b_words").alias("both"))
    similar = 1000 * F.col("both") >= t * (F.col("n") - F.col("both"))
    return s.written(both.groupBy("b_doc", "b_line", "s1", "s2").agg(F.bool_or(similar).alias("goes"), F.bool_or("more").alias("more")), "line-verified")


def _entries(classes: DataFrame, *more: str) -> DataFrame:
    """A row for each key of each class."""
    p = F.explode(F.arrays_zip("prefix.keys", "prefix.places")).alias("p")
    return classes.filter("prefix IS NOT NULL").select("first.doc_id", "first.line", "n", "m1", "m2", *more, p).select(F.col("p.keys").alias("key"), "doc_id", "line", "n", F.col("p.places").alias("place"), "m1", "m2", *more)


def duplicate_lines(docs: DataFrame, similarity: float = SIMILARITY, common: int = COMMON, tile: int = TILE, best: int = BEST, sent: int = SENT) -> DataFrame:
    """doc_id, rid (hash of the text) and removed (places of the lines to remove, in order) of each document that loses
    lines. similarity must be over 0.5: keys of two words need two words in common. The other numbers do not change the
    result."""
    if not 0.5 < similarity < 1:
        raise ValueError("similarity must lie between 0.5 and 1")
    spark, kind, s = docs.sparkSession, dict(docs.dtypes)["doc_id"], Scratch(docs.sparkSession)
    d = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("rid"))
    rarity = spark.sparkContext.broadcast(_magnitude(word_counts(d)) << _TOP)
    rows = f"doc_id {kind}, rid long, line int, s1 long, s2 long, n int, m1 long, m2 long, keys array<long>, places array<int>"
    wide = Scratch(spark)
    keyed = wide.written(d.mapInArrow(_line_rows(rarity, similarity, common), rows), "keyed-lines")
    lines = s.written(keyed.select("doc_id", "rid", "line", "s1", "s2"), "lines")
    prefix = F.when(F.size("keys") > 0, F.struct("keys", "places"))
    classes = s.written(keyed.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "rid", "line")).alias("first"), F.count("*").alias("copies"), *[F.max(c).alias(c) for c in ("n", "m1", "m2")], F.first(prefix, ignorenulls=True).alias("prefix")), "line-classes")
    wide.clear()
    large = large_groups(_entries(classes).filter(F.col("place") >= _PAIR), "key", tile, s)
    entries = dealt(_entries(classes), "key", ["doc_id", "line"], tile, large)
    found = _verified(d, s.written(_candidates(entries, kind, similarity, best), "line-pairs", narrow=True), similarity, sent, s)
    later = found.filter("goes")
    open_ = s.written(found.filter("more AND NOT goes").select(F.col("b_doc").alias("doc_id"), F.col("b_line").alias("line"), F.lit(True).alias("asked")).distinct(), "line-open")
    if not open_.isEmpty():
        # classes are marked before they become an entry for each key
        placed = classes.withColumns({"doc_id": F.col("first.doc_id"), "line": F.col("first.line")})
        keys = dealt(_entries(placed.join(open_, ["doc_id", "line"])), "key", ["doc_id", "line"], tile, large)
        keys = s.written(keys.select("key").distinct(), "line-open-keys")
        marked = placed.join(open_, ["doc_id", "line"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
        marked = dealt(_entries(marked, "asked"), "key", ["doc_id", "line"], tile, large)
        rest = tiled(s.written(marked.join(keys, "key", "left_semi"), "line-open-entries"), "key", ["doc_id", "line"], tile // 4 + 1, s)
        rest = s.written(_candidates(rest, kind, similarity, None), "line-open-pairs", narrow=True)
        later = later.unionByName(_verified(d, rest, similarity, sent, s).filter("goes"))
    goes = later.select("s1", "s2", F.col("b_doc").alias("__doc"), F.col("b_line").alias("__line")).distinct().withColumn("goes", F.lit(True))
    marked = classes.select("s1", "s2", "first", "copies", F.col("first.doc_id").alias("__doc"), F.col("first.line").alias("__line")).join(goes, ["s1", "s2", "__doc", "__line"], "left")
    marked = marked.filter("goes OR copies > 1").select("s1", "s2", "first", F.coalesce("goes", F.lit(False)).alias("goes"))
    gone = lines.join(marked, ["s1", "s2"]).filter(F.col("goes") | (F.struct("doc_id", "rid", "line") != F.col("first")))
    out = written(gone.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_set("line")).alias("removed")), "removed-lines")
    s.clear()
    rarity.destroy()
    return out


def _removed(docs: DataFrame, similarity: float, sent: int = SENT) -> DataFrame:
    """The lines to remove, broadcast to the texts if there are so many at most."""
    gone = duplicate_lines(docs, similarity)
    few = (gone.agg(F.sum(F.size("removed"))).first()[0] or 0) <= sent
    return (F.broadcast(gone) if few else gone).withColumnsRenamed({"doc_id": "__doc", "rid": "__rid"})


def without_duplicate_lines(docs: DataFrame, similarity: float = SIMILARITY, sent: int = SENT) -> DataFrame:
    """docs with the text of each document less its removed lines; all columns stay (n_chars, if there, is recounted)."""
    columns = docs.columns
    d = docs.select(*[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(columns)], F.col("text").alias("__text"), F.col("doc_id").alias("__id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__own"))
    d = d.join(_removed(docs, similarity, sent), (F.col("__id") == F.col("__doc")) & (F.col("__own") == F.col("__rid")), "left")
    changed = F.col("removed").isNotNull()
    kept = F.array_join(F.filter(F.split("__text", "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")

    def column(i: int, c: str):
        if c == "text":
            return F.when(changed, kept).otherwise(F.col("__text"))
        if c == "n_chars":
            return F.when(changed, F.length(kept).cast(dict(docs.dtypes)[c])).otherwise(F.col(f"__in_{i}"))
        return F.col(f"__in_{i}")

    return d.select(*[column(i, c).alias(c) for i, c in enumerate(columns)])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines (with words), n_removed and the places of the removed lines, of each document."""
    docs = table(spark, sf_dir, "documents")
    d = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__own"), F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long").alias("n_lines"))
    d = d.join(_removed(docs, SIMILARITY), (F.col("doc_id") == F.col("__doc")) & (F.col("__own") == F.col("__rid")), "left")
    return d.select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"))
