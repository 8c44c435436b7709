"""Operator 4: benchmark decontamination by q-gram lemma filtering.

An item is found in a text if some stretch of the text is within EDITS times the item's length (rounded down) of it, in
edit distance over code points, after lower-casing A-Z and taking runs of white space as one blank. By the q-gram lemma
such a stretch shares at least m - q + 1 - q * e q-grams with the item, on diagonals (place in the text less place in the
item) that lie within e of each other. So shared q-grams are counted in bands of 2 (e + 1) diagonals that overlap by half;
bands that reach the bound are verified by an alignment inside the band.

The benchmark is the stated query set: it is taken in blocks of bounded size (BLOCK characters, about), each matched
against all texts in one pass without a shuffle, so one block's index is all that is ever broadcast.

Items of fewer than MIN_CHARS characters get no edits: they are found word for word, where no letter or digit goes on
beyond them (scripts without blanks aside).

Defined results: null and empty texts or items match nothing; items of fewer than Q characters have no q-gram and are
left out; items with the same text are each reported; repeated rows are each scanned; item_ids that
are null are left out. decontaminated() keeps documents without doc_id if they are clean, as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import mix, table

Q = 8
EDITS = 0.1
MIN_CHARS = 40
BLOCK = 2_000_000
HITS = "item_id long, start long, stop long, edits int"


def codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a normalised text, and the place of each in the text."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[(c >= 65) & (c <= 90)] += 32
    blank = (c == 32) | ((c >= 9) & (c <= 13))
    c[blank] = 32
    keep = np.ones(len(c), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    at = np.flatnonzero(keep)
    c = c[at]
    if len(c) and c[0] == 32:
        c, at = c[1:], at[1:]
    if len(c) and c[-1] == 32:
        c, at = c[:-1], at[:-1]
    return c, at


def grams(c: np.ndarray, q: int = Q) -> np.ndarray:
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, c = np.zeros(n, np.uint64), c.astype(np.uint64)
    for k in range(q):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += c[k : k + n]
    return mix(out)


class Index:
    """q-grams of one block of items."""

    def __init__(self, items: tuple[tuple[int, str], ...], edits: float = EDITS):
        found = [(i, codes(t)[0]) for i, t in items]
        found = [(i, c) for i, c in found if len(c) >= Q]
        self.ids = np.array([i for i, _ in found], np.int64)
        self.codes = [c for _, c in found]
        m = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.minimum((m * edits).astype(np.int64), (m - Q) // Q)  # the bound stays at 1 or more
        self.short = m < MIN_CHARS
        self.edits[self.short] = 0
        self.least = m - Q + 1 - Q * self.edits
        gram = [grams(c) for c in self.codes]
        size = [len(g) for g in gram]
        g = np.concatenate(gram) if gram else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(gram)), size)
        place = np.concatenate([np.arange(n) for n in size]) if gram else np.zeros(0, np.int64)
        by = np.argsort(g, kind="stable")
        self.gram, self.item, self.place = g[by], item[by], place[by]
        # different q-grams, sorted; a bucket of their leading bits says where to look
        self.different, self.first = np.unique(self.gram, return_index=True)
        self.number = np.diff(np.append(self.first, len(self.gram)))
        bits = max(16, int(len(self.different) * 16).bit_length())
        self.shift = np.uint64(64 - bits)
        bucket = (self.different >> self.shift).astype(np.int64)
        inside = np.bincount(bucket, minlength=1 << bits)
        self.inside, self.bucket = inside.astype(np.uint8 if len(bucket) < 256 or inside.max() < 256 else np.int64), (np.cumsum(inside) - inside).astype(np.int32)

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, start, stop, edits) of each item found, places in code points of the text."""
        if not text or not len(self.ids):
            return []
        c, at = codes(text)
        g = grams(c)
        bucket = g >> self.shift
        spot = np.flatnonzero(self.inside[bucket])
        place, left = self.bucket[bucket[spot]], self.inside[bucket[spot]].astype(np.int64)
        spots, places = [], []
        while len(spot):
            same = self.different[place] == g[spot]
            spots.append(spot[same])
            places.append(place[same])
            go = ~same & (left > 1)
            spot, place, left = spot[go], place[go] + 1, left[go] - 1
        if not spots:
            return []
        spot, which = np.concatenate(spots), np.concatenate(places)
        n = self.number[which]
        total = int(n.sum())
        if not total:
            return []
        lo = self.first[which]
        entry = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        item, spot = self.item[entry], np.repeat(spot, n)
        enough = (np.bincount(item, minlength=len(self.ids)) >= self.least)[item]  # no band has more than the whole text
        item = item[enough]
        if not len(item):
            return []
        diagonal, place = spot[enough] - self.place[entry[enough]], self.place[entry[enough]]
        short = self.short[item]
        verbatim = self._verbatim(item[short], diagonal[short], c, at) if short.any() else []
        item, diagonal, place = item[~short], diagonal[~short], place[~short]
        if not len(item):
            return verbatim
        band = diagonal // (self.edits[item] + 1)
        code = item * np.int64(1 << 40) + band + (1 << 30)
        code, place = np.concatenate([code, code - 1]), np.concatenate([place, place])
        by = np.lexsort((place, code))
        code, place = code[by], place[by]
        once = np.concatenate(([True], (code[1:] != code[:-1]) | (place[1:] != place[:-1])))
        key, count = np.unique(code[once], return_counts=True)  # an item's q-gram counts once in a band
        of, b_ = key >> 40, (key & ((1 << 40) - 1)) - (1 << 30)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for i, b in zip(of[count >= self.least[of]].tolist(), b_[count >= self.least[of]].tolist(), strict=True):
            e, m = int(self.edits[i]), len(self.codes[i])
            if (i, b // 2) in best and best[i, b // 2][3] == 0 or (i, (b - 1) // 2) in best and best[i, (b - 1) // 2][3] == 0:
                continue
            d, n_d = np.unique(diagonal[(item == i) & (band >= b) & (band <= b + 1)], return_counts=True)
            d = int(d[n_d.argmax()])
            if d >= 0 and d + m <= len(c) and np.array_equal(c[d : d + m], self.codes[i]):
                hit = (d, d + m, 0)
            else:
                hit = banded(self.codes[i], c, b * (e + 1), 2 * (e + 1), e)
            if hit is not None:
                start, stop, edits = hit
                found = (int(self.ids[i]), int(at[start]), int(at[stop - 1]) + 1, edits)
                near = (i, b // 2) if (i, b // 2) in best else (i, (b - 1) // 2)
                if near not in best or found[3] < best[near][3]:
                    best[near] = found
        return sorted(verbatim + _apart(sorted(best.values(), key=lambda x: (x[0], x[3], x[1]))))

    def _verbatim(self, item: np.ndarray, diagonal: np.ndarray, c: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The hits of short items, of which all q-grams lie on one diagonal; of an item's overlapping ones the first."""
        key, count = np.unique(item * np.int64(1 << 40) + diagonal + (1 << 30), return_counts=True)
        of, start = key >> 40, (key & ((1 << 40) - 1)) - (1 << 30)
        whole = count >= self.least[of]
        out, last = [], (-1, 0)
        for i, d in zip(of[whole].tolist(), start[whole].tolist(), strict=True):
            end = d + len(self.codes[i])
            if d < 0 or last[0] == i and d < last[1] or not np.array_equal(c[d:end], self.codes[i]):
                continue
            if d > 0 and _goes_on(c[d - 1], c[d]) or end < len(c) and _goes_on(c[end - 1], c[end]):
                continue
            last = (i, end)
            out.append((int(self.ids[i]), int(at[d]), int(at[end - 1]) + 1, 0))
        return out


def _goes_on(a: int, b: int) -> bool:
    """Whether a word goes on from one code point to the next; scripts without blanks have a word at each character."""
    alone = lambda x: x >= 0x2E80 or 0xE00 <= x < 0xF00 or 0x1000 <= x < 0x10A0 or 0x1780 <= x < 0x1800
    return all(0xD800 > x or x > 0xDFFF for x in (a, b)) and chr(a).isalnum() and chr(b).isalnum() and not (alone(a) or alone(b))


def _apart(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of one item's overlapping hits the one with the fewest edits stays; in order of item and place."""
    out: list[tuple[int, int, int, int]] = []
    for h in hits:
        if not any(o[0] == h[0] and o[1] < h[2] and h[1] < o[2] for o in out):
            out.append(h)
    return sorted(out)


def banded(item: np.ndarray, text: np.ndarray, first: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """The best alignment of the whole item with a stretch of text on diagonals first .. first + width, if it takes at
    most so many edits: start, stop, edits. One row of the band for each character of the item."""
    d = np.arange(width + 1)
    cost, origin = np.where((first + d >= 0) & (first + d <= len(text)), 0, 1 << 20), first + d
    for i in range(len(item)):
        j = first + i + d  # the text's character that the diagonal step takes
        inside = (j >= 0) & (j < len(text))
        step = cost + np.where(inside, text[np.clip(j, 0, len(text) - 1)] != item[i], 1 << 20)
        up = np.append(cost[1:] + 1, 1 << 20)
        take = up < step
        new, from_ = np.where(take, up, step), np.where(take, np.append(origin[1:], 0), origin)
        # runs of skipped text characters: the least of new[k] + (d - k) over k <= d
        reach = new - d
        low = np.minimum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == low, d, 0))
        cost, origin = low + d, from_[source]
        if cost.min() > edits:
            return None
    end = int(cost.argmin())
    start, stop = int(origin[end]), first + len(item) + end
    return (start, min(stop, len(text)), int(cost[end])) if start < stop else None


@lru_cache(2)
def index_of(items: tuple[tuple[int, str], ...], edits: float) -> Index:
    return Index(items, edits)


def _blocks(benchmark: DataFrame, block: int) -> Iterator[tuple[tuple[int, str], ...]]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    n = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield tuple(sorted((r.item_id, r.text) for r in rows))


def contamination(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, start, stop (code points) and edits of each benchmark item found in a document."""
    kind = dict(docs.dtypes)["doc_id"]
    out = None
    for items in _blocks(benchmark, block):
        got = docs.select("doc_id", "text").mapInPandas(_searcher(items, edits), f"doc_id {kind}, {HITS}")
        out = got if out is None else out.unionByName(got)
    return out


def _searcher(items, edits):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = index_of(items, edits)
        for b in batches:
            rows = [(doc, *hit) for doc, text in zip(b["doc_id"], b["text"], strict=True) for hit in index.search(text)]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "stop", "edits"])

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """The documents in which no item is found, with all their columns; one filter per block, none shuffles."""
    for items in _blocks(benchmark, block):
        index = F.pandas_udf(_cleaner(items, edits), "boolean")
        docs = docs.filter(index(F.col("text")))
    return docs


def _cleaner(items, edits):
    def clean(texts: pd.Series) -> pd.Series:
        index = index_of(items, edits)
        return pd.Series([not index.search(t) for t in texts], dtype=bool)

    return clean


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
