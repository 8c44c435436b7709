"""Operator 2: toxicity by a learned lexicon, Levenshtein automata and context windows.

Words and word stems that mark toxic rows are learned from a bounded sample of labelled training rows (documents whose
crc32(doc_id) mod 5 is not 0) by document frequency, in Spark. The lexicon (bounded, so its broadcast is too) is held as
a trie; a Levenshtein automaton walked along it finds misspelled words, also those spelled with digits or signs: where
no run of letters of a chunk (what white space and separators leave) is a hit, the whole chunk is looked up as one word.
Hits are weighed by their surroundings: one inside a pair of quotation marks or after a reporting word counts as
QUOTED_WEIGHT hits, and the densest window of words counts by itself. A logistic regression over these few features
gives the score.

Defined results: a null or empty text has no hits and gets the score of a text without hits; without training rows of
both labels every score is the smoothed share of toxic ones; a row without doc_id is not held out; labels that repeat
count once, as toxic if any says so, and null labels are left out.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import table, written

#: Bounds: labelled rows that are learned from (by hash of doc_id), and terms of the lexicon.
TRAIN_ROWS, LEXICON = 20_000, 2_000
#: A term marks toxic rows if it occurs in this share of them (and in MIN_ROWS), this many times oftener than elsewhere,
#: and if chance would give less than one such term among all (Chernoff bound of the binomial tail).
MIN_SHARE, MIN_ROWS, MIN_RATIO = 0.01, 3, 15.0
STEMS = (4, 5, 6)
WINDOW = 12
CACHE = 400_000
#: What a quoted hit counts for, and how many characters a quotation has at most.
QUOTED_WEIGHT, QUOTATION = 0.25, 400
REPORTING = frozenset("said says say called calls quote quoted quotes wrote word words term citation cité dit dijo sagte".split())
_WORD = re.compile(r"[^\W\d_]+")
#: What may be a word with digits or signs for letters: no white space and separators inside, some signs at its ends.
_CHUNK = re.compile(r"[@$*#+€£&%]?[^\W_](?:[^\s,;:/\\()\[\]{}<>\"“”«»„?=…—–]*[^\W_])?[@$*#+€£&%]?")
#: Terms and words of fewer letters are too close to other words for a fuzzy match.
FUZZY_LETTERS = 4
_QUOTES = re.compile("[\"“”«»„]")
FEATURES = ("words", "stems", "fuzzy", "terms", "window", "quoted", "length")


class Trie:
    """Terms by their letters; near() walks it together with the Levenshtein automaton of a word."""

    def __init__(self, terms: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.final = [False]
        for term in terms:
            at = 0
            for c in term:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.final.append(False)
                at = self.next[at][c]
            self.final[at] = True

    def near(self, word: str, edits: int) -> int | None:
        """The least number of edits (at most edits) that makes word a term, or None.

        A state of the automaton is the row of edit distances between the path so far and the word's prefixes, with
        entries beyond edits cut off; a state without live entries ends the walk.
        """
        best, todo = None, [(0, tuple(range(len(word) + 1)))]
        while todo:
            node, row = todo.pop()
            if self.final[node] and row[-1] <= edits:
                best = row[-1] if best is None else min(best, row[-1])
            for c, child in self.next[node].items():
                new = [row[0] + 1]
                for i, w in enumerate(word):
                    new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (w != c)))
                if min(new) <= edits:
                    todo.append((child, tuple(new)))
        return best


class Lexicon:
    """Exact words, stems and misspelled words; answers are cached for so many words at most."""

    def __init__(self, words: tuple[str, ...], stems: tuple[str, ...]):
        self.words, self.stems = frozenset(words), frozenset(stems)
        long = [w for w in words if len(w) >= FUZZY_LETTERS]
        self.trie = Trie(long)
        # with one edit, one half of the term stays whole: at the start or at the end of the word
        self.heads, self.tails = frozenset(w[: len(w) // 2] for w in long), frozenset(w[len(w) // 2 :] for w in long)
        self.head_sizes, self.tail_sizes = sorted({len(x) for x in self.heads}), sorted({len(x) for x in self.tails})
        self.cache: dict[str, str] = {}
        self.cut: dict[str, tuple[tuple[int, str], ...]] = {}

    def kind(self, w: str) -> str:
        """"w", "s", "f" for a word, a stem, a misspelled word; "" for none."""
        got = self.cache.get(w)
        if got is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[w] = got = self._kind(w)
        return got

    def _kind(self, w: str) -> str:
        if w in self.words:
            return "w"
        if any(w[:k] in self.stems for k in STEMS):
            return "s"
        if len(w) >= FUZZY_LETTERS and (any(w[:k] in self.heads for k in self.head_sizes) or any(w[-k:] in self.tails for k in self.tail_sizes)):
            return "f" if self.trie.near(w, 1) is not None else ""
        return ""

    def parts(self, chunk: str) -> tuple[tuple[int, str], ...]:
        """Place and text of the words of a chunk: its runs of letters, or itself if only as a whole it is a hit."""
        if chunk.isalpha():
            return ((0, chunk),)
        got = self.cut.get(chunk)
        if got is None:
            if len(self.cut) >= CACHE:
                self.cut.clear()
            got = tuple((m.start(), m[0]) for m in _WORD.finditer(chunk))
            if not any(self.kind(w) for _, w in got) and self.kind(chunk):
                got = ((0, chunk),)
            self.cut[chunk] = got
        return got

    def features(self, text: str | None) -> list[float]:
        lower = (text or "").lower()
        chunks = _CHUNK.findall(lower)
        parts = {c: self.parts(c) for c in set(chunks)}
        hit = {w for p in parts.values() for _, w in p if self.kind(w)}
        if not hit:
            return [0.0] * 6 + [float(np.log1p(sum(len(parts[c]) for c in chunks)))]
        found = [(m.start() + k, w) for m in _CHUNK.finditer(lower) for k, w in parts[m[0]]]
        quotes = [m.start() for m in _QUOTES.finditer(lower)]
        inside, k = [], 0
        while k + 1 < len(quotes):
            pair = quotes[k + 1] - quotes[k] <= QUOTATION
            inside += quotes[k : k + 2] if pair else []
            k += 2 if pair else 1
        at, quoted, weight, kinds = [], 0, [], {"w": 0.0, "s": 0.0, "f": 0.0}
        for i, (start, w) in enumerate(found):
            if w in hit:
                at.append(i)
                cited = bool(bisect_left(inside, start) % 2) or any(x in REPORTING for _, x in found[max(0, i - 3) : i])
                quoted += cited
                weight.append(QUOTED_WEIGHT if cited else 1.0)
                kinds[self.kind(w)] += weight[-1]
        places, sums = np.array(at), np.concatenate(([0.0], np.cumsum(weight)))
        window = float((sums[np.searchsorted(places, places + WINDOW)] - sums[:-1]).max())
        terms = len(hit) * float(np.mean(weight))
        logs = [float(np.log1p(x)) for x in (kinds["w"], kinds["s"], kinds["f"], terms, window)]
        return [*logs, quoted / len(at), float(np.log1p(len(found)))]


@lru_cache(2)
def lexicon(words: tuple[str, ...], stems: tuple[str, ...]) -> Lexicon:
    return Lexicon(words, stems)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """text and toxic of at most so many labelled documents that are not held out."""
    drawn = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return written(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id").select("text", "toxic").distinct(), "toxic-rows")


def learn_lexicon(train: DataFrame, size: int = LEXICON) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """The words and stems that mark toxic rows."""
    total = train.agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")).first()
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0)))
    stems = [F.transform(F.filter(words, lambda w: F.length(w) > 3), lambda w: F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS]  # noqa: B023
    terms = train.select("toxic", F.explode(F.array_distinct(F.concat(F.filter(words, lambda w: F.length(w) > 2), *stems))).alias("term"))
    rate = (F.col("bad") + 0.5) / (total.bad + 1) / ((F.col("good") + 0.5) / (total.good + 1))
    least = max(MIN_ROWS, MIN_SHARE * total.bad)
    counts = written(terms.groupBy("term").agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")), "toxic-terms")
    share = (total.bad + 0.5) / (total.bad + total.good + 1)
    n, p = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    beyond = F.col("bad") * F.log(p / share) + F.when(p < 1, F.col("good") * F.log((1 - p) / (1 - share))).otherwise(0.0)
    chosen = (
        counts.filter((F.col("bad") >= least) & (n > 0) & (rate >= MIN_RATIO) & (beyond >= float(np.log(max(1, counts.count())))))
        .orderBy(F.desc(F.col("bad") - F.col("good")), "term")
        .limit(size)
        .collect()
    )
    found = sorted(r.term for r in chosen)
    return tuple(t for t in found if t[-1] != "*"), tuple(t[:-1] for t in found if t[-1] == "*")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, positive: int = 0) -> np.ndarray:
    """Weights (the last one constant) of a ridge-penalised logistic regression, by Newton's method. Of the first so many
    columns none lowers the score: those that would are left out."""
    used = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1] + 1)
        w[np.append(used, True)] = _fitted(x[:, used], y, ridge)
        against = used & (w[:-1] < 0) & (np.arange(x.shape[1]) < positive)
        if not against.any():
            return w
        used &= ~against


def _fitted(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


class ToxicityModel:
    def __init__(self, words: tuple[str, ...], stems: tuple[str, ...], weights: np.ndarray):
        self.words, self.stems, self.weights = words, stems, weights

    def scores(self, texts: list[str | None]) -> np.ndarray:
        lex = lexicon(self.words, self.stems)
        x = np.array([lex.features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    train = training_rows(docs, labels)
    words, stems = learn_lexicon(train)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = lexicon(words, stems)
        for b in batches:
            out = pd.DataFrame([lex.features(t) for t in b["text"]], columns=list(FEATURES))
            out["toxic"] = b["toxic"].to_numpy()
            yield out

    got = train.mapInPandas(run, ", ".join(f"{f} double" for f in FEATURES) + ", toxic int").collect()  # TRAIN_ROWS rows at most
    x, y = np.array([r[:-1] for r in got], float).reshape(len(got), len(FEATURES)), np.array([r[-1] for r in got], float)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return ToxicityModel((), (), np.array([0.0] * len(FEATURES) + [np.log(share / (1 - share))]))
    return ToxicityModel(words, stems, logistic(x, y, positive=FEATURES.index("quoted")))


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = model.scores(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    d = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return d.mapInPandas(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity(docs, fit_toxicity(docs, labels))
