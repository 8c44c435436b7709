"""Operator 11: languages of a text as a mixture, inferred by expectation-maximisation.

Texts are read as grams of GRAM bytes of lower-cased words (ASCII characters that are no letters are blanks, runs of blanks
one), hashed to BUCKETS. learned() counts the grams of all labelled training texts in one pass: each task sums its own
counts, Spark adds them by language and bucket, and the counts (languages times BUCKETS, however many texts) become gram
likelihoods with additive smoothing.

A text's grams are then taken for draws from a mixture of languages whose proportions EM estimates; texts of a block are
worked out together in numpy, each by itself. The language set is the one with the highest log-likelihood less PENALTY *
log(1 + grams) for each language beyond the first: first the single language of highest likelihood, then the two, three,
... with the largest proportions, for as long as the full mixture, whose likelihood bounds that of every set, leaves room
for that many languages. The prediction is the set's largest share, which is the score.

lang, source and doc_id are no input of a prediction: the model is learned from texts and lang of training rows alone.
No shuffle but that of the counts; a task that is lost is run again with the same result.

Defined results: a null text, one without a letter, and every text where nothing was learned is `und` with score 0 and no
languages; training rows with null text or null lang are not learned from; equal shares go to the first language in
alphabetical order; a null doc_id counts as the empty text in the split; repeated rows each have a row and each count; an
empty table gives none; other columns are not read. Texts are never cut; memory is bounded by the longest one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import table

GRAM, BUCKETS = 3, 1 << 16
SMOOTHING = 0.5
#: Log-likelihood that each language beyond the first costs, per log(1 + grams).
PENALTY = 3.0
#: EM rounds at most; a text's proportions are final once they all change by less than SETTLED.
ROUNDS, SETTLED = 40, 1e-4
#: Bytes of texts whose grams are cut together, numbers that are worked on together, and languages that a task counts at once.
BLOCK, CELLS, OPEN = 4 << 20, 1 << 22, 64
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


@dataclass
class Languages:
    """Languages in alphabetical order and the likelihood of each bucket (BUCKETS x languages)."""

    names: list[str]
    likelihood: np.ndarray


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and bucket of every gram, in blocks; a block holds whole texts, or a part of a long one."""
    row, n = 0, len(texts)
    while row < n:
        raw, size = [], 0
        while row + len(raw) < n and (not raw or size < BLOCK):
            raw.append(b" " + texts[row + len(raw)].encode("utf-8", "surrogatepass") + b" ")
            size += len(raw[-1])
        data = _FOLD[np.frombuffer(b"".join(raw), np.uint8)]
        text = np.repeat(np.arange(row, row + len(raw), dtype=np.int32), [len(x) for x in raw])
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (text[1:] != text[:-1])
        data, text = data[keep], text[keep]
        for at in range(0, len(data) - GRAM + 1, BLOCK):
            part, whose = data[at : at + BLOCK + GRAM - 1].astype(np.uint64), text[at : at + BLOCK + GRAM - 1]
            last = len(part) - GRAM + 1
            code = np.zeros(last, np.uint64)
            for k in range(GRAM):
                code = (code << np.uint64(8)) | part[k : k + last]
            inside = whose[GRAM - 1 :] == whose[:last]
            yield whose[:last][inside], ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)[inside]
        row += len(raw)


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and how often, for the grams of each text, in order."""
    keys, counts = [], []
    for text, bucket in grams(texts):
        key = np.sort(text * np.int64(BUCKETS) + bucket)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        if keys and len(first) and keys[-1][-1] // BUCKETS == key[0] // BUCKETS:  # a long text goes on
            same = int(key[0] // BUCKETS)
            began = np.searchsorted(keys[-1], same * BUCKETS)
            stop = np.searchsorted(key, (same + 1) * BUCKETS)
            sums = np.bincount(key[:stop] - same * BUCKETS, minlength=BUCKETS)
            np.add.at(sums, keys[-1][began:] - same * BUCKETS, counts[-1][began:])
            there = np.flatnonzero(sums)
            keys[-1], counts[-1] = keys[-1][:began], counts[-1][:began]
            keys.append(there + same * BUCKETS)
            counts.append(sums[there])
            first = first[np.searchsorted(key[first], (same + 1) * BUCKETS) :]
            if not len(keys[-2]):
                del keys[-2], counts[-2]
        if len(first):
            keys.append(key[first])
            counts.append(np.diff(np.append(first, len(key))))
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    return key // BUCKETS, key % BUCKETS, np.concatenate(counts) if keys else np.zeros(0, np.int64)


# --- learning ---------------------------------------------------------------------------------------------------------------
def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Gram counts by language of one task."""
    sums: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for name, n in sums.items():
            bucket = np.flatnonzero(n)
            yield pd.DataFrame({"lang": name, "bucket": bucket.astype(np.int32), "n": n[bucket]})
        sums.clear()

    for batch in batches:
        for name, rows in batch.groupby("lang"):
            if name not in sums and len(sums) == OPEN:
                yield from flush()
            total = sums.setdefault(str(name), np.zeros(BUCKETS, np.int64))
            for _, bucket in grams(rows.text.tolist()):
                total += np.bincount(bucket, minlength=BUCKETS)
    yield from flush()


def learned(labelled: DataFrame) -> Languages:
    """The model of texts (text, lang), all of them."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select(F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang"))
    parts = rows.mapInPandas(_count, "lang string, bucket int, n long")
    found = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages times BUCKETS rows at most
    names = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    code = pa.compute.index_in(found.column("lang"), pa.array(names, pa.string())).to_numpy()
    counts[found.column("bucket").to_numpy(), code] = found.column("n").to_numpy()
    return Languages(names, ((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS)).astype(np.float32))


# --- inference --------------------------------------------------------------------------------------------------------------
def proportions(p: np.ndarray, count: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages that each text may have (allowed: texts x languages), and the log-likelihood.

    p: likelihoods of each gram (grams x languages); a text's grams begin at starts, and are there count times."""
    share = (allowed / allowed.sum(1, keepdims=True)).astype(np.float32)
    size = np.diff(np.append(starts, len(count)))
    open_ = np.arange(len(starts))
    for turn in range(ROUNDS):
        if turn % 4 == 0:  # texts that have settled leave; none looks at another text
            if turn:
                open_ = open_[np.abs(share[open_] - before).max(1) >= SETTLED]
            if not len(open_):
                break
            rows = np.concatenate([np.arange(starts[i], starts[i] + size[i]) for i in open_]) if len(open_) < len(starts) else slice(None)
            q, c, text = p[rows], count[rows], np.repeat(np.arange(len(open_)), size[open_])
            at = np.concatenate(([0], np.cumsum(size[open_])[:-1]))
        before = share[open_]
        joint = q * before[text]
        joint *= (c / joint.sum(1))[:, None].astype(np.float32)
        new = np.add.reduceat(joint, at, axis=0)
        share[open_] = new / new.sum(1, keepdims=True)
    text = np.repeat(np.arange(len(starts)), size)
    mixed = (p * share[text]).sum(1, dtype=np.float64)
    return share, np.add.reduceat(count * np.log(mixed), starts)


def mixtures(model: Languages, texts: list[str], penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Of texts that each have a gram: shares (texts x languages, 0 outside the chosen set) and grams."""
    text, bucket, count = gram_counts(texts)
    starts = np.searchsorted(text, np.arange(len(texts)))
    total = np.add.reduceat(count, starts)
    shares = np.zeros((len(texts), len(model.names)), np.float32)
    cells, row = max(1, CELLS // max(1, len(model.names))), 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + cells, side="right")) - 1)
        stop = starts[end] if end < len(texts) else len(count)
        here = slice(starts[row], stop)
        shares[row:end] = _chosen(model.likelihood[bucket[here]], count[here], starts[row:end] - starts[row], penalty * np.log1p(total[row:end]))
        row = end
    return shares, total


def _chosen(p: np.ndarray, count: np.ndarray, starts: np.ndarray, cost: np.ndarray) -> np.ndarray:
    texts, languages = len(starts), p.shape[1]
    single = np.add.reduceat(count[:, None] * np.log(p, dtype=np.float64), starts, axis=0)
    best_share = np.zeros((texts, languages), np.float32)
    best_share[np.arange(texts), single.argmax(1)] = 1
    if languages == 1:
        return best_share
    best = single.max(1)
    full, bound = proportions(p, count, starts, np.ones((texts, languages), bool))
    order = np.argsort(-full, axis=1, kind="stable")
    size = np.diff(np.append(starts, len(count)))
    for k in range(2, languages + 1):
        # slack for proportions that have not settled: they can only raise the bound
        room = np.flatnonzero(bound + 1e-3 * cost - (k - 1) * cost > best)
        if not len(room):
            break
        allowed = np.zeros((len(room), languages), bool)
        np.put_along_axis(allowed, order[room, :k], True, axis=1)
        rows = np.concatenate([np.arange(starts[i], starts[i] + size[i]) for i in room])
        share, got = proportions(p[rows], count[rows], np.concatenate(([0], np.cumsum(size[room])[:-1])), allowed)
        better = got - (k - 1) * cost[room] > best[room]
        best[room[better]] = (got - (k - 1) * cost[room])[better]
        best_share[room[better]] = share[better]
    return best_share


def identified(docs: DataFrame, model: Languages, penalty: float = PENALTY) -> DataFrame:
    """docs' doc_id with languages (array of lang and share, falling), lang_pred and score."""
    kind, spark = dict(docs.dtypes)["doc_id"], docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # languages times BUCKETS numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = held.value
        names = np.array(model.names, dtype=object)
        for batch in batches:
            out = batch[["doc_id"]].assign(languages=[[] for _ in range(len(batch))], lang_pred=UNKNOWN, score=0.0)
            rows = np.flatnonzero(batch.letters.to_numpy())
            if len(rows) and len(names):
                shares, _ = mixtures(model, batch.text.iloc[rows].tolist(), penalty)
                first = shares.argmax(1)
                pred, score, sets = out.lang_pred.to_numpy(object, copy=True), np.zeros(len(out)), list(out.languages)
                pred[rows], score[rows] = names[first], np.clip(shares[np.arange(len(rows)), first], 0, 1)
                order = np.argsort(-shares, axis=1, kind="stable")
                for i, row in enumerate(rows):
                    sets[row] = [{"lang": names[k], "share": float(shares[i, k])} for k in order[i, : np.count_nonzero(shares[i])]]
                out = out.assign(languages=sets, lang_pred=pred, score=score)
            yield out

    d = docs.select("doc_id", F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return d.mapInPandas(run, f"doc_id {kind}, languages array<struct<lang: string, share: double>>, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op11_language_mixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learned(docs.filter(~held_out(F.col("doc_id"))))
    found = identified(docs, model)
    each = F.array_join(F.transform("languages", lambda x: F.concat(x["lang"], F.lit(":"), F.format_number(x["share"], 3))), ",")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("languages").alias("n_languages"), each.alias("languages"))
