"""Operator 8: near-duplicate documents with SetSketch registers.

A document's set holds its distinct shingles of five words (A-Z lower-cased); a shorter text is one shingle. Documents
are linked where the Jaccard similarity of their sets reaches 0.75; components of linked documents share an id.

1. Each document gets REGISTERS minima of exponentially spaced hash values, truncated to 16 bits (SetSketch: merged() takes
   the registers of a union, and registers are equal with a chance of about the similarity), and a 128-bit key of its set.
2. Documents with equal sets are one class from here on.
3. Registers are banded; classes that share a band are candidates. Of each band's bucket the class with most company
   (its hub) is paired with all others, so that a bucket of n gives n - 1 pairs. Pairs pass if the likelihood estimate
   of the similarity, jointly from registers and set sizes, is near enough, and are then confirmed on the full sets.
4. Where a bucket's members are not all connected by then, those outside its largest component are compared with all
   members of other components, within the bucket (large buckets are dealt over tiles: pairs of blocks). Of the partners
   with enough equal registers (low bytes), the BEST are passed on, to be estimated and confirmed like the others.
5. Classes that had more partners than were passed on are compared once more with all members of their buckets in other
   components, by WIDE registers instead: few pairs below the threshold pass these, and all that do are confirmed.

Bands, and either count of equal registers, each miss a pair at the threshold with a chance of about 2e-6. Set keys have
128 bits and shingles 64. Defined results: null texts and texts without words have empty sets, stay alone and are kept;
a null doc_id has a null component and is kept; rows with the same doc_id are one node, whatever their texts; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convolake.llm.common import Scratch, batch_words, mix, small_side, table, written
from convolake.llm.components import components
from convolake.llm.groups import HELD, apart, arranged, by_groups, tiled

WORDS = 5
THRESHOLD = 0.75
BANDS, ROWS = 24, 3
#: Registers: the first BANDS * ROWS are banded, all are compared; WIDE of them where these leave too much open.
REGISTERS, WIDE = 126, 1_024
#: Equal low bytes that a pair must have: 4.6 standard errors below what the threshold lets expect.
EQUAL, WIDE_EQUAL = 72, 705
BASE = 1.001
#: Estimates from which pairs are confirmed: about four standard errors below the threshold.
ESTIMATE = 0.55
#: Partners that a bucket passes on for a class at first; classes in a block of a large bucket.
BEST, TILE = 2, 512
#: Rows (ids, or classes whose sets are asked for) up to which they are broadcast to the texts.
SENT = 500_000
#: Bytes of registers that are compared at a time.
BYTES = 1 << 22

_rng = np.random.Generator(np.random.PCG64(811))
_TIMES = _rng.integers(0, 2**64, WIDE, dtype=np.uint64) | np.uint64(1)
_PLUS = _rng.integers(0, 2**64, WIDE, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**64, WORDS, dtype=np.uint64) | np.uint64(1)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of many texts, sorted within each, and the number of them in each text."""
    words, text, _, _, _ = batch_words(texts)
    n = len(texts)
    size = np.bincount(text, minlength=n)
    out, owner = [], []
    if len(words) >= WORDS:
        h = np.zeros(len(words) - WORDS + 1, np.uint64)
        for k in range(WORDS):
            h += mix(words[k : len(words) - WORDS + 1 + k] * _PLACE[k])
        whole = text[: len(h)] == text[WORDS - 1 :]
        out.append(mix(h[whole]))
        owner.append(text[: len(h)][whole])
    short = np.flatnonzero((size > 0) & (size < WORDS))
    if len(short):
        starts = np.searchsorted(text, short)
        h = size[short].astype(np.uint64)
        for k in range(WORDS - 1):
            there = size[short] > k
            h[there] += mix(words[starts[there] + k] * _PLACE[k])
        out.append(mix(h + np.uint64(77)))
        owner.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    h, owner = np.concatenate(out), np.concatenate(owner)
    by = np.lexsort((h, owner))
    h, owner = h[by], owner[by]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))
    return h[new], np.bincount(owner[new], minlength=n)


def registers(h: np.ndarray, start: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of the sets that begin at start in h (none is empty): count columns of 16 bits."""
    out = np.empty((len(start), count), np.uint16)
    for i in range(count):
        least = np.minimum.reduceat(h * _TIMES[i] + _PLUS[i], start)
        exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
        out[:, i] = np.clip(np.floor(1 - np.log(np.maximum(exponential, 1e-300)) / np.log(BASE)) + 20_000, 0, 65_535)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def low_bytes(r: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in (r & 255).astype(np.uint8)]


def sketch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for part in _slices(b):
            h, size = shingles(part["text"].tolist())
            some = np.flatnonzero(size)
            start = (np.cumsum(size) - size)[some]
            s1, s2, regs, low = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), [None] * len(part), [None] * len(part)
            if len(some):
                s1[some], s2[some] = set_keys(h, start)
                r = registers(h, start)
                for i, x, y in zip(some, r, low_bytes(r), strict=True):
                    regs[i], low[i] = x.tobytes(), y
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "n": size, "s1": s1, "s2": s2, "regs": regs, "low": low})


def _slices(b: pd.DataFrame, chars: int = 1 << 19) -> Iterator[pd.DataFrame]:
    """Rows of b, about so many characters at a time."""
    size = b["text"].str.len().fillna(0).to_numpy(np.int64)
    block = np.cumsum(size) // chars
    cut = np.flatnonzero(np.diff(block, prepend=-1))
    for a, e in zip(cut, [*cut[1:], len(b)], strict=True):
        yield b.iloc[a:e]


def set_keys(h: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.add.reduceat(mix(h ^ np.uint64(0x5BD1E995)), start).view(np.int64), np.add.reduceat(mix(h + np.uint64(0x27D4EB2F)), start).view(np.int64)


def set_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sets of the classes that texts stand for (asked: their ids and keys)."""
    for b in batches:
        for part in _slices(b):
            h, size = shingles(part["text"].tolist())
            some = np.flatnonzero(size)
            start = (np.cumsum(size) - size)[some]
            ids, members = [], []
            if len(some):
                asked = part["asked"].tolist()
                for i, at, k1, k2 in zip(some, start, *set_keys(h, start), strict=True):
                    for x in asked[i]:
                        if x["s1"] == k1 and x["s2"] == k2:
                            ids.append(x["id"])
                            members.append(h[at : at + size[i]].tobytes())
            yield pd.DataFrame({"id": np.array(ids, np.int64), "members": members})


def wide_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for a in range(0, len(b), 64):
            part = b.iloc[a : a + 64]
            size = part["members"].str.len().to_numpy() // 8
            h = np.frombuffer(b"".join(part["members"]), np.uint64)
            yield pd.DataFrame({"id": part["id"].to_numpy(), "low": low_bytes(registers(h, np.cumsum(size) - size, WIDE))})


_GRID = np.linspace(0, 1, 201)


def estimate(na: np.ndarray, nb: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """The similarity with the greatest likelihood, given set sizes and which registers are greater, less or equal."""
    more, less = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    equal = ra.shape[1] - more - less
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    a, b = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    value = more[:, None] * np.log(a + tiny) + less[:, None] * np.log(b + tiny) + equal[:, None] * np.log(np.maximum(1 - a - b, tiny))
    return np.take_along_axis(j, value.argmax(axis=1)[:, None], axis=1)[:, 0]


def estimated(na: pd.Series, nb: pd.Series, ra: pd.Series, rb: pd.Series) -> pd.Series:
    as_rows = lambda s: np.frombuffer(b"".join(s), np.uint16).reshape(-1, REGISTERS)
    return pd.Series(estimate(na.to_numpy(float), nb.to_numpy(float), as_rows(ra), as_rows(rb)))


def common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a, b, strict=True)], dtype="int64")


def _passed(ids: np.ndarray, found: list[tuple], best: int | None) -> Iterator[pa.RecordBatch]:
    """The pairs to pass on, with whether the asker has more than these."""
    i, j, equal = (np.concatenate(x) for x in zip(*found, strict=True))
    more = np.zeros(len(i), bool)
    if best is not None and len(i):
        order = np.lexsort((ids[j], -equal, i))
        i, j = i[order], j[order]
        start = np.flatnonzero(np.diff(i, prepend=-1))
        size = np.diff(np.append(start, len(i)))
        rank = np.arange(len(i)) - np.repeat(start, size)
        more = np.repeat(size > best, size)[rank < best]
        i, j = i[rank < best], j[rank < best]
    if len(i):
        yield pa.RecordBatch.from_arrays([*map(pa.array, (ids[i], ids[j], more))], ["asker", "other", "more"])


def _compared(least: int, best: int | None):
    """Of rows of complete buckets (bucket, id, comp, n, low; asked if best is None): pairs of members of different
    components with at least so many equal low bytes. Who asks for partners are the members outside a bucket's largest
    component or, if best is None, those marked asked, for whom all partners are passed on, each pair by the bucket of
    the first band that it shares (regs: the banded registers)."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, ids, comp, n = (rows.column(c).to_numpy() for c in ("bucket", "id", "comp", "n"))
        by = np.lexsort((n, bucket))
        bucket, ids, comp, n = bucket[by], ids[by], comp[by], n[by]
        group = np.cumsum(np.concatenate(([True], bucket[1:] != bucket[:-1]))) - 1
        if best is None:
            askers = np.flatnonzero(rows.column("asked").to_numpy(zero_copy_only=False)[by])
        else:
            at = np.lexsort((comp, group))
            new = np.flatnonzero(np.concatenate(([True], (np.diff(group[at]) != 0) | (np.diff(comp[at]) != 0))))
            size = np.diff(np.append(new, len(at)))
            order = np.lexsort((size, group[at][new]))
            last = np.flatnonzero(np.append(np.diff(group[at][new][order]) != 0, True))
            main = comp[at][new][order][last]
            askers = np.flatnonzero(comp != main[group])
        if not len(askers):
            return
        low = rows.column("low").combine_chunks()
        low = np.frombuffer(b"".join(low.to_pylist()), np.uint8).reshape(len(by), -1)[by]
        if best is None:
            band = rows.column("band").to_numpy()[by]
            banded = np.frombuffer(b"".join(rows.column("regs").to_pylist()), np.uint16).reshape(len(by), BANDS, ROWS)[by]
        own = apart(rows, group, by)
        span = np.int64(n.max() * 2 + 2)
        code = group * span + n
        from_ = np.searchsorted(code, group[askers] * span + -(-3 * n[askers] // 4))
        to = np.searchsorted(code, group[askers] * span + 4 * n[askers] // 3, side="right")
        count = to - from_
        step = max(1, BYTES // low.shape[1])
        found, size = [], 0
        edges = np.unique(np.minimum(np.searchsorted(np.cumsum(count), np.arange(step, count.sum() + step, step)) + 1, len(askers)))
        a = 0
        for e in edges:  # all partners of an asker come together
            owner, k = arranged(count[a:e])
            i, j = askers[a:e][owner], from_[a:e][owner] + k
            other = (comp[i] != comp[j]) & own(i, j)
            i, j = i[other], j[other]
            for c in range(0, len(i), step):
                x, y = i[c : c + step], j[c : c + step]
                equal = (low[x] == low[y]).sum(axis=1)
                ok = np.flatnonzero(equal >= least)
                if best is None:
                    ok = ok[(banded[x[ok]] == banded[y[ok]]).all(axis=2).argmax(axis=1) == band[x[ok]]]
                found.append((x[ok], y[ok], equal[ok]))
                size += len(ok)
            a = e
            if size >= HELD:
                yield from _passed(ids, found, best)
                found, size = [], 0
        if size:
            yield from _passed(ids, found, best)

    return work


class Buckets:
    """The classes that share bands, and the links among them that are confirmed so far."""

    def __init__(self, docs: DataFrame, classes: DataFrame, s: Scratch, sent: int = SENT):
        self.s = s
        bands = classes.select("id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.substring("regs", k * 2 * ROWS + 1, F.lit(2 * ROWS)))).alias("band", "values"))
        bands = bands.select(F.xxhash64("band", "values").alias("bucket"), "band", "id")
        full = bands.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
        self.entries = s.written(bands.join(full, "bucket"), "buckets")
        company = self.entries.groupBy("id").agg(F.sum("size").alias("company"))
        self.regs = s.written(classes.join(company, "id"), "candidates")
        asked = s.written(self.regs.groupBy("doc_id").agg(F.collect_list(F.struct("id", "s1", "s2")).alias("asked")), "asked")
        asked = F.broadcast(asked) if self.regs.count() <= sent else asked
        self.sets = s.written(docs.select("doc_id", "text").join(asked, "doc_id").mapInPandas(set_rows, "id long, members binary").dropDuplicates(["id"]), "sets")
        self.links = self.comp = None

    def labelled(self, *columns: str) -> DataFrame:
        """id, comp and these columns of each class that shares a band."""
        regs = self.regs.select("id", *columns)
        if self.comp is None:
            return regs.withColumn("comp", F.col("id"))
        return regs.join(self.comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))

    def hub_pairs(self) -> DataFrame:
        """Each bucket's hub, the class with most company, with its other members."""
        entries = self.entries.select("bucket", "id").join(self.regs.select("id", "company"), "id")
        hubs = entries.groupBy("bucket").agg(F.max_by("id", F.struct("company", -F.col("id"))).alias("hub"))
        return entries.join(hubs, "bucket").filter("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))

    def mixed(self, only: DataFrame | None = None) -> DataFrame:
        """bucket, band, id and comp of the members of buckets with several components (of those that hold an id of only)."""
        entries = self.s.written(self.entries.select("bucket", "band", "id").join(self.labelled(), "id"), "labelled")
        parts = entries.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("bucket")
        if only is not None:
            parts = parts.join(entries.join(only, "id").select("bucket").distinct(), "bucket")
        return entries.join(parts, "bucket")

    def compared(self, rows: DataFrame, least: int, best: int | None, tile: int) -> DataFrame:
        rows = tiled(rows, "bucket", ["id"], tile, self.s)
        work = by_groups(_compared(least, best), "bucket", 1 << 14)
        return self.s.written(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(work, "asker long, other long, more boolean"), "compared")

    def test(self, pairs: DataFrame) -> None:
        """Confirms pairs of ids (a < b)."""
        estimated_, common_ = F.pandas_udf(estimated, "double"), F.pandas_udf(common, "long")
        side = lambda df, x, cols: df.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in cols])
        near = pairs.distinct().join(side(self.regs, "a", ["n", "regs"]), "a").join(side(self.regs, "b", ["n", "regs"]), "b")
        near = near.filter(4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b"))
        near = near.filter(estimated_("n_a", "n_b", "regs_a", "regs_b") >= ESTIMATE).select("a", "b", "n_a", "n_b")
        shared = near.join(side(self.sets, "a", ["members"]), "a").join(side(self.sets, "b", ["members"]), "b").select("a", "b", "n_a", "n_b", common_("members_a", "members_b").alias("both"))
        links = self.s.written(shared.filter(100 * F.col("both") >= 75 * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b"), "confirmed")
        self.linked(links)

    def linked(self, links: DataFrame) -> None:
        if not links.isEmpty():
            self.links = links if self.links is None else self.links.unionByName(links)
            self.comp = components(self.links, self.s)

    def link_all(self, best: int, tile: int) -> None:
        ordered = lambda df: df.select(F.least("asker", "other").alias("a"), F.greatest("asker", "other").alias("b"))
        self.test(self.hub_pairs())
        rows = self.mixed().join(self.regs.select("id", "n", "low"), "id")
        found = self.compared(rows, EQUAL, best, tile)
        self.test(ordered(found))
        more = self.s.written(found.filter("more").select(F.col("asker").alias("id")).distinct(), "asking")
        if more.isEmpty():
            return
        rows = self.s.written(self.mixed(more), "mixed")
        wide = self.s.written(self.sets.join(rows.select("id").distinct(), "id").mapInPandas(wide_rows, "id long, low binary"), "wide")
        rows = rows.join(wide, "id").join(self.regs.select("id", "n", F.substring("regs", 1, 2 * BANDS * ROWS).alias("regs")), "id").join(more.withColumn("asked", F.lit(True)), "id", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
        self.test(ordered(self.compared(rows, WIDE_EQUAL, None, tile)))


def near_duplicates(docs: DataFrame, best: int = BEST, tile: int = TILE, sent: int = SENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs. The numbers do not change the result."""
    s, kind = Scratch(docs.sparkSession), dict(docs.dtypes)["doc_id"]
    found = s.written(docs.select("doc_id", "text").mapInPandas(sketch_rows, f"doc_id {kind}, n long, s1 long, s2 long, regs binary, low binary"), "sketches")
    some = found.filter("n > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.first("regs").alias("regs"), F.first("low").alias("low"))
    classes = s.written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    b = Buckets(docs, classes, s, sent)
    own = s.written(some.select("doc_id", "s1", "s2").join(classes.select("s1", "s2", "id"), ["s1", "s2"]).select("doc_id", "id").distinct(), "own")
    texts = own.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a <> z").select("doc_id", "a")
    b.linked(s.written(own.join(texts, "doc_id").filter("id <> a").select("a", F.col("id").alias("b")), "same-doc"))
    b.link_all(best, tile)
    labels = classes.select("id", "doc_id")
    if b.comp is not None:
        labels = labels.join(b.comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        least = labels.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
        labels = labels.join(least, "comp").select("id", "component_id")
    else:
        labels = labels.withColumnRenamed("doc_id", "component_id")
    comp = own.join(labels, "id").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = (
        found.select("doc_id", F.col("n").alias("n_shingles"))
        .join(comp, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
    out = written(out, "near-duplicates")
    s.clear()
    return out


def without_near_duplicates(docs: DataFrame, sent: int = SENT) -> DataFrame:
    """One document of each component (that with the smallest doc_id), with all columns; of rows with the same doc_id, that
    with the least text. Rows without doc_id all stay."""
    gone = small_side(written(near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "gone"), sent)
    rest = docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    repeated = written(docs.groupBy("doc_id").agg(F.count("*").alias("__n")).filter("__n > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__gone")), "repeated-ids")
    if repeated.isEmpty():
        return rest
    of = F.col("doc_id") == F.col("__gone")
    one = rest.join(repeated, of, "left_semi").withColumn("__rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first()))).filter("__rank = 1").drop("__rank")
    return rest.join(repeated, of, "left_anti").unionByName(one)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
