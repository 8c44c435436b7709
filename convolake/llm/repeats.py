"""Operator 9: removal of repeated passages with a range-partitioned, sampled suffix array.

Every byte covered by a LENGTH-byte string that also starts elsewhere (in any document) goes. Only some suffixes need to
be sorted: each LENGTH-byte window has an anchor, its ANCHOR-byte substring with the least hash (leftmost on ties), and
equal windows have equal anchors at equal places. So windows are compared by the suffixes that start at their anchors,
about one for every 170 bytes, and by what stands to the left of these.

1. Anchors of each text, with the hash of the stretch that all windows of the anchor span.
2. Equal stretches are counted (partial sums, so that groups of copies meet as counts): their windows all repeat.
3. One anchor for each different stretch, where anchors with the same substring have several, goes on as a suffix.
   Sampled splitters deal the suffixes over ranges by their leading bytes (a short prefix and hashes that keep runs with
   equal anchors together, so that what the sampler sends to the driver stays small); each bucket is sorted by multikey
   quicksort (eight bytes at a time, three ways), and common prefixes of neighbours give, for each window, the rank of
   its right part; the same on the left. Two windows are equal if and only if both ranks are.
4. Runs of suffixes at the edge of a bucket may go on in another: their windows are compared across boundaries by 64-bit
   hashes, dealt by anchor, place in the window and hash. Windows are counted by anchor, and those of anchors with many
   are dealt over as many more groups, so that no run has to meet in one task.

Hashes of steps 2 and 4 have 128 (substring and stretch) and 64 bits (within one anchor's run). Rows are identified by
doc_id where it is an integer that no other row has, else by a 64-bit hash of doc_id and text; a repeated row repeats its
own text elsewhere. Defined results: null and empty texts have 0 bytes and
keep the empty string; texts shorter than LENGTH lose nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import Scratch, prefix_hash, span_hash, table, written

LENGTH = 400
ANCHOR = 64
PIECE = 1 << 20
#: Suffixes in a bucket, on average, and windows that are ranked at a time.
BUCKET, CHUNK = 20_000, 4_096
_PLACES = LENGTH - ANCHOR + 1
#: Bytes of a suffix in the range key, window places in a group of the comparison across boundaries, and windows in it.
LEADING, _BLOCK, GROUP = 16, 8, 100_000
#: Stretches of rows with fewer than this many are sorted as strings.
_FEW = 48
_WINDOW = np.dtype([("d", "<u2"), ("h", "<u8"), ("rid", "<i8"), ("pos", "<i8"), ("dup", "u1")])


def window_anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """anchor, first and last window start, hash of the anchor's substring, hash of its stretch, for texts that end at
    ends in data."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none
    sums = prefix_hash(data)
    at = np.arange(len(data) - ANCHOR + 1)
    hashes = span_hash(sums, at, at + ANCHOR)
    bits = np.uint64(max(1, int(len(data)).bit_length()))
    best = ((hashes >> bits) << bits) | at.astype(np.uint64)  # the least has the least hash and stands leftmost
    span = 1
    while span * 2 <= _PLACES:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < _PLACES:
        best = np.minimum(best[: len(best) - (_PLACES - span)], best[_PLACES - span :])
    anchor = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    start = np.arange(len(anchor))
    inside = start + LENGTH <= ends[np.searchsorted(ends, start, side="right")]
    start, anchor = start[inside], anchor[inside]
    if not len(start):
        return none, none, none, none, none
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    first, last, a = start[new], start[np.append(new[1:] - 1, len(start) - 1)], anchor[new]
    return a, first, last, hashes[a].astype(np.int64), span_hash(sums, first, last + LENGTH).astype(np.int64)


def _pieces(rids, texts) -> Iterator[tuple[list, list, list]]:
    """Row ids, offsets and bytes of stretches of texts, about PIECE bytes at a time; long texts are cut with overlap."""
    ids, offs, raw, size = [], [], [], 0
    for rid, text in zip(rids, texts, strict=True):
        data = (text or "").encode()
        for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
            part = data[at : at + PIECE + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            ids.append(rid)
            offs.append(at)
            raw.append(part)
            size += len(part)
            if size >= PIECE:
                yield ids, offs, raw
                ids, offs, raw, size = [], [], [], 0
    if raw:
        yield ids, offs, raw


def anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for ids, offs, raw in _pieces(b["rid"], b["text"]):
            ends = np.cumsum([len(r) for r in raw])
            a, first, last, key, ctx = window_anchors(np.frombuffer(b"".join(raw), np.uint8), ends)
            which = np.searchsorted(ends, a, side="right")
            shift = np.array(offs)[which] - np.concatenate(([0], ends[:-1]))[which]
            yield pd.DataFrame({"rid": np.array(ids)[which], "pos": a + shift, "dlo": (a - last).astype(np.int32), "dhi": (a - first).astype(np.int32), "key": key, "ctx": ctx})


def suffix_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes to the right of each anchor, and those to its left in reverse."""
    for b in batches:
        rows = []
        for rid, text, anchors in zip(b["rid"], b["text"], b["anchors"], strict=True):
            data = (text or "").encode()
            for x in anchors:
                p, lo, hi = x["pos"], x["dlo"], x["dhi"]
                rows.append((rid, p, lo, hi, x["n"], data[p : p + LENGTH - lo], data[p - hi : p][::-1]))
            if len(rows) > 5000:
                yield pd.DataFrame(rows, columns=["rid", "pos", "dlo", "dhi", "n", "right", "left"])
                rows = []
        yield pd.DataFrame(rows, columns=["rid", "pos", "dlo", "dhi", "n", "right", "left"])


def byte_matrix(strings: list[bytes], width: int) -> np.ndarray:
    width = -(-width // 8) * 8
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)


def multikey_sort(m: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """The order of m's rows (within group, if given) by multikey quicksort: a stretch of rows is parted in three by one
    word of eight bytes against a pivot, and only those that are equal go on to the next word."""
    keys = m.view(">u8").astype(np.uint64)
    if group is not None:
        keys = np.hstack([group.astype(np.uint64)[:, None], keys])
    rows, order = [x.tobytes() for x in keys.astype(">u8")], np.arange(len(m))
    todo = [(0, len(m), 0)]
    while todo:
        lo, hi, word = todo.pop()
        if hi - lo < 2 or word == keys.shape[1]:
            continue
        here = order[lo:hi]
        if hi - lo < _FEW:
            order[lo:hi] = sorted(here.tolist(), key=lambda i: rows[i][8 * word :])  # noqa: B023
            continue
        k = keys[here, word]
        pivot = np.sort(k[:: max(1, len(k) // 9)])[4]
        less, more = k < pivot, k > pivot
        a, e = lo + int(less.sum()), hi - int(more.sum())
        order[lo:hi] = np.concatenate((here[less], here[~(less | more)], here[more]))
        todo += [(lo, a, word), (a, e, word + 1), (e, hi, word)]
    return order


def common_prefix(m: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it in order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 65_536):
        rows = np.arange(at, min(at + 65_536, len(order)))
        differ = m[order[rows]] != m[order[rows - 1]]
        out[rows] = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return out


def _repeated(right: np.ndarray, left: np.ndarray, group: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in suffix order: whether each window (row, left length) is valid, whether it repeats among them, and
    whether it is the first of its class."""
    n, d = len(right), np.arange(_PLACES)
    lcp = common_prefix(right, np.arange(n))
    rank_right = np.cumsum(lcp[:, None] < (LENGTH - d)[None, :], axis=0, dtype=np.int32)
    order = multikey_sort(left, group)
    lcp_left = common_prefix(left, order)
    g = group[order]
    new = np.concatenate(([True], g[1:] != g[:-1]))
    ranks = np.cumsum((lcp_left[:, None] < d[None, :]) | new[:, None], axis=0, dtype=np.int32)
    rank_left = np.empty_like(ranks)
    rank_left[order] = ranks
    valid = (lo[:, None] <= d) & (d <= hi[:, None])
    code = np.where(valid, (rank_right.astype(np.int64) << 32) | rank_left, -1 - np.arange(n)[:, None])
    by = np.argsort(code, axis=0, kind="stable")
    s = np.take_along_axis(code, by, axis=0)
    same = np.zeros((n + 1, _PLACES), bool)
    same[1:n] = s[1:] == s[:-1]
    dup, first = np.empty((n, _PLACES), bool), np.empty((n, _PLACES), bool)
    np.put_along_axis(dup, by, same[:-1] | same[1:], axis=0)
    np.put_along_axis(first, by, ~same[:-1], axis=0)
    return valid, dup & valid, first & valid


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, first and last column of each run of true flags."""
    edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, a = np.nonzero(edge == 1)
    return row, a, np.nonzero(edge == -1)[1] - 1


SORTED = "rid long, start long, stop long, anchor long, part int, n long, windows binary"


def sorted_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorts one range of suffixes; returns the stretches found to repeat, and the windows of runs at the range's edges."""
    got = [b for b in batches if len(b)]
    if not got:
        return
    b = pd.concat(got, ignore_index=True)
    del got
    right, left = byte_matrix(b["right"].tolist(), LENGTH), byte_matrix(b["left"].tolist(), _PLACES)
    order = multikey_sort(right)
    right, left = right[order], left[order]
    rid, pos, lo, hi, count = (b[c].to_numpy()[order] for c in ("rid", "pos", "dlo", "dhi", "n"))
    del b
    group = np.cumsum(common_prefix(right, np.arange(len(right))) < ANCHOR) - 1
    leading = right[:, :LEADING].copy().view(f"S{LEADING}")[:, 0]
    at_edge = (leading == leading[0]) | (leading == leading[-1])  # with equal leading bytes, the ranges go by hashes
    ends = np.flatnonzero(np.diff(group, append=group[-1] + 1)) + 1
    at = 0
    while at < len(group):  # whole runs, about CHUNK rows at a time; a longer run is taken as a whole
        stop = ends[min(np.searchsorted(ends, at + CHUNK), len(ends) - 1)]
        if stop - at > CHUNK and (earlier := ends[max(0, np.searchsorted(ends, at + CHUNK) - 1)]) > at:
            stop = earlier
        part = slice(at, stop)
        for sub in _long_runs(right[part], left[part], group[part]):
            rows = np.arange(at, stop)[sub]
            valid, dup, first = _repeated(right[rows], left[rows], group[rows], lo[rows], hi[rows])
            if len(sub) < stop - at:
                edge = np.ones(len(rows), bool)
            else:
                edge = at_edge[rows]
            r, d1, d2 = _runs(dup & (count[rows] == 1)[:, None])
            yield pd.DataFrame({"rid": rid[rows[r]], "start": pos[rows[r]] - d2, "stop": pos[rows[r]] - d1 + LENGTH, "anchor": np.zeros(len(r), np.int64), "part": -1, "n": 0, "windows": None})
            if edge.any():
                yield _edge_windows(right[rows], left[rows], rid[rows], pos[rows], first & edge[:, None], dup | (count[rows] > 1)[:, None])
        at = stop


def _long_runs(right, left, group) -> list[np.ndarray]:
    """The rows as blocks of at most 2 * CHUNK; windows of a run that is cut meet in the comparison across boundaries."""
    n = len(group)
    if n <= 2 * CHUNK:
        return [np.arange(n)]
    return [np.arange(a, min(a + CHUNK, n)) for a in range(0, n, CHUNK)]


def _edge_windows(right, left, rid, pos, first, dup) -> pd.DataFrame:
    width_l, width_r = left.shape[1], right.shape[1]
    data = np.hstack([left[:, ::-1], right])
    width = width_l + width_r
    sums = prefix_hash(data.reshape(-1))
    row, d = np.nonzero(first)
    start = row * width + width_l - d
    out = np.zeros(len(row), _WINDOW)
    out["d"], out["h"], out["rid"], out["pos"], out["dup"] = d, span_hash(sums, start, start + LENGTH), rid[row], pos[row], dup[row, d]
    at = np.arange(len(right)) * width + width_l
    anchor = span_hash(sums, at, at + ANCHOR).astype(np.int64)[row]
    part = (d // _BLOCK).astype(np.int32)
    by = np.lexsort((part, anchor))
    out, anchor, part = out[by], anchor[by], part[by]
    cut = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (anchor[1:] != anchor[:-1]))))
    return pd.DataFrame(
        {"rid": 0, "start": 0, "stop": 0, "anchor": anchor[cut], "part": part[cut], "n": np.diff(np.append(cut, len(out))), "windows": [x.tobytes() for x in np.split(out, cut[1:])]}
    )


def salted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows dealt by hash over the groups of their anchor and part."""
    for b in batches:
        rows = []
        for anchor, part, groups, windows in zip(b["anchor"], b["part"], b["groups"], b["windows"], strict=True):
            if groups == 1:
                rows.append((anchor, part, 0, windows))
                continue
            x = np.frombuffer(windows, _WINDOW)
            own = (x["h"] % np.uint64(groups)).astype(np.int64)
            by = np.argsort(own, kind="stable")
            cut = np.flatnonzero(np.diff(own[by], prepend=-1))
            rows += [(anchor, part, int(own[w[0]]), x[w].tobytes()) for w in np.split(by, cut[1:])]
        yield pd.DataFrame(rows, columns=["anchor", "part", "salt", "windows"])


def across(group: pd.DataFrame) -> pd.DataFrame:
    """Of one anchor's windows from several buckets: those that occur in more than one and were not known to repeat."""
    x = np.concatenate([np.frombuffer(w, _WINDOW) for w in group["windows"]])
    x = x[np.lexsort((x["h"], x["d"]))]
    same = np.concatenate(([False], (x["h"][1:] == x["h"][:-1]) & (x["d"][1:] == x["d"][:-1]), [False]))
    x = x[(same[:-1] | same[1:]) & (x["dup"] == 0)]
    start = x["pos"] - x["d"]
    by = np.lexsort((start, x["rid"]))
    rid, start = x["rid"][by], start[by]
    cut = np.flatnonzero(np.concatenate(([True], (rid[1:] != rid[:-1]) | (start[1:] - start[:-1] > 1)))) if len(x) else np.zeros(0, np.int64)
    last = np.append(cut[1:] - 1, len(x) - 1) if len(x) else cut
    return pd.DataFrame({"rid": rid[cut], "start": start[cut], "stop": start[last] + LENGTH})


def without(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts without their stretches."""
    for b in batches:
        out = []
        for doc, text, spans in zip(b["doc_id"], b["text"], b["spans"], strict=True):
            data, kept, at, removed, n = (text or "").encode(), [], 0, 0, 0
            start = stop = -1
            for s, e in sorted((x["start"], x["stop"]) for x in (spans if spans is not None else ())):
                if s > stop:
                    if stop >= 0:
                        kept.append(data[at:start])
                        at, removed, n = stop, removed + stop - start, n + 1
                    start, stop = s, e
                else:
                    stop = max(stop, e)
            if stop >= 0:
                kept.append(data[at:start])
                at, removed, n = stop, removed + stop - start, n + 1
            kept.append(data[at:])
            out.append((doc, len(data), removed, n, b"".join(kept)))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in without(batches):
        b["kept_sha256"] = [hashlib.sha256(k).hexdigest() for k in b["kept"]]
        yield b.drop(columns="kept")


def repeated_stretches(docs: DataFrame, s: Scratch, bucket: int = BUCKET, group: int = GROUP) -> DataFrame:
    """rid, start, stop (bytes) of stretches of docs (rid, text) whose windows all repeat; they may overlap. bucket and
    group do not change what they cover."""
    anchors = s.written(docs.select("rid", "text").mapInPandas(anchor_rows, "rid long, pos long, dlo int, dhi int, key long, ctx long"), "anchors")
    same = ["key", "ctx", "dlo", "dhi"]
    stretches = s.written(anchors.groupBy(*same).agg(F.count("*").alias("n"), F.min("rid").alias("rid"), F.min_by("pos", "rid").alias("pos")), "stretches")
    copies = anchors.join(stretches.filter("n > 1").select(*same), same).select("rid", (F.col("pos") - F.col("dhi")).alias("start"), (F.col("pos") - F.col("dlo") + LENGTH).alias("stop"))
    several = stretches.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key")
    rest = s.written(stretches.join(several, "key").select("rid", "pos", "dlo", "dhi", "n"), "suffixes")
    per_doc = rest.groupBy("rid").agg(F.collect_list(F.struct("pos", "dlo", "dhi", "n")).alias("anchors"))
    suffixes = docs.select("rid", "text").join(per_doc, "rid").mapInPandas(suffix_rows, "rid long, pos long, dlo int, dhi int, n long, right binary, left binary")
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rest.count() // bucket))
    ranges = [F.substring("right", 1, LEADING), F.xxhash64(F.substring("right", 1, ANCHOR)), F.xxhash64("rid", "pos")]
    found = s.written(suffixes.repartitionByRange(n, *ranges).mapInPandas(sorted_bucket, SORTED), "sorted")
    windows = found.filter("part >= 0").select("anchor", "part", "n", "windows")
    sizes = windows.groupBy("anchor", "part").agg(F.ceil(F.sum("n") / group).alias("groups"))
    dealt = windows.join(sizes, ["anchor", "part"]).select("anchor", "part", "groups", "windows").mapInPandas(salted, "anchor long, part int, salt long, windows binary")
    edges = dealt.groupBy("anchor", "part", "salt").applyInPandas(across, "rid long, start long, stop long")
    return copies.unionByName(found.filter("part < 0").select("rid", "start", "stop")).unionByName(edges)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and rid, which identifies the row (up to repeated ones)."""
    d = docs.select("doc_id", "text")
    if dict(d.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint") and d.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty():
        return d.withColumn("rid", F.col("doc_id").cast("long"))
    return d.withColumn("rid", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.coalesce("text", F.lit(""))))


def remove_repeats(docs: DataFrame, **sizes) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of each document."""
    return _applied(docs, without, "kept binary", **sizes)


def _applied(docs: DataFrame, how, last: str, **sizes) -> DataFrame:
    s, d, kind = Scratch(docs.sparkSession), identified(docs), dict(docs.dtypes)["doc_id"]
    spans = written(repeated_stretches(d, s, **sizes).groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    s.clear()
    return d.join(spans, "rid", "left").select("doc_id", "text", "spans").mapInPandas(how, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, {last}")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(table(spark, sf_dir, "documents"), digested, "kept_sha256 string")
