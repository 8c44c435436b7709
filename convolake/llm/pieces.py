"""Operator 5: SentencePiece encoding with seeded merge dropout, and decoding.

Encoding follows the BPE model's agenda: the best-scored pair of neighbouring symbols (leftmost on ties) merges first.
With dropout, a candidate merge is skipped if the keyed hash of seed, document, occurrence, word and the places of its two
parts falls under the dropout rate; skipped candidates never come back, so the outcome depends on the key alone. A
document's variant is a 64-bit hash of its id, an occurrence is its place among the text's units, so every occurrence of a
word is cut anew. A worker keeps (in bounded caches) the pieces without dropout of each word that it met before, and the
candidates on the way there: an occurrence that skips none of these has these pieces. The same is kept of the way on which
one of them is skipped, if it is asked for again: an occurrence that skips this one, and none on that way, has its pieces.
Any other is merged by itself, as are words met once. No piece has a blank inside, so blanks cut a text into units that are
encoded apart; many units merge at the same time, one merge each a round, in numpy.

Characters without a piece become byte pieces, and so do a text's own U+2581 signs, which makes decoding lossless for
every text. With a rate of 0 the pieces are those of the sentencepiece library (but for U+2581).

Defined results: null and empty texts have no pieces and decode to the empty text; repeated rows are encoded each for
itself; a null doc_id has variant 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import mix, table

RATE, SEED = 0.1, 17
#: Variants that tests try; any number of 64 bits is one.
VARIANTS = 4
#: Words and ways that a worker keeps; hashed places for the words it has met.
CACHE_UNITS, CACHE_WAYS, MET = 100_000, 200_000, 1 << 22
#: Units that merge at the same time; units whose candidates are looked at together; documents and characters of a batch.
ROUND, LOOK, BATCH_DOCS, BATCH_CHARS = 8_192, 1 << 15, 512, 1_000_000
_UNIT = re.compile("[\n▁]| *[^ \n▁]+| +")
_NEVER = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCoder:
    def __init__(self, path: str, rate: float = RATE, seed: int = SEED):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.rate = sp.vocab_size(), rate
        self.limit = np.uint64(min(int(rate * 2**64), 2**64 - 1))
        self.seed = mix(np.array([seed], np.uint64))[0]
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        self.byte = np.zeros(256, np.int32)
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
        plain = {p.replace("▁", " "): i for i, p in enumerate(pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.char = {p: i for p, i in plain.items() if len(p) == 1}
        self.none = np.int32(sp.unk_id())  # a character without a piece; in no pair
        self.letters = np.full(0x110000, self.none, np.int32)  # pieces of one character by code point
        self.letters[[ord(p) for p in self.char]] = list(self.char.values())
        raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes, self.n_bytes = np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))
        self.at_byte = np.cumsum(self.n_bytes) - self.n_bytes
        # a pair's rank: the place of its merged piece among all, best score first
        score = {i: sp.get_score(i) for i in plain.values()}
        steps = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = sorted((plain[p[:k]] * self.size + plain[p[k:]], steps[score[i]], i) for p, i in plain.items() for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain)
        self.pair = np.array([x[0] for x in pairs] + [2**62], np.int64)
        self.rank = np.array([x[1] for x in pairs] + [0], np.int32)
        self.merged = np.array([x[2] for x in pairs] + [0], np.int32)
        # pairs by hashed slot, the next free one where it is taken
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), (1 << bits) - 1
        self.slot = np.full(1 << bits, len(pairs), np.int32)
        self.slot_code = np.full(1 << bits, -1, np.int64)
        left = np.arange(len(pairs))
        at = self._slot(self.pair[:-1])
        while len(left):
            free = self.slot_code[at] < 0
            self.slot_code[at[free]] = self.pair[left[free]]
            self.slot[at[free]] = left[free]  # of equal places the last one holds, in both
            lost = self.slot_code[at] != self.pair[left]
            left, at = left[lost], (at[lost] + 1) & self.slots
        self.forget()

    def forget(self) -> None:
        """Units with their numbers (ways on which one candidate is skipped have some, too); by number the place of the
        pieces in a pool and their count, the hash, and the candidates' hashed places; by candidate the number of the way on
        which it is skipped, -1, or -2 if that was asked for once; the units met, by hash."""
        self.number: dict[str, int] = {}
        self.pool = np.zeros(0, self.kind)
        self.start = self.many = np.zeros(0, np.int64)
        self.word = self.spots = np.zeros(0, np.uint64)
        self.first = self.count = np.zeros(0, np.int64)
        self.without = np.zeros(0, np.int32)
        self.met = np.zeros(MET, bool)

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code.view(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def _place(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are pairs, and their places among all pairs."""
        at = self._slot(code)
        have = self.slot_code[at]
        same = have == code
        ask = np.flatnonzero(~same & (have >= 0))
        while len(ask):
            at[ask] = (at[ask] + 1) & self.slots
            have = self.slot_code[at[ask]]
            same[ask] = found = have == code[ask]
            ask = ask[~found & (have >= 0)]
        found = np.flatnonzero(same)
        return found, self.slot[at[found]]

    def _candidates(self, sym, nxt, rank, piece, row, at, width, key, seen=None, forced=None) -> None:
        """Puts rank (_NEVER if there is none) and piece of the merge of the symbols at the cells `at` (of rows) and after
        them. With seen, none is skipped (but for a row's forced one) and rows and hashed places of all are put there."""
        right = nxt[at]
        found, place = self._place(sym[at] * np.int64(self.size) + sym[right])
        rank[at] = _NEVER
        at = at[found]
        if self.rate > 0:
            right, row = right[found], row[found]
            from_ = row * width
            spot = ((at - from_) << 42) | ((right - from_) << 21) | (nxt[right] - from_)
            spot = mix(spot.view(np.uint64) + np.uint64(1))
            if seen is None:
                stay = mix(key[row] ^ spot) >= self.limit
                at, place = at[stay], place[stay]
            else:
                if forced is not None:
                    stay = spot != forced[row]
                    at, place, row, spot = at[stay], place[stay], row[stay], spot[stay]
                seen.append((row, spot))
        rank[at], piece[at] = self.rank[place], self.merged[place]

    @staticmethod
    def _words(units: list[str]) -> np.ndarray:
        return np.fromiter((zlib.crc32(u) | (zlib.adler32(u) << 32) for u in map(str.encode, units)), np.uint64, len(units))

    def _keys(self, words: np.ndarray, variants) -> np.ndarray:
        return mix(words ^ self.seed ^ (np.asarray(variants).astype(np.uint64) << np.uint64(7)))

    def _merge(self, units: list[str], variant, seen=None, key=None, forced=None, flat: bool = False):
        """The piece ids (as uint16 or uint32 bytes) of units of about the same length; flat: in one array, with each one's
        count. variant: of all, or of each; or key: what _keys() gives for them."""
        n = len(units)
        length = np.fromiter(map(len, units), np.int64, n)
        width = int(length.max()) + 1  # a row ends in cells without a symbol, and so does the whole
        if key is None and seen is None:
            key = self._keys(self._words(units), variant)
        cells = np.flatnonzero(np.arange(width) < length[:, None])
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = np.full(n * width + 1, self.none, np.int32)
        sym[cells] = self.letters[points]
        nxt, prv = np.arange(1, n * width + 2), np.arange(-1, n * width)
        nxt[-1] = n * width
        row = np.repeat(np.arange(n), length)
        rank, piece = np.full(n * width + 1, _NEVER), np.zeros(n * width + 1, np.int32)
        self._candidates(sym, nxt, rank, piece, row, cells, width, key, seen, forced)
        gone_, live, rows = [], np.arange(n), rank[:-1].reshape(n, width)
        while len(live):
            best = rows[live].argmin(axis=1) + live * width
            go = rank[best] < _NEVER
            live, best = live[go], best[go]
            if not len(live):
                break
            gone = nxt[best]
            after = nxt[gone]
            sym[best] = piece[best]
            nxt[best] = after
            prv[after] = best
            rank[gone] = _NEVER
            gone_.append(gone)
            left = prv[best]  # of a row's first cell: one without a symbol
            self._candidates(sym, nxt, rank, piece, np.concatenate((live, live)), np.concatenate((best, left)), width, key, seen, forced)
        alive = np.ones(n * width + 1, bool)
        if gone_:
            alive[np.concatenate(gone_)] = False
        alive = alive[cells]
        ids, many = sym[cells[alive]], np.bincount(row[alive], minlength=n)
        bare = np.flatnonzero(ids == self.none)
        if len(bare):  # characters without a piece become their bytes
            raw = [chr(x).encode() for x in points[alive][bare].tolist()]
            reps = np.ones(len(ids), np.int64)
            reps[bare] = size = np.fromiter(map(len, raw), np.int64, len(raw))
            ends, own = np.cumsum(reps), row[alive]
            ids = np.repeat(ids, reps)
            ids[self._span(ends[bare] - size, size)] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
            many = np.bincount(np.repeat(own, reps), minlength=n)
        ids = ids.astype(self.kind)
        return (ids, many) if flat else [x.tobytes() for x in np.split(ids, np.cumsum(many)[:-1])]

    @staticmethod
    def _span(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The places start .. start + size of each, one after the other."""
        ends = np.cumsum(size)
        return np.arange(int(size.sum())) + np.repeat(start - (ends - size), size)

    @property
    def kind(self):
        return np.uint16 if self.size <= 1 << 16 else np.uint32

    def _parts(self, units: list[str], by: list[int]) -> Iterator[list[int]]:
        """Places of units (by: in order of length) that merge at the same time."""
        at = 0
        while at < len(by):
            n = max(1, min(ROUND, (1 << 19) // len(units[by[min(at + ROUND, len(by)) - 1]])))
            yield by[at : at + n]
            at += n

    def _learn(self, new: list[str], words_: np.ndarray, forced: np.ndarray | None = None) -> np.ndarray:
        """Numbers of new units; or, with the hashed places that are skipped, of these ways of units."""
        pool, many = [self.pool], [self.many]
        words, firsts, counts, spots = [self.word], [self.first], [self.count], [self.spots]
        base, made, ids = len(self.spots), len(self.many), np.zeros(len(new), np.int64)
        for part in self._parts(new, sorted(range(len(new)), key=lambda i: len(new[i]))):
            seen: list[tuple[np.ndarray, np.ndarray]] = []
            ids[part] = np.arange(made, made + len(part))
            made += len(part)
            pieces, size = self._merge([new[i] for i in part], 0, seen, forced=None if forced is None else forced[part], flat=True)
            pool.append(pieces)
            many.append(size)
            row = np.concatenate([r for r, _ in seen]) if seen else np.zeros(0, np.int64)
            n = np.bincount(row, minlength=len(part))
            spots.append(np.concatenate([x for _, x in seen])[np.argsort(row, kind="stable")] if seen else np.zeros(0, np.uint64))
            words.append(words_[part])
            counts.append(n)
            firsts.append(base + np.cumsum(n) - n)
            base += int(n.sum())
        self.pool, self.many, self.word, self.first, self.count, self.spots = map(np.concatenate, (pool, many, words, firsts, counts, spots))
        self.start = np.cumsum(self.many) - self.many
        self.without = np.concatenate((self.without, np.full(base - len(self.without), -1, np.int32)))
        return ids

    def _skipped(self, ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of numbers with keys: places in ids and candidates, of all candidates that are skipped."""
        owns, entries = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(0, len(ids), LOOK):
            part = ids[k : k + LOOK]
            n = self.count[part]
            entry = self._span(self.first[part], n)
            at = np.flatnonzero(mix(np.repeat(keys[k : k + LOOK], n) ^ self.spots[entry]) < self.limit)
            owns.append(k + np.searchsorted(np.cumsum(n), at, side="right"))
            entries.append(entry[at])
        return np.concatenate(owns), np.concatenate(entries)

    def _numbers(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: a word met for the first time) and hash of each unit."""
        ids = np.fromiter(map(self.number.get, units, repeat(-1)), np.int64, len(units))
        word, known = np.empty(len(units), np.uint64), ids >= 0
        word[known] = self.word[ids[known]]
        at = np.flatnonzero(~known)
        lacking = [units[i] for i in at.tolist()]
        place = {u: k for k, u in enumerate(dict.fromkeys(lacking))}
        which = np.fromiter(map(place.__getitem__, lacking), np.int64, len(lacking))
        new = list(place)
        words = self._words(new)
        word[at] = words[which]
        mark = (words % np.uint64(MET)).astype(np.int64)
        again = np.flatnonzero(self.met[mark] | (np.bincount(which, minlength=len(new)) > 1))
        self.met[mark] = True
        if len(again):
            number = np.full(len(new), -1)
            kept = [new[i] for i in again.tolist()]
            number[again] = self._learn(kept, words[again])
            self.number.update(zip(kept, number[again].tolist(), strict=True))
            ids[at] = number[which]
        return ids, word

    def _ways(self, units: list[str], ids: np.ndarray, word: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Numbers of the ways on which each unit has its pieces; -1: it is merged by itself."""
        way, known = ids.copy(), np.flatnonzero(ids >= 0)
        own, entry = self._skipped(ids[known], keys[known])
        own = known[own]
        times = np.bincount(own, minlength=len(units))
        way[times > 1] = -1
        one = times[own] == 1
        at, entry = own[one], entry[one]  # units that skip one candidate, and this
        lacking, first, asked = np.unique(entry, return_index=True, return_counts=True)
        state = self.without[lacking]
        self.without[lacking[(state == -1) & (asked == 1)]] = -2
        again = (state < 0) & ((state == -2) | (asked > 1))
        if again.any():
            lacking, first = lacking[again], at[first[again]]
            ways = self._learn([units[i] for i in first.tolist()], word[first], self.spots[lacking])
            self.without[lacking] = ways
        way[at] = taken = np.maximum(self.without[entry], -1)
        at, taken = at[taken >= 0], taken[taken >= 0]
        way[at[self._skipped(taken, keys[at])[0]]] = -1
        return way

    def encode(self, texts: list[str | None], variants: list[int]) -> list[bytes]:
        """Piece ids of each text, as bytes of self.kind."""
        ids, ends = self.encoded(texts, variants)
        return [ids[a:e].tobytes() for a, e in zip([0, *ends[:-1]], ends, strict=True)]

    def encoded(self, texts: list[str | None], variants: list[int]) -> tuple[np.ndarray, list[int]]:
        """Piece ids of all texts, and where each text's end."""
        cut = [_UNIT.findall(" " + t) if t else [] for t in texts]
        units = [u for us in cut for u in us]
        if not units:
            return np.zeros(0, self.kind), [0] * len(texts)
        if len(self.number) > CACHE_UNITS or len(self.many) > CACHE_WAYS:
            self.forget()
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        ends = np.cumsum(sizes)
        way, keys = self._numbers(units)
        if self.rate > 0:
            place = np.arange(len(units)) - np.repeat(ends - sizes, sizes)
            word = keys
            keys = mix(np.repeat(np.array([v & (2**64 - 1) for v in variants], np.uint64), sizes) ^ mix(place.astype(np.uint64) + np.uint64(1)))
            keys = self._keys(word, keys)
            way = self._ways(units, way, word, keys)
        own = np.flatnonzero(way < 0)
        start, many, pool, base = self.start[way] if len(self.start) else way.copy(), self.many[way] if len(self.many) else way.copy(), [self.pool], len(self.pool)
        by = own[np.argsort(np.fromiter((len(units[i]) for i in own.tolist()), np.int64, len(own)), kind="stable")].tolist()
        for part in self._parts(units, by):
            pieces, n = self._merge([units[i] for i in part], None, key=keys[part], flat=True)
            pool.append(pieces)
            start[part], many[part] = base + np.cumsum(n) - n, n
            base += len(pieces)
        done = np.concatenate(([0], np.cumsum(many)))[ends]
        return np.concatenate(pool)[self._span(start, many)], done.tolist()

    def raw(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that piece ids stand for (a text's own follow one blank), and where each one's end."""
        size = self.n_bytes[ids]
        return self.bytes[self._span(self.at_byte[ids], size)], np.cumsum(size)

    def decode(self, ids: np.ndarray) -> str:
        return self.raw(ids)[0].tobytes().decode("utf-8", "replace")[1:]

    def lossless(self, texts: list[str | None], ids: np.ndarray, ends: list[int]) -> list[bool]:
        """Whether each text's bytes come back from its ids."""
        data, size = self.raw(ids)
        data, at = data.tobytes(), np.concatenate(([0], size))[[0, *ends]].tolist()
        return [data[a + 1 : e] == (t or "").encode() for t, a, e in zip(texts, at[:-1], at[1:], strict=True)]


@lru_cache(2)
def coder(path: str, rate: float, seed: int) -> PieceCoder:
    return PieceCoder(path, rate, seed)


def encoded(docs: DataFrame, path: str | None = None, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, variant, pieces (ids), and the text decoded from them, of each document."""
    path = path or model_path()
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = coder(path, rate, seed)
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at : at + 512]
                ids = [np.frombuffer(x, c.kind) for x in c.encode(part["text"].tolist(), part["variant"].tolist())]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "variant": part["variant"].to_numpy(), "pieces": [x.astype(np.int32) for x in ids], "decoded": [c.decode(x) for x in ids]})

    return _with_variant(docs, seed).mapInPandas(run, f"doc_id {kind}, variant long, pieces array<int>, decoded string")


def _with_variant(docs: DataFrame, seed: int) -> DataFrame:
    variant = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.lit(seed))), F.lit(0))
    return docs.select("doc_id", "text", variant.cast("long").alias("variant"))


def piece_digests(docs: DataFrame, path: str | None = None, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, variant, n_pieces, crc32 of the ids (as little-endian 32-bit integers) and whether decoding gave the text."""
    path = path or model_path()
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, rate, seed)
        for b in batches:
            size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.utf8_length(b["text"]), 0).to_numpy(zero_copy_only=False))))
            at = 0
            while at < b.num_rows:  # so many documents or characters, one document at least
                n = int(np.searchsorted(size, size[at] + BATCH_CHARS, side="right")) - 1 - at
                part = b.slice(at, max(1, min(n, BATCH_DOCS)))
                at += part.num_rows
                texts = part["text"].to_pylist()
                ids, ends = c.encoded(texts, part["variant"].to_pylist())
                each = [ids[k:e] for k, e in zip([0, *ends[:-1]], ends, strict=True)]
                digests = {
                    "n_pieces": pa.array([len(x) for x in each], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], pa.int64()),
                    "lossless": pa.array(c.lossless(texts, ids, ends), pa.bool_()),
                }
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "variant": part["variant"], **digests})
        c.forget()  # a worker that waits for other work holds no words
        pa.default_memory_pool().release_unused()

    return _with_variant(docs, seed).mapInArrow(run, f"doc_id {kind}, variant long, n_pieces long, ids_crc32 long, lossless boolean")


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))
