"""Operator 3: token ids as length-delimited binary records.

Texts are dealt by ranges of doc_id, sorted, encoded, and each task writes shards of at most SHARD_BYTES into the shared
folder. A shard is a run of frames:

    uint64 payload length | uint32 masked crc32 of those 8 bytes | payload | uint32 masked crc32 of the payload

all little-endian, where masked(c) = rotate_right(c, 15) + 0xa282ead8 (mod 2**32), so that checksums of data that hold
checksums stay sound. A payload is: int64 doc_id, uint8 flags (1: doc_id is null), uint8 bytes per id (2 or 4), the ids.
Beside the shards stands an offset index (a table: shard, doc_id, offset, length, n_tokens), from which single records
can be read in any order. Only the index that the finished tasks return counts, so shards that a lost or repeated task
left behind are never read.

Encoding is by the tokenizers library. Its tokenizer drops white space and never joins text across it, so each word is
encoded once per worker and then looked up (bounded caches); letters before a plain punctuation tail are looked up apart.

Defined results: a null or empty text is the end id alone; rows with equal doc_id follow each other, in order of text;
rows without doc_id come first; an empty table writes no shard and reads as an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from convolake.llm.common import shared_dir, table, written

END_ID = 2
SHARD_BYTES = 24 << 20
#: Words and word cores that a worker keeps.
CACHE_WORDS, CACHE_CORES = 500_000, 700_000
_TAIL = ".,!?;:*$%&#|()\"-"
_META = "<qBB"
_META_SIZE = struct.calcsize(_META)
#: Blanks for str.split() that the tokenizer takes for symbols.
_ODD = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[ \t\n\r]+")

#: The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}

INDEX = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("shard", StringType()),
        StructField("part", LongType()),
        StructField("offset", LongType()),
        StructField("length", LongType()),
        StructField("n_tokens", LongType()),
    ]
)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(zlib.crc32(head))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def frames(data: bytes) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each frame; ValueError where a checksum or a length is wrong."""
    at, view = 0, memoryview(data)
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError(f"cut off at {at}")
        size, check = struct.unpack_from("<QI", view, at)
        if masked(zlib.crc32(view[at : at + 8])) != check or at + 16 + size > len(data):
            raise ValueError(f"bad length at {at}")
        payload = view[at + 12 : at + 12 + size]
        if masked(zlib.crc32(payload)) != struct.unpack_from("<I", view, at + 12 + size)[0]:
            raise ValueError(f"bad checksum at {at}")
        yield at, payload
        at += 16 + size


class WordEncoder(dict):
    """Ids of words as uint16 or uint32 bytes. Words (and their cores: letters, lower-cased) that come first are kept,
    CACHE_WORDS and CACHE_CORES of them at most; others are encoded anew."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if not any(isinstance(x, dict) and x.get("type") == "ByteLevel" for x in json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]):
            raise ValueError("a byte-level tokenizer is needed")
        self.model = self.tokenizer.model
        self.code = "H" if max(self.tokenizer.get_vocab_size(), END_ID + 1) <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.cores: dict[str, bytes] = {}

    def _plain(self, core: str) -> bytes:
        """Lower-case letters that the normaliser leaves as they are: straight to the library's BPE model."""
        got = self.cores.get(core)
        if got is None:
            letters = core if core.isascii() else core.encode().decode("latin-1").translate(_BYTE_LETTERS)
            got = array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(self.cores) < CACHE_CORES:
                self.cores[core] = got
        return got

    def _any(self, word: str) -> bytes:
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        core = word if word.isalpha() else word.rstrip(_TAIL)
        if core.isalpha() and (core.isascii() or max(core) < "\u0130" and unicodedata.is_normalized("NFC", core)):
            got = self._plain(core.lower())
            if len(core) < len(word):
                tail = word[len(core) :]
                if (more := self.cores.get(tail)) is None:
                    more = self._any(tail)
                    if len(self.cores) < CACHE_CORES:
                        self.cores[tail] = more
                got += more
        else:
            got = self._any(word)
        if len(self) < CACHE_WORDS:
            self[word] = got
        return got

    def encode(self, texts: list[str | None]) -> list[bytes]:
        get, out = self.__getitem__, []
        for t in texts:
            t = t or ""
            out.append(b"".join(map(get, t.split() if not _ODD.search(t) else filter(None, _BLANKS.split(t)))))
        return out


@lru_cache(1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_records(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the shards of docs (doc_id, text) below folder, in order of doc_id; returns the offset index, written."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        enc = encoder(path)
        end = array(enc.code, [end_id]).tobytes()
        width = enc.width
        sink, name, size, rows, seq = None, "", 0, [], 0

        def flush():
            nonlocal sink, rows
            if sink is not None:
                sink.close()
            sink, done, rows = None, rows, []
            return pd.DataFrame(done, columns=INDEX.names).astype({"doc_id": "Int64"})

        for b in batches:
            for at in range(0, len(b), 256):
                ids = b["doc_id"].iloc[at : at + 256].tolist()
                for doc, data in zip(ids, enc.encode(b["text"].iloc[at : at + 256].tolist()), strict=True):
                    null = doc is None or doc != doc
                    rec = frame(struct.pack(_META, 0 if null else int(doc), int(null), width) + data + end)
                    if sink is not None and size + len(rec) > SHARD_BYTES:
                        yield flush()
                    if sink is None:
                        name, size, seq = f"{part:08d}-{seq:06d}-{uuid.uuid4().hex}.rec", 0, seq + 1
                        sink = store.open_output_stream(f"{root}/{name}")
                    sink.write(rec)
                    rows.append((None if null else int(doc), name, part, size, len(rec), len(data) // width + 1))
                    size += len(rec)
        if rows:
            yield flush()

    store_dir(folder)
    n = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return written(dealt.mapInPandas(run, INDEX), "record-index")


def store_dir(folder: str) -> None:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids of each record, read from the shards that the index names."""
    schema = "doc_id long, shard string, offset long, within long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, data in zip(b["path"], b["content"], strict=True):
                rows, within = [], 0
                for at, payload in frames(data):
                    doc, null, width = struct.unpack_from(_META, payload)
                    ids = np.frombuffer(payload[_META_SIZE :], "<u2" if width == 2 else "<u4").astype("<u4")
                    rows.append((None if null else doc, path.rsplit("/", 1)[-1], at, within, len(ids), zlib.crc32(ids.tobytes())))
                    within += len(ids)
                yield pd.DataFrame(rows, columns=["doc_id", "shard", "offset", "within", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    # one row per shard file (tens of MB of text each), not per document
    before = shards.select("shard", (F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")).alias("before"))
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.rec").load(folder)
    found = files.select("path", "content").mapInPandas(run, schema)
    return found.join(before, "shard").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def read_shuffled(folder: str, index: DataFrame, seed: int, open_files: int = 16) -> DataFrame:
    """doc_id and ids of each record in an order drawn by seed: the index is dealt in that order over tasks, and each task
    reads its records one by one at their offsets (so many shards stay open at a time)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        files: OrderedDict = OrderedDict()
        for b in batches:
            docs, out = [], []
            for shard, at, size in zip(b["shard"], b["offset"], b["length"], strict=True):
                if shard not in files:
                    if len(files) >= open_files:
                        files.popitem(last=False)[1].close()
                    files[shard] = store.open_input_file(f"{root}/{shard}")
                files.move_to_end(shard)
                files[shard].seek(int(at))
                ((_, payload),) = frames(files[shard].read(int(size)))
                doc, null, width = struct.unpack_from(_META, payload)
                docs.append(None if null else doc)
                out.append(np.frombuffer(payload[_META_SIZE:], "<u2" if width == 2 else "<u4").astype(np.int64))
            yield pd.DataFrame({"doc_id": pd.array(docs, "Int64"), "ids": out})
        for f in files.values():
            f.close()

    n = max(index.sparkSession.sparkContext.defaultParallelism, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = index.select("shard", "offset", "length", F.xxhash64("shard", "offset", F.lit(seed)).alias("draw"))
    return drawn.repartitionByRange(n, "draw").sortWithinPartitions("draw").mapInPandas(run, "doc_id long, ids array<long>")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    index = write_records(table(spark, sf_dir, "documents"), folder)
    return read_records(spark, folder, index)
