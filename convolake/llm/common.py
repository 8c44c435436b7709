"""Helpers shared by the operators: inputs, written tables and word hashing."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"
_own_dir: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where that is unset and Spark runs in one process
    (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dir:
            _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        found = _own_dir[app]
    return found.rstrip("/")


#: Spark removes a query's shuffle files when it ends (else when the driver happens to collect its garbage).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, and survives the loss of any executor. The shuffle files behind
    it go once it is written."""
    return Scratch(df.sparkSession).written(df, name)


#: Spark asks after each row whether a batch for Python has so many bytes; this many means that it does not ask. The number
#: of rows in a batch is limited besides.
_BYTES, _NEVER, _ROWS = "spark.sql.execution.arrow.maxBytesPerBatch", str((1 << 31) - 1), "spark.sql.execution.arrow.maxRecordsPerBatch"


class Scratch:
    """Tables in the shared folder that are emptied again when the work that needs them is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
        """narrow: all rows that Python gets for df are of a small fixed width, so that their number limits a batch."""
        path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        asked = {_CLEANUP: "true"}
        if narrow and 0 < int(self.spark.conf.get(_ROWS)) <= 1_000_000:
            asked[_BYTES] = _NEVER
        before = {k: self.spark.conf.get(k, None) for k in asked}
        for k, v in asked.items():
            self.spark.conf.set(k, v)
        try:
            df.write.parquet(path)
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Writes nothing over each table, which any store that Spark writes to can do."""
        for path in self.paths:
            self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)
        self.paths = []


def small_side(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """df (a written table of few narrow columns) as the broadcast side of a join if it has so many rows at most; else as it
    is, so that both sides are shuffled."""
    return F.broadcast(df) if df.count() <= rows else df


def bind(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often body uses it (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def record(**fields: Column) -> Column:
    """A struct with these fields; unlike struct() it keeps their names inside lambdas."""
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def words_of(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


# --- hashing of words over whole batches ------------------------------------------------------------------------------
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grown(key: str, base: int, n: int) -> np.ndarray:
    have = _powers[key]
    if len(have) < n:
        size = 1 << (n - 1).bit_length()
        out = np.empty(size, np.uint64)
        out[0] = 1
        done = 1
        while done < size:  # doubling: the second half is the first times base ** done
            step = np.uint64(pow(base, done, 2**64))
            m = min(done, size - done)
            out[done : done + m] = out[:m] * step
            done += m
        _powers[key] = have = out
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte codes times powers; span_hash() takes the hash of any span from them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _grown("up", _BASE, len(data) + 1)[: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    down = _grown("down", pow(_BASE, -1, 2**64), len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def batch_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of many texts: the hash of each word (A-Z lower-cased), its text, its line in that text; then the first word of
    each text, and the number of lines of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    data = _LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    if len(edge) % 2:
        edge = np.append(edge, len(data))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum(size)
    text = np.searchsorted(ends, start, side="right")
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, start, side="left")  # lines before the word's, over all texts
    first_line = np.searchsorted(breaks, ends - size, side="left")
    lines = np.diff(np.append(first_line, len(breaks)))
    sums = prefix_hash(data)
    return span_hash(sums, start, end), text, line - first_line[text] if len(text) else line, np.searchsorted(text, np.arange(len(texts))), lines
