"""Work on rows that are sorted by a key, whole groups at a time, and large groups dealt over tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convolake.llm.common import Scratch

#: Rows that are worked on at a time, at least (more only where one group is larger).
ROWS = 1 << 17
#: Pairs found that are held before they are reduced or passed on.
HELD = 1 << 18


def by_groups(work: Callable[[pa.Table], Iterator[pa.RecordBatch]], key: str, rows: int = ROWS) -> Callable:
    """A function for mapInArrow over batches sorted by key: work() gets about so many rows, never part of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= rows:
                have = pa.Table.from_batches(held)
                keys = have.column(key).to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield from work(have.slice(0, cut))
                rest = have.slice(cut)
                held, size = rest.to_batches(), rest.num_rows
        if size:
            yield from work(pa.Table.from_batches(held))

    return run


def arranged(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with so many items each: the row of each item, and its number within the row."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def large_groups(entries: DataFrame, key: str, tile: int, s: Scratch) -> DataFrame | None:
    """The keys of groups of over 2 * tile rows and their sizes, if there are any."""
    large = s.written(entries.groupBy(key).agg(F.count("*").alias("__size")).filter(F.col("__size") > 2 * tile), "large-groups")
    return None if large.isEmpty() else large


def tiled(entries: DataFrame, key: str, member: list[str], tile: int, s: Scratch) -> DataFrame:
    return dealt(entries, key, member, tile, large_groups(entries, key, tile, s))


def dealt(entries: DataFrame, key: str, member: list[str], tile: int, large: DataFrame | None) -> DataFrame:
    """entries in which the keys of large groups are replaced by keys of tiles: a group's members (identified by the columns
    member) are dealt over blocks, and each pair of blocks is a group of its own. There is then a column block, for apart();
    if there was one, of larger tiles, it is replaced (pairs within its blocks are then found in each of its tiles)."""
    if large is None:
        return entries
    e = entries.join(large, key, "left").withColumn("__blocks", F.ceil(F.col("__size") / tile).cast("int"))
    e = e.withColumn("__own", F.pmod(F.xxhash64(*member), F.col("__blocks")).cast("int"))
    e = e.withColumn("__other", F.explode(F.when(F.col("__blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("__blocks") - 1))))
    pair = F.xxhash64(key, F.least("__own", "__other"), F.greatest("__own", "__other"))
    return e.withColumn(key, F.when(F.col("__blocks").isNull(), F.col(key)).otherwise(pair)).select(*[c for c in entries.columns if c != "block"], F.coalesce("__own", F.lit(0)).alias("block"))


def apart(rows: pa.Table, group: np.ndarray, order: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether pairs of rows (in this order, with these ascending group numbers) belong to their tile: in a tile of two
    blocks, pairs within a block do not, for they have a tile of their own."""
    if "block" not in rows.schema.names or not len(group):
        return lambda i, j: np.ones(len(i), bool)
    block = rows.column("block").to_numpy()[order]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    two = (np.maximum.reduceat(block, first) != np.minimum.reduceat(block, first))[group]
    return lambda i, j: ~two[i] | (block[i] != block[j])
