"""Reproducible shuffling and sharding by a Feistel permutation with cycle walking over global row numbers.

Rows get gapless numbers in the order of their ids.  A keyed four-round Feistel network permutes the numbers of the
smallest square grid a * a that holds them all, and a number that leaves the range of the rows is permuted again until
it is back (cycle walking), which keeps the map a permutation of the row numbers.  Shard and slot follow from the
permuted number by arithmetic alone: position p is in shard p mod shards, slot p div shards.  So shard sizes differ by
one row at most (the law ``rows``; equal texts are dealt out like any other rows, since a shard that had to hold all
copies of a text would break the law), and anyone can compute where a row is, or which row is in a place (``inverse``).

The numbers come from a range partitioning by id of narrow rows (texts stay behind) and one count for each partition;
only those counts reach the driver.  A random-like last ordering column splits even a run of equal rows.

Defined cases: null ids come first; rows with equal ids are ordered by size and checksum; fully equal rows take
neighbouring numbers in any order, which cannot be told apart; null text has size 16 and the checksum of no bytes (0).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fresh

ROUNDS = 4


def _round(x: np.ndarray, key: int, number: int) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03 + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(1)


def _side(rows: int) -> int:
    side = int(rows**0.5)
    while side * side < rows:
        side += 1
    return max(side, 1)


def _walk(numbers: np.ndarray, rows: int, step) -> np.ndarray:
    out = step(numbers)
    while (outside := out >= rows).any():
        out[outside] = step(out[outside])
    return out


def permute(numbers: np.ndarray, rows: int, key: int) -> np.ndarray:
    """The places of row numbers in 0 .. rows - 1."""
    side = _side(rows)

    def step(x: np.ndarray) -> np.ndarray:
        left, right = x // side, x % side
        for n in range(ROUNDS):
            left, right = right, (left + (_round(right, key, n) % np.uint64(side)).astype(np.int64)) % side
        return left * side + right

    return _walk(np.asarray(numbers, np.int64), rows, step)


def inverse(places: np.ndarray, rows: int, key: int) -> np.ndarray:
    """The row numbers in places: permute undone."""
    side = _side(rows)

    def step(x: np.ndarray) -> np.ndarray:
        left, right = x // side, x % side
        for n in reversed(range(ROUNDS)):
            left, right = (right - (_round(left, key, n) % np.uint64(side)).astype(np.int64)) % side, left
        return left * side + right

    return _walk(np.asarray(places, np.int64), rows, step)


def numbered(df: DataFrame, order: list[str], to: str = "row_number") -> tuple[DataFrame, int]:
    """Adds gapless numbers from 0 in the order of ``order``, and gives the number of rows."""
    tie, part, within, of, first = (fresh(df, name) for name in ("_tie", "_part", "_in_part", "_of", "_first"))
    marked = df.withColumn(tie, F.xxhash64(F.monotonically_increasing_id()))
    ranged = marked.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie)
    placed = checkpointed(ranged.select(*df.columns, F.spark_partition_id().alias(part), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(within)))
    starts, before = [], 0
    for r in sorted(placed.groupBy(part).agg(F.count("*").alias("n")).collect()):  # a row for each partition
        starts.append((r[part], before))
        before += r["n"]
    base = df.sparkSession.createDataFrame(starts, f"{of} int, {first} bigint")
    joined = placed.join(F.broadcast(base), F.col(part) == F.col(of))
    return joined.select(*df.columns, (F.col(first) + F.col(within)).alias(to)), before


def place(number: Column, rows: int, key: int) -> Column:
    @F.pandas_udf("long")
    def at(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), rows, key))

    return at(number)


def sharded(df: DataFrame, order: list[str], shards: int, key: int = 2024) -> tuple[DataFrame, list[str]]:
    """Adds the row's number, place, shard and slot; the names of the four are fresh ones, given beside."""
    names = [fresh(df, name) for name in ("row_number", "place", "shard", "slot")]
    number, at, shard, slot = names
    rows, count = numbered(df, order, number)
    rows = rows.withColumn(at, place(F.col(number), max(count, 1), key))
    rows = rows.withColumn(shard, (F.col(at) % shards).cast("int")).withColumn(slot, F.call_function("div", F.col(at), F.lit(shards)))
    return rows, names


def shard_documents(docs: DataFrame, shards: int = 40, key: int = 2024) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law isn't ``key``), row_number, place."""
    narrow = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    placed, _ = sharded(narrow, ["doc_id", "size", "text_crc32"], shards, key)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number", "place")
