"""History files of any size: one JSON object by listing id, cut at its top-level keys and read by as many tasks as it has splits.

Spark's text reader cuts a file at every closing brace, so rows never cross a split in the middle of a token.  Whether a
brace counts depends on all that stands before it (it may be inside a string), which a split can't know; but two cases
are all there are.  A first pass tells for each split and either case how quotes and depth change; adding that up in
order gives every split its true beginning.  The second pass gives the entries that lie within a split, and the pieces
of those that cross one, which are put together by a grouping.  The driver holds a few numbers for each split, as it
does for planning the scan.

An entry's text is parsed by itself, so one that breaks the schema is a bad record and the rest are read; values that
are no objects go with the next entry's text.  A file whose
quotes or braces don't close is given as one bad record, its address, and nothing is read from it.  A file without
anything in it is no record.  Of an id that a file has twice both entries are given.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import HISTORY_JSON

SUMMARY = "file string, start bigint, size bigint, bytes bigint, quotes int, depths array<int>, lows array<int>, blank boolean"
ENTRY = "file string, open bigint, block bigint, place bigint, whole boolean, text string"
#: The first entry of a split takes the split's number in its file times this for its place.
SPLIT = 1 << 32


def _outside(text: str) -> list[str]:
    """What stands between quotes, every other piece inside a string; escapes are gone."""
    return text.replace("\\\\", "").replace('\\"', "").split('"')


def _depth(pieces: list[str]) -> int:
    return sum(p.count("{") + p.count("[") - p.count("]") for p in pieces)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: bytes, parity of quotes, change and lowest depth if it begins outside or inside a string."""
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_()]
    at, row, done = None, None, []
    for batch in batches:
        for file, start, size, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if at != (file, start):
                at, row = (file, start), [file, start, size, 0, 0, [0, 0], [1 << 30, 1 << 30], False]
                done.append(row)
            pieces = _outside(text)
            row[3] += len(text.encode()) + 1
            for case in (0, 1):
                row[5][case] += _depth(pieces[(row[4] + case) % 2 :: 2])
            row[4] = (row[4] + len(pieces) - 1) % 2
            closing = row[4]  # the case in which the brace is outside
            row[5][closing] -= 1
            row[6][closing] = min(row[6][closing], row[5][closing])
            row[7] = not text.strip()
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names=names)


def _beginnings(summaries: list) -> tuple[dict, list[str]]:
    """For each split (file, start): its number in the file, whether it begins in a string, its depth, and the split in which an
    entry that is open at its beginning began; and the files that don't close."""
    begin, bad, by_file = {}, [], {}
    for r in summaries:
        by_file.setdefault(r["file"], []).append(r)
    for file, splits in by_file.items():
        inside, depth, opened = 0, 0, 0
        for number, r in enumerate(sorted(splits, key=lambda r: r["start"])):
            begin[file, r["start"]] = (number, inside, depth, opened)
            if depth <= 1 and not inside or depth + r["lows"][inside] <= 1:
                opened = number
            depth += r["depths"][inside]
            inside = (inside + r["quotes"]) % 2
        closed = sum(x["bytes"] for x in splits) <= r["size"]  # else the last row ends without a brace
        if inside or not (depth == 0 if closed else r["blank"] and depth == -1):
            bad.append(file)
            for x in splits:
                del begin[file, x["start"]]
    return begin, bad


def _entries(begin: dict):
    """The task that gives whole entries, and pieces of those that cross splits."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    names = [f.split()[0] for f in ENTRY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, inside, depth, opened, count, held, crossing = None, 0, 0, 0, 0, 0, [], False

        def rest() -> list[tuple]:
            """What is left at the end of a split."""
            if at is None or depth < 1 or not held:
                return []
            return [(at[0], opened if crossing else number, number, None if crossing else number * SPLIT + count, False, "".join(held))]

        for batch in batches:
            rows: list[tuple] = []
            for file, start, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (file, start) not in begin:
                    continue
                if at != (file, start):
                    rows += rest()
                    at, count, held = (file, start), 0, []
                    number, inside, depth, opened = begin[at]
                    crossing = depth > 1 or bool(inside)
                pieces = _outside(text)
                depth += _depth(pieces[inside::2])
                inside = (inside + len(pieces) - 1) % 2
                depth -= not inside
                held.append(text if depth < 1 and not inside else text + "}")
                if not inside and depth <= 1:
                    whole = "".join(held)
                    if crossing:
                        rows.append((file, opened, number, None, False, whole))
                    elif whole.strip(" \t\r\n,{"):
                        rows.append((file, number, number, number * SPLIT + count, True, whole))
                        count += 1
                    held, crossing = [], False
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
        last = rest()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in last], t) for i, t in enumerate(types)], names=names)

    return run


def history_entries(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """file, place, text of every entry of the files, and the files that can't be read.  Places grow within a file."""
    rows = spark.read.option("lineSep", "}").text(path).select("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_size", "value")
    begin, bad = _beginnings(rows.mapInArrow(_summaries, SUMMARY).collect())  # a row for each split
    shared = spark.sparkContext.broadcast(begin)
    found = rows.mapInArrow(lambda batches: _entries(shared.value)(batches), ENTRY)
    crossing = found.where("not whole").groupBy("file", "open").agg(F.max("place").alias("place"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("pieces"))
    joined = crossing.select("file", "place", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"))
    return found.where("whole").select("file", "place", "text").unionByName(joined), bad


def history_files(spark: SparkSession, path: str) -> DataFrame:
    """History files as snapshots; what can't be read is in ``bad_record``: an entry's text, or the address of a file.

    ``ordinal`` grows with the listing's place in its file, which is the order in which listings were first seen; it
    counts from 0 where the file is one split.
    """
    entries, bad = history_entries(spark, path)
    text = F.concat(F.lit("{"), F.regexp_replace("text", r"^[\s,{]*", ""), F.lit("}"))
    parsed = entries.select(text.alias("value"), F.col("place").alias("ordinal")).withColumn("history", F.from_json("value", HISTORY_JSON)).select("value", "ordinal", "history")
    broken = spark.createDataFrame([(b,) for b in bad], "value string").select("value", F.lit(None).cast("bigint").alias("ordinal"), F.from_json(F.lit(None).cast("string"), HISTORY_JSON).alias("history"))
    rows = parsed.unionByName(broken).select(F.when(F.col("history").isNull(), F.col("value")).alias("bad_record"), "ordinal", F.explode_outer("history").alias("id", "rec"))
    snaps = rows.select("bad_record", "id", "ordinal", F.col("rec.first_seen").try_cast("timestamp").alias("first_seen"), "rec.latest", F.posexplode_outer("rec.snapshots").alias("seq", "snap"))
    kept = ("url", "photo", "photos", "description", "sqm", "area", "title")
    return snaps.select(
        "bad_record", F.col("latest.portal").alias("portal"), "id", "ordinal", "first_seen",
        F.col("snap.seen_at").try_cast("timestamp").alias("seen_at"), F.col("seq").cast("bigint").alias("seq"), F.col("snap.price_eur").alias("price_eur"),
        *[F.col(f"latest.{c}").alias(c) for c in kept], F.col("latest.site_updated_at").try_cast("timestamp").alias("site_updated_at"),
    )
