"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed, shared_folder  # noqa: F401

#: Rows handed to the Python loops at once; keeps the Python copies of very long texts small.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, by whatever file system the folder's address names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_row(doc_id: str = "doc_id") -> Column:
    """True where the label of a document may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 != 0


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written to a table in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(rows: DataFrame, keys: list[str], size: Column, most: int, buckets: int = 512) -> Iterator[DataFrame]:
    """The rows in parts whose sizes add up to ``most``; only a single row, or rows equal in ``keys``, may go beyond.

    Rows are dealt into hash buckets, whose measured sizes alone reach the driver, and buckets are packed.
    """
    while True:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        sizes = rows.groupBy(bucket.alias("bucket")).agg(F.sum(size).alias("size"), F.countDistinct(F.struct(*keys)).alias("n")).collect()
        over = max((r["size"] for r in sizes if r["n"] > 1), default=0)
        if over <= most:
            break
        buckets *= 2 * (over // most + 1)
    parts: list[list[int]] = []
    room = 0
    for r in sorted(sizes, key=lambda r: -r["size"]):
        if not parts or r["size"] > room:
            parts.append([])
            room = most
        parts[-1].append(r["bucket"])
        room -= r["size"]
    for part in parts:
        yield rows.where(bucket.isin(part))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sliced(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]], keep: list[str], added: str) -> DataFrame:
    """Applies ``make()(batch)`` to Arrow slices of ``df`` and appends the columns it returns to the columns ``keep``.

    ``make`` runs once a task, so it can build tables.  ``added`` is the schema text of the new columns.
    """
    schema = ", ".join([*("`" + c.replace("`", "``") + f"` {t}" for c, t in df.dtypes if c in keep), added])
    ordered = [c for c in df.columns if c in keep]
    places = [i for i, c in enumerate(df.columns) if c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in sliced(batches):
            work = work or make()
            arrays = [batch.column(i) for i in places] + list(work(batch))
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))]).rename_columns(names)

    names = ordered + [f.split()[0] for f in added.split(", ")]
    # mapInArrow looks columns up by name, and a name with a dot or a backtick names something else there
    return df.toDF(*[f"__{i}" if set(".`") & set(c) else c for i, c in enumerate(df.columns)]).mapInArrow(run, schema)
