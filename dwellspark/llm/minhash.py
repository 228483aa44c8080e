"""Near duplicates by MinHash: universal hash minima, banding, signature verification, exact confirmation, components.

A document is the set of its distinct word shingles.  Documents with the same set are one node.  BANDS * ROWS minima of
universal hashes make a node's signature; nodes whose signatures agree on all rows of a band meet in a bucket.  Two
documents are linked if the Jaccard similarity of their full sets is at least ``percent`` / 100, which is confirmed on
the sets themselves; components come from alternating large-star and small-star steps over the links.

No bucket is ever expanded into all its pairs.  First every bucket's smallest node and its largest are
compared with its other nodes (two stars), and components are formed.  Members of one component need no further comparison,
so what remains are pairs across components of a bucket: they are compared in blocks of BLOCK rows inside tasks, first
by signature, then on full sets, and only links that join components come out.  That step has no cap, so a bucket of
any size gives all the links that its components need.  It holds 32 bits of each item, and every link it gives is
confirmed on all 64; if one falls through, which needs items that agree by accident, the step is done again on 64 bits
from the components reached, so a link that was passed over because of the false one is not lost.

With 5 rows and 30 bands a pair at exactly 0.8 meets in some bucket with probability 1 - 7e-6.

Defined cases: null text, empty text and text of white space have the empty set and are linked with nothing; a text
with fewer words than a shingle has its whole sequence as one shingle; rows with equal ids are one document, linked by
any of their texts; rows with a null id stay alone, with a null component, and are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fresh, sliced

BANDS, ROWS = 30, 5
PERCENT = 80
#: Signatures this many standard deviations below the threshold are still confirmed on the sets.
DEVIATIONS = 4.5
#: Rows of a bucket that one task compares with as many others, and pairs of one node that one task confirms.
BLOCK, CHUNK = 1024, 1000

_rng = np.random.default_rng(6)
_MULTIPLY = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2)
_BYTES = _rng.integers(1, 2**63, 256, np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_GAPS = np.zeros(256, bool)
_GAPS[[32, 9, 10, 11, 12, 13]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of the text, A-Z taken as a-z."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    inside = ~_GAPS[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    powers = np.power(_STEP, np.arange(int(size.max()), dtype=np.uint64))
    return _mixed(np.add.reduceat(_BYTES[data[inside]] * powers[within], np.cumsum(size) - size) + size.astype(np.uint64))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted hashes of the text's distinct shingles."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    total = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        total = _mixed(total) + words[k : len(words) - width + 1 + k]
    return np.unique(_mixed(total))


def minima(found: np.ndarray) -> np.ndarray:
    """The signature: the smallest value of each universal hash, its upper 32 bits."""
    best = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(found), 1024):
        best = np.minimum(best, (_MULTIPLY[:, None] * found[None, at : at + 1024] + _ADD[:, None]).min(axis=1))
    return (best >> np.uint64(32)).astype(np.uint32)


def band_values(signatures: np.ndarray) -> np.ndarray:
    """The bucket of each band (rows, BANDS) for signatures (rows, BANDS * ROWS); no two bands share buckets."""
    rows = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    value = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for k in range(ROWS):
        value = _mixed(value * _STEP + rows[:, :, k])
    return value.view(np.int64)


def bucketed(nodes: DataFrame) -> DataFrame:
    """(node, value): a row for each node and band."""

    def run(batches):
        for batch in sliced(batches):
            if batch.num_rows:
                values = band_values(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(values)), BANDS))), pa.array(values.ravel())], names=["node", "value"])

    return nodes.select("node", "signature").mapInArrow(run, "node bigint, value bigint")


def features(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, k1 and k2 (which name the set), signature (16 bits of each minimum)."""
    schema = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingles(text, width)
                k1, k2 = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64).tolist()
                signature = minima(found) if len(found) else None
                out.append((doc_id, len(found), k1, k2, None if signature is None else (signature & 0xFFFF).astype(np.uint16).tobytes()))
            columns = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_shingles", "k1", "k2", "signature"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BANDS * ROWS)


def least_agreement(percent: int) -> int:
    """Minima that must agree for a pair to be confirmed on the sets."""
    t, k = percent / 100, BANDS * ROWS
    return int(k * t - DEVIATIONS * (k * t * (1 - t)) ** 0.5)


def verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree well enough."""
    least = least_agreement(percent)
    signed = nodes.select("node", "signature")
    both = pairs.join(signed.toDF("a", "sa"), "a").join(signed.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in sliced(batches, 4096):
            if batch.num_rows:
                good = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1) >= least
                yield batch.select([0, 1]).filter(pa.array(good))

    return both.mapInArrow(run, "a bigint, b bigint").distinct()


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have at least the Jaccard similarity percent / 100."""
    if not len(one) or not len(other) or 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
        return False
    both = np.sort(np.concatenate([one, other]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(one) + len(other) - common)


def full_sets(docs: DataFrame, nodes: DataFrame, width: int, repeated: bool) -> DataFrame:
    """(node, items): the full sets of the nodes, each once also where ids are ``repeated``."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text").join(nodes.select(F.col("node").alias("wanted")).distinct(), F.col("node") == F.col("wanted")).select("node", "text")

    def run(batches):
        for batch in sliced(batches):
            items = [shingles(t, width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.binary())], names=["node", "items"])

    sets = texts.mapInArrow(run, "node bigint, items binary")
    return sets.distinct() if repeated else sets


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough.

    A node's set is held for up to CHUNK of its pairs, ahead of the sets of the other nodes, which stream by.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    first = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    first = first.join(sets, first["a"] == sets["node"]).select("a", "chunk", F.lit(None).cast("bigint").alias("b"), "items")
    dealt = pairs.join(counts.select(F.col("a").bitwiseXOR(F.lit(1)).alias("key"), "chunks"), F.col("a").bitwiseXOR(F.lit(1)) == F.col("key"))
    dealt = dealt.select("a", F.pmod(F.xxhash64("b"), "chunks").cast("int").alias("chunk"), "b")
    rest = dealt.join(sets, dealt["b"] == sets["node"]).select("a", "chunk", "b", "items")
    rows = first.union(rest).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches):
        at, held = None, []
        for batch in sliced(batches, 256):
            out = []
            for a, chunk, b, items in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at != (a, chunk):
                    at, held = (a, chunk), []
                own = np.frombuffer(items, np.uint64)
                if b is None:
                    held.append(own)
                elif any(similar(own, other, percent) for other in held):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes that have links, component being the smallest node reachable.

    Alternates large-star (a node's larger neighbours go to its smallest) and small-star (its smaller neighbours and
    itself go to the smallest) until every component is a star; edges are cut from their history in the shared folder
    each time.
    """

    def least(edges: DataFrame) -> DataFrame:
        """(u, v, m): the edges with the smallest of u and its neighbours; the key is masked so that a hub can be split."""
        best = edges.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").bitwiseXOR(F.lit(1)).alias("key"), F.least("u", "low").alias("m"))
        return edges.join(best, F.col("u").bitwiseXOR(F.lit(1)) == F.col("key")).select("u", "v", "m")

    edges = checkpointed(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while True:
        large = least(edges.union(edges.select("v", "u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = least(large).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        edges = checkpointed(small.where("u != v").distinct())
        # stars are reached when each node hangs on one other, which hangs on none
        ends = edges.select("u", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(edges.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("u").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or hangs = 1 and holds = 1").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _compact(bits: int):
    """Signatures cut to 8 bits a minimum and sets to ``bits`` (32 or 64) an item, for the rows dealt to many tasks."""

    def run(batches):
        for batch in sliced(batches):
            signatures = [np.frombuffer(x, np.uint16).astype(np.uint8).tobytes() for x in batch.column(1).to_pylist()]
            items = batch.column(2).to_pylist()
            if bits == 32:
                items = [_cut(np.frombuffer(x, np.uint64)).tobytes() for x in items]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signatures, pa.binary()), pa.array(items, pa.binary())], names=["of", "signature", "items"])

    return run


def _cut(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(32)).astype(np.uint32)


def _dealt(buckets: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(value, i, j, side, node, component): the nodes of buckets that hold several components, for each pair of blocks they are in.

    ``held`` (of, and more columns) is what goes along with the nodes.  Buckets of the same nodes are taken once.  A bucket's largest component meets only the others, not itself, so where
    few nodes are left beside it, what is dealt grows with the bucket.
    """
    mixed = buckets.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("print")).where("lo != hi")
    mixed = mixed.groupBy("n", "print").agg(F.min("value").alias("one")).select(F.col("one").bitwiseXOR(F.lit(1)).alias("key"))
    rows = checkpointed(buckets.join(mixed, F.col("value").bitwiseXOR(F.lit(1)) == F.col("key")).select("value", "node", "component"))
    parts = rows.groupBy("value", "component").agg(F.count("*").alias("n")).groupBy("value").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"))
    counted = lambda n: F.ceil(n / BLOCK).cast("int")
    parts = parts.select(F.col("value").bitwiseXOR(F.lit(1)).alias("key"), F.col("most.component").alias("largest"), counted(F.col("most.n")).alias("blocks"), counted(F.col("n") - F.col("most.n")).alias("rest"))
    rows = rows.join(parts, F.col("value").bitwiseXOR(F.lit(1)) == F.col("key")).select("value", "node", "component", "blocks", "rest", (F.col("component") == F.col("largest")).alias("large"))
    if held is not None:
        rows = rows.join(held, F.col("node") == F.col("of")).drop("of")
    # blocks of the largest component are numbered below 0 and meet only blocks of the rest, which also meet each other
    own = F.when(F.col("large"), -1 - F.pmod(F.xxhash64("node"), "blocks")).otherwise(F.pmod(F.xxhash64("node"), "rest")).cast("int")
    others = F.sequence(F.when(F.col("large"), F.lit(0)).otherwise(-F.col("blocks")), F.col("rest") - 1)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    return rows.select("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "component", *([] if held is None else held.columns[1:]))


def _across(buckets: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, bits: int = 32) -> DataFrame:
    """Pairs of nodes of different components (column ``component``) that share a bucket; enough to join them.

    A task holds up to BLOCK rows of a bucket beside as many others, compares full sets (by ``bits`` of each hash) where
    signatures agree, and gives no second pair between nodes that it has joined already.
    """
    least = least_agreement(percent)
    held = sets.join(nodes.select(F.col("node").alias("signed"), "signature"), F.col("node") == F.col("signed")).select(F.col("node").alias("of"), "signature", "items")
    rows = _dealt(buckets, held.mapInArrow(_compact(bits), "of bigint, signature binary, items binary"))
    rows = rows.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")

    def compare(group: list[tuple]) -> list[tuple[int, int]]:
        side, node, component = (np.array([g[k] for g in group]) for k in (3, 4, 5))
        matrix = np.frombuffer(b"".join([g[6] for g in group]), np.uint8).reshape(-1, BANDS * ROWS)
        items = [np.frombuffer(g[7], np.uint32 if bits == 32 else np.uint64) for g in group]
        size, out, joined, within = np.array([len(x) for x in items]), [], component.copy(), group[0][1] == group[0][2]
        for k in range(len(group)):
            others = np.arange(k + 1, len(group)) if within else np.flatnonzero(side == 1) if side[k] == 0 else ()
            if not len(others):
                continue
            others = others[(joined[others] != joined[k]) & (100 * np.minimum(size[others], size[k]) >= percent * np.maximum(size[others], size[k]))]
            agree = (matrix[others] == matrix[k]).sum(axis=1)
            for o in others[np.argsort(-agree, kind="stable")][: int((agree >= least).sum())]:
                if joined[o] != joined[k] and similar(items[k], items[o], percent):
                    joined[joined == joined[o]] = joined[k]
                    out.append((int(min(node[k], node[o])), int(max(node[k], node[o]))))
        return out

    def batch_of(out: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def run(batches):
        group: list[tuple] = []
        for batch in sliced(batches, 256):
            for row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if group and group[0][:3] != row[:3]:
                    yield batch_of(compare(group))
                    group = []
                group.append(row)
        if group:
            yield batch_of(compare(group))

    return rows.mapInArrow(run, "a bigint, b bigint").where("a != b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable, itself included) and kept of every document."""
    found = checkpointed(features(docs, width))
    linkable = found.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    nodes = linkable.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "signature")).alias("least"))
    nodes = checkpointed(nodes.select("k1", "k2", F.col("least.doc_id").alias("node"), "least.signature"))
    banded = bucketed(nodes)
    shared = banded.groupBy("value").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high")).where("n > 1")
    shared = shared.select(F.col("value").bitwiseXOR(F.lit(1)).alias("key"), "low", "high")
    buckets = checkpointed(banded.join(shared, F.col("value").bitwiseXOR(F.lit(1)) == F.col("key")).select("value", "node", "low", "high"))
    star = buckets.select(F.col("node").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a != b").select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).distinct()
    same_set = linkable.join(nodes.select(F.col("k1").bitwiseXOR(F.lit(1)).alias("key"), F.col("k2").alias("key2"), "node"), (F.col("k1").bitwiseXOR(F.lit(1)) == F.col("key")) & (F.col("k2") == F.col("key2"))).select(F.col("node").alias("a"), F.col("doc_id").alias("b")).where("a != b").distinct()
    repeated = not linkable.groupBy("doc_id").count().where("count > 1").isEmpty()
    sets = checkpointed(full_sets(docs, buckets.select("node"), width, repeated))
    links = checkpointed(confirmed(checkpointed(verified(star, nodes, percent)), sets, percent))
    reached = checkpointed(components(links))
    for bits in (32, 64):
        grouped = checkpointed(buckets.select("value", "node").join(reached, "node", "left").select("value", "node", F.coalesce("component", "node").alias("component")))
        told = checkpointed(_across(grouped, nodes, sets, percent, bits))
        more = checkpointed(confirmed(told, sets, percent))
        if bits == 64 or told.count() == more.count():
            break
        reached = checkpointed(components(reached.union(more), "node", "component"))
    reached = components(reached.union(more).union(same_set), "node", "component")
    reached = reached.select(F.col("node").alias("key"), "component")
    out = found.join(reached, F.col("doc_id") == F.col("key"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns of ``docs``.

    Of rows that share an id one stays; rows with a null id all stay.
    """
    flag, key = fresh(docs, "_rows"), fresh(docs, "_key")
    found = near_duplicates(docs.select("doc_id", "text"), width, percent).where("doc_id is not null")
    told = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).where("n > 1 or not kept").select(F.col("doc_id").alias(key), F.when(F.col("kept"), F.col("n")).otherwise(0).alias(flag))
    told = checkpointed(told)
    marked = docs.join(told, F.col("doc_id") == F.col(key), "left").drop(key)
    once = marked.where(F.col(flag).isNull())
    return once.union(marked.where(F.col(flag) > 1).dropDuplicates(["doc_id"])).drop(flag)
