"""How far the sources of a language differ in their use of its frequent words.

First pass: exact document frequencies of all terms by language; those in at least ``MIN_DOCS`` documents are kept.
Second pass: an automaton of the kept terms, each padded with a delimiter on both sides, runs over the texts, in which
everything between terms has become delimiters, and recounts occurrences; a document meets its own language's terms
only.  Terms are dealt into automata of at most ``BLOCK_CHARS`` characters, by measured sizes; there is one pass for each,
and nearly always one in all.  Tasks add their counts up before they hand them on.

The counts become postings: for each kept term the sources that have it.  Pairs of sources are compared term by term in
the tasks that hold the postings; a source without a posting has its smoothed share of nothing there, and terms that
neither source of a pair has are added up by their number.  All arithmetic is in whole numbers.

What grows with the number of sources: the groups (language, source) are known to the driver and to all tasks, and a
posting holds as many numbers at most as its language has sources.  The pairs that are asked for are the square of that.

Defined cases: null text, language and source are empty ones; a source without terms is a group like any other; a
language without kept terms has pairs of distance 0 and no terms; a language with one source has no pairs; repeated
rows count each; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, sliced, stored

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP_TERMS, SCALE, SMOOTH = 30, 50, 1_000_000_000, 5
#: Characters of kept terms in one automaton, and hash buckets of terms that are dealt whole.
BLOCK_CHARS, BUCKETS = 3_000_000, 512
#: Terms, and pairs of term and source, that a task adds up at once before it hands them on; sources of a block of pairs, and blocks held at once.
COUNTED, SOURCES, HELD = 500_000, 512, 16
_letters = string.ascii_letters.encode()
_clean = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _letters else 32 for b in range(256))


def cleaned(text: str | None) -> bytes:
    """The text's terms, lower-cased in A-Z, with spaces instead of what is between them."""
    return (text or "").encode("utf-8", "replace").translate(_clean)


def padded(text: str | None) -> str:
    return " " + cleaned(text).decode() + " "


def automaton_of(terms: list[tuple[str, int]]) -> ahocorasick.Automaton:
    """Finds whole terms in padded texts and tells their numbers."""
    found = ahocorasick.Automaton()
    for term, number in terms:
        found.add_word(f" {term} ", number)
    found.make_automaton()
    return found


def document_counts(docs: DataFrame, most: int = COUNTED) -> DataFrame:
    """lang, term, docs: in how many documents of the language each term is, added up by tasks, ``most`` terms at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, counts in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "term", "docs"])
            found.clear()

        for batch in sliced(batches):
            for text, lang in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                found[lang].update(set(cleaned(text).split()))
            if sum(map(len, found.values())) > most:
                yield from rows()
        yield from rows()

    return docs.select("text", "lang").mapInArrow(run, "lang string, term string, docs bigint")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term and number of the terms that at least ``min_docs`` documents of the language have."""
    often = document_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    return stored(often.select("lang", "term", F.monotonically_increasing_id().alias("number")))


def _blocks(kept: DataFrame) -> Iterator[dict[str, list[tuple[str, int]]]]:
    """The kept terms by language, BLOCK_CHARS characters at a time."""
    for part in packed(kept, ["lang", "term"], F.length("term") + 2, BLOCK_CHARS, BUCKETS):
        found = defaultdict(list)
        for r in part.collect():
            found[r["lang"]].append((r["term"], r["number"]))
        yield dict(found)


def recounted(docs: DataFrame, terms: dict[str, list[tuple[str, int]]], sources: dict[tuple[str, str], int], most: int = COUNTED) -> DataFrame:
    """number, source and count: occurrences of the terms in the documents of their languages, added up by tasks, ``most`` pairs at once."""
    shared = docs.sparkSession.sparkContext.broadcast((terms, sources))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (terms, sources), automata, numbers = shared.value, {}, {}
        keys, counts, size = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            key, inverse = np.unique(np.concatenate(keys), axis=0, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, inverse.ravel(), np.concatenate(counts))
            return key, total

        def rows(key: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key[:, 0]), pa.array(key[:, 1].astype(np.int32)), pa.array(total)], names=["number", "source", "count"])

        for batch in sliced(batches):
            found = defaultdict(list)
            for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if lang in terms:
                    if lang not in automata:
                        automata[lang] = automaton_of([(t, i) for i, (t, _) in enumerate(terms[lang])])
                        numbers[lang] = np.array([n for _, n in terms[lang]], np.int64)
                    found[lang, source] += [i for _, i in automata[lang].iter(padded(text))]
            for (lang, source), places in found.items():
                place, times = np.unique(np.array(places, np.int64), return_counts=True)
                keys.append(np.stack([numbers[lang][place], np.full(len(place), sources[lang, source], np.int64)], axis=1))
                counts.append(times)
                size += len(place)
            if size > 2 * most:
                key, total = summed()
                keys, counts, size = [key], [total], len(key)
                if size > most:
                    yield rows(key, total)
                    keys, counts, size = [], [], 0
        if size:
            yield rows(*summed())

    return docs.select("text", "lang", "source").where(F.col("lang").isin(*terms)).mapInArrow(run, "number bigint, source int, count bigint")


def share(count: np.ndarray, all_counts: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / (all_counts + SMOOTH * terms)), three digits at a time, so that nothing overflows."""
    under, rest, out = all_counts + SMOOTH * terms, np.asarray(count, np.int64) + SMOOTH, 0
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // under, rest * 1000 % under
    return out + 1


def pair_sums(postings: DataFrame, sizes: dict[str, list[int]], terms: dict[str, int], width: int = SOURCES) -> DataFrame:
    """lang, a, b, value: summed over terms, how much further apart sources a < b are than by terms that neither has.

    ``sizes`` are the counts of each language's sources, ``terms`` the numbers of kept terms; sources are compared in
    blocks of ``width``.
    """
    shared = postings.sparkSession.sparkContext.broadcast((sizes, terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (sizes, terms), held = shared.value, {}
        nothing = {lang: np.array([int(share(0, n, terms[lang])) for n in of]) for lang, of in sizes.items() if lang in terms}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, first, second), total in held.items():
                a, b = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array((a + first).astype(np.int32)), pa.array((b + second).astype(np.int32)), pa.array(total[a, b])], names=["lang", "a", "b", "value"])
            held.clear()

        for batch in sliced(batches):
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs.tolist()):
                some = batch.filter(pa.array(langs == lang))
                lists, counts = some.column(1), some.column(2).flatten().to_numpy()
                source, term = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                p = np.zeros(len(source), np.int64)
                for s in np.unique(source):
                    p[source == s] = share(counts[source == s], sizes[lang][s], terms[lang])
                table = {}
                for begin in range(0, len(sizes[lang]), width):
                    inside = (source >= begin) & (source < begin + width)
                    dense = np.repeat(nothing[lang][None, begin : begin + width], len(lists), axis=0)
                    dense[term[inside], source[inside] - begin] = p[inside]
                    table[begin] = dense
                    for other in range(0, begin + 1, width):
                        total = held.setdefault((lang, other, begin), np.zeros((table[other].shape[1], dense.shape[1]), np.int64))
                        for i in range(total.shape[0]):
                            low = i + 1 if other == begin else 0
                            apart = np.abs(table[other][:, i : i + 1] - dense[:, low:]) - np.abs(nothing[lang][other + i] - nothing[lang][begin + low : begin + width])
                            total[i, low:] += apart.sum(axis=0)
                        if len(held) > HELD:
                            yield from rows()
        yield from rows()

    return postings.select("lang", "sources", "counts").mapInArrow(run, "lang string, a int, b int, value bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: for each source its distance to every other of its language, and its own terms."""
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    groups = sorted((r["lang"], r["source"]) for r in docs.select("lang", "source").distinct().collect())
    named, sources = defaultdict(list), {}
    for lang, source in groups:
        sources[lang, source] = len(named[lang])
        named[lang].append(source)
    kept = kept_terms(docs, min_docs)
    counted = None
    for block in _blocks(kept):
        found = recounted(docs, block, sources)
        counted = found if counted is None else counted.unionByName(found)
    if counted is None:
        counted = spark.createDataFrame([], "number bigint, source int, count bigint")
    # one exchange by term serves the sums, the lists and the join with the terms
    each = counted.repartition("number").groupBy("number", "source").agg(F.sum("count").alias("count"))
    lists = each.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("source", "count"))).alias("found"), F.sum("count").alias("total"))
    postings = stored(kept.join(lists, "number").select("lang", "term", F.col("found.source").alias("sources"), F.col("found.count").alias("counts"), "total"))
    single = postings.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("f")).select("lang", "term", "total", F.col("f.sources").alias("no"), F.col("f.counts").alias("count"))
    terms = {r["lang"]: r["n"] for r in kept.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    sizes = {lang: [0] * len(of) for lang, of in named.items()}
    for r in single.groupBy("lang", "no").agg(F.sum("count").alias("n")).collect():  # a row for each group
        sizes[r["lang"]][r["no"]] = r["n"]
    facts = [(lang, s, no, n, sum(sizes[lang]), terms.get(lang, 0), int(share(0, n, terms[lang])) if lang in terms else 0) for lang, of in named.items() for no, (s, n) in enumerate(zip(of, sizes[lang], strict=True))]
    about = F.broadcast(spark.createDataFrame(facts, "lang string, source string, no int, n bigint, all bigint, terms bigint, nothing bigint"))

    share_of = lambda count, n: F.expr(f"1 + CAST({SCALE} AS DECIMAL(12, 0)) * CAST({count} + {SMOOTH} AS DECIMAL(20, 0)) div ({n} + {SMOOTH} * terms)")
    own = single.join(about, ["lang", "no"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (share_of("count", "n") - share_of("total", "`all`")).alias("value"))
    one = about.select("lang", "source", F.col("no").alias("a"), "nothing", "terms")
    two = about.select("lang", F.col("source").alias("item"), F.col("no").alias("b"), F.col("nothing").alias("other"))
    sums = pair_sums(postings, sizes, terms)
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")).withColumnRenamed("value", "more")
    pairs = one.join(two, "lang").where(F.col("a") != F.col("b")).join(both, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", (F.abs(F.col("nothing") - F.col("other")) * F.col("terms") + F.coalesce("more", F.lit(0))).alias("value"))
    in_order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    own = own.where(F.col("value") > 0).withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(in_order)).unionByName(own)
