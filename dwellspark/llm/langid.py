"""Language identification with hyperdimensional profiles.

Every letter (and combining mark) of any script, and the gap between words, has a random vector of +1 and -1 of its
own, drawn from its code point, the same for both cases.  A trigram is bound from its letters' vectors, each permuted
(rotated) by its place and multiplied; a text bundles (sums) its trigrams; a language prototype bundles the texts of
that language.  A document gets the language of the prototype with the largest cosine.

Since bundling is a sum, prototypes are added up partition by partition, so learning reads all labelled rows and moves
one vector for each language and partition.  Prototypes are a matrix of (languages x DIMENSIONS) numbers, 4 KB for each
language, which the driver and the workers hold.  Workers bind the trigrams they meet and keep KNOWN of them at most.

Whether a text is in any learned language: unrelated texts reach cosines below CHANCE, but so do very short texts in a
language.  So every labelled row is compared with the prototypes without its own part, and sizes of texts (powers of
two of their trigrams) at which those rows don't stand out from CHANCE are left undecided: such texts are kept.

Defined cases: null text, empty text and text without a letter (marks alone are none) get ``und`` and score 0; with
nothing to learn from, every text gets ``und``; equal cosines go to the first language in alphabetical order; repeated
rows count each time.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, sliced

DIMENSIONS = 512
UNKNOWN = "und"
#: Bound trigrams that a worker keeps, 512 bytes each; it begins anew beyond.
KNOWN = 60_000
#: Cosines with an unrelated prototype deviate by DIMENSIONS ** -0.5; under four deviations a text looks like chance.
CHANCE = 4 / DIMENSIONS**0.5
#: A size is decided by the cosine if it has so many labelled rows, of which no more than this share is under CHANCE.
SIZE_ROWS, SIZE_SHARE = 20, 0.01
SIZES = 64
_POINT = 21


def letter_symbols() -> np.ndarray:
    """The symbol of every code point: 0 for what is neither letter nor mark, else the code point in lower case."""
    symbols = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        if (char := chr(point)).isalpha():
            symbols[point] = ord(char.lower()[0])
        elif unicodedata.category(char)[0] == "M":
            symbols[point] = point
    return symbols


def letter_vectors(symbols: np.ndarray, seed: int = 20) -> np.ndarray:
    """(symbols, DIMENSIONS) of +1 and -1, drawn from the symbols alone."""
    x = symbols.astype(np.uint64)[:, None] * np.uint64(DIMENSIONS // 64) + np.arange(DIMENSIONS // 64, dtype=np.uint64) + np.uint64(seed << 40)
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return 1 - 2 * np.unpackbits((x ^ (x >> np.uint64(31))).view(np.uint8), axis=1).astype(np.int8)


def bound_vectors(trigrams: np.ndarray) -> np.ndarray:
    """The bound vectors (trigrams, DIMENSIONS) of +1 and -1."""
    places = [(trigrams >> (_POINT * k)) & ((1 << _POINT) - 1) for k in (2, 1, 0)]
    letters, at = np.unique(np.concatenate(places), return_inverse=True)
    vectors, at = letter_vectors(letters), at.reshape(3, -1)
    return np.roll(vectors, 2, axis=1)[at[0]] * np.roll(vectors, 1, axis=1)[at[1]] * vectors[at[2]]


def trigrams_of(text: str | None, symbols: np.ndarray) -> np.ndarray | None:
    """The text's trigrams, three symbols in one number each; None if it has no letter."""
    points = symbols[np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)]
    if not points.any() or not any(map(str.isalpha, text)):
        return None
    gap = points == 0
    points = np.concatenate([[0], points[~(gap & np.concatenate([[True], gap[:-1]]))], [0]]).astype(np.int64)
    return points[:-2] << (2 * _POINT) | points[1:-1] << _POINT | points[2:]


class Bundler:
    """Bundles of texts, keeping the bound trigrams it has met."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self._forget()

    def _forget(self) -> None:
        self.keys, self.rows, self.bound, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((4096, DIMENSIONS), np.int8), 0

    def counted(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Each text's distinct trigrams and how often they occur; None if it has no letter."""
        return [None if (found := trigrams_of(t, self.symbols)) is None else np.unique(found, return_counts=True) for t in texts]

    def learn(self, counted: list) -> None:
        """Binds the trigrams of counted texts that aren't known yet."""
        met = [c[0] for c in counted if c is not None]
        new = np.setdiff1d(np.unique(np.concatenate(met)), self.keys, assume_unique=True) if met else self.keys[:0]
        if len(self.keys) + len(new) > KNOWN:
            self._forget()
            new = np.unique(np.concatenate(met))
        if not 0 < len(new) <= KNOWN:
            return
        if self.used + len(new) > len(self.bound):
            more = np.zeros((max(self.used + len(new), min(2 * len(self.bound), KNOWN)), DIMENSIONS), np.int8)
            more[: self.used] = self.bound[: self.used]
            self.bound = more
        self.bound[self.used : self.used + len(new)] = bound_vectors(new)
        rows = np.concatenate([self.rows, np.arange(self.used, self.used + len(new))])
        self.used += len(new)
        self.keys = np.concatenate([self.keys, new])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.rows = self.keys[order], rows[order]

    def vector(self, which: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The bundle of counted trigrams; they are bound on the spot where they were too many to keep."""
        at, out = np.searchsorted(self.keys, which), 0
        kept = len(self.keys) > 0 and at[-1] < len(self.keys) and bool((self.keys[at] == which).all())
        for k in range(0, len(which), 4096):
            bound = self.bound[self.rows[at[k : k + 4096]]] if kept else bound_vectors(which[k : k + 4096])
            out = out + counts[k : k + 4096].astype(np.float32) @ bound.astype(np.float32)
        return out

    def vectors(self, texts: list[str | None]):
        """(number of trigrams, bundled vector) of each text in turn; None for one without a letter."""
        counted = self.counted(texts)
        self.learn(counted)
        for found in counted:
            yield None if found is None else (int(found[1].sum()), self.vector(*found))


def _labelled(docs: DataFrame, label: str, text_col: str, where: Column | None) -> DataFrame:
    rows = docs.where(F.col(label).isNotNull() & F.col(text_col).isNotNull())
    return (rows if where is None else rows.where(where)).select(label, text_col)


def scaled(sums: np.ndarray) -> np.ndarray:
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def learn(docs: DataFrame, label: str = "lang", text_col: str = "text", where: Column | None = None) -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and their prototypes scaled to length 1, from all rows with a label where ``where`` holds."""
    langs, sums = bundles(docs, label, text_col, where)
    return langs, scaled(sums)


def bundles(docs: DataFrame, label: str = "lang", text_col: str = "text", where: Column | None = None) -> tuple[list[str], np.ndarray]:
    """As learn, but the bundled sums themselves."""
    rows = _labelled(docs, label, text_col, where)
    shared = docs.sparkSession.sparkContext.broadcast(letter_symbols())

    def bundle(batches):
        bundler, sums = Bundler(shared.value), {}
        for batch in sliced(batches, 128):
            found: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (trigrams := trigrams_of(text, bundler.symbols)) is not None:
                    found.setdefault(lang, []).append(trigrams)
            counted = {lang: np.unique(np.concatenate(t), return_counts=True) for lang, t in found.items()}
            bundler.learn(list(counted.values()))
            for lang, (which, counts) in counted.items():
                sums[lang] = sums.get(lang, 0) + bundler.vector(which, counts).astype(np.float64)
        if sums:
            vectors = [v.tolist() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(vectors, pa.list_(pa.float64()))], names=["lang", "vector"])

    parts = rows.mapInArrow(bundle, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    vectors = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("vector"))
    learned = sorted((row["lang"], row["vector"]) for row in vectors.collect())
    return [k for k, _ in learned], np.array([v for _, v in learned]).reshape(-1, DIMENSIONS)


def decided_sizes(docs: DataFrame, bundled: tuple[list[str], np.ndarray], label: str = "lang", text_col: str = "text", where: Column | None = None) -> list[bool]:
    """For every size of texts, whether the cosine decides: a size with too few labelled rows goes with the next smaller one."""
    if not bundled[0]:
        return [False] * SIZES
    shared = docs.sparkSession.sparkContext.broadcast((*bundled, letter_symbols()))

    def compare(batches):
        langs, sums, symbols = shared.value
        at, prototypes, bundler = {k: i for i, k in enumerate(langs)}, scaled(sums), Bundler(symbols)
        rows, under = np.zeros(SIZES, np.int64), np.zeros(SIZES, np.int64)
        for batch in sliced(batches):
            for lang, found in zip(batch.column(0).to_pylist(), bundler.vectors(batch.column(1).to_pylist()), strict=True):
                if found is None:
                    continue
                others = sums[at[lang]] - found[1]
                if not (apart := np.linalg.norm(others)):  # the only text of its language tells nothing
                    continue
                length = max(float(np.linalg.norm(found[1])), 1e-12)
                cosines = prototypes @ found[1] / length
                cosines[at[lang]] = others @ found[1] / apart / length
                size = found[0].bit_length()
                rows[size] += 1
                under[size] += cosines.max() < CHANCE
        yield pa.RecordBatch.from_arrays([pa.array(range(SIZES), pa.int32()), pa.array(rows), pa.array(under)], names=["size", "n", "under"])

    counts = _labelled(docs, label, text_col, where).mapInArrow(compare, "size int, n bigint, under bigint").groupBy("size").agg(F.sum("n").alias("n"), F.sum("under").alias("under"))
    by_size, decided = {r["size"]: r for r in counts.collect()}, [False]
    for size in range(1, SIZES):
        r = by_size.get(size)
        decided.append(r["under"] <= SIZE_SHARE * r["n"] if r and r["n"] >= SIZE_ROWS else decided[-1])
    return decided


def in_language(docs: DataFrame, bundled: tuple[list[str], np.ndarray], decided: list[bool], keep: list[str], text_col: str = "text", to: str = "in_language") -> DataFrame:
    """Adds whether a text has letters and, where its size is decided, a cosine of CHANCE at least, to the columns ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast((scaled(bundled[1]), decided, letter_symbols()))

    def make():
        prototypes, decided, symbols = shared.value
        bundler = Bundler(symbols)

        def holds(found: tuple[int, np.ndarray] | None) -> bool:
            if found is None or not decided[found[0].bit_length()]:
                return found is not None
            return bool((prototypes @ found[1]).max() >= CHANCE * max(float(np.linalg.norm(found[1])), 1e-12))

        return lambda batch: [pa.array([holds(v) for v in bundler.vectors(batch.column(batch.schema.get_field_index(text_col)).to_pylist())], pa.bool_())]

    return map_texts(docs, make, keep, f"{to} boolean")


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str], text_col: str = "text", to: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds the predicted language and its score (the cosine, 0 at least) to the columns ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast((*model, letter_symbols()))

    def make():
        langs, prototypes, symbols = shared.value
        bundler = Bundler(symbols)

        def told(found: tuple[int, np.ndarray] | None) -> tuple[str, float]:
            if found is None or not langs:
                return UNKNOWN, 0.0
            cosines = prototypes @ found[1] / max(float(np.linalg.norm(found[1])), 1e-12)
            best = int(cosines.argmax())
            return langs[best], min(max(float(cosines[best]), 0.0), 1.0)

        def work(batch: pa.RecordBatch) -> list:
            out = [told(v) for v in bundler.vectors(batch.column(batch.schema.get_field_index(text_col)).to_pylist())]
            return [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())]

        return work

    return map_texts(docs, make, keep, f"{to[0]} string, {to[1]} double")
