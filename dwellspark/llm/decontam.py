"""Benchmark decontamination by pigeonhole edit matching.

Test items and documents are reduced to lower-case words joined by single spaces.  An item is cut into units of
UNIT_CHARS to twice that many characters (a shorter item is one unit), and a unit with an error budget of k edits into
k + 1 pieces: if a document holds the unit within k edits, at least one piece stands in it unchanged.  One automaton
finds all pieces; around every hit Myers' bit-parallel algorithm computes the smallest edit distance of the unit to
any part of the text there, and the hit counts if that is within the budget.  A hit needs the unit's length and 3 k + 1
characters; k more are read on both sides, so hits whose starts differ by k at most lie within a window already read,
and only those are passed over.

One edit is allowed for CHARS_PER_EDIT characters, whatever the length.  A unit of fewer than WHOLE_CHARS characters has
to stand as whole words: it is compared with the spaces around it, which count like its letters.  In scripts that are
written without spaces any two characters may be the border of words.

Equal rows of items are read once.  Items are packed by their lengths into blocks of BLOCK_CHARS characters at most (a
longer item is a block of its own).  One block is one pass over the documents, with only that block in the driver and
the workers; what several passes find is written to the shared folder and joined to the documents by the digest of
their text.

Defined cases: null or empty documents match nothing, nor do items without a word; items with equal texts all match;
a repeated item is reported once; repeated documents match each for itself; null item ids are reported as null.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_texts, packed, stored

UNIT_CHARS = 80
#: One edit is allowed for so many characters of a unit; shorter units than the second have to stand as whole words.
CHARS_PER_EDIT, WHOLE_CHARS = 13, 24
BLOCK_CHARS = 2_000_000
LEAK = "array<struct<item_id:bigint,units:int,units_hit:int,distance:int>>"
_words = re.compile(r"[^\W_]+").findall
# Thai, Lao, Burmese and Khmer, and the scripts and signs from CJK radicals on, have no spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]").match


def normal(text: str | None) -> str:
    return " ".join(_words((text or "").lower()))


def units_of(text: str) -> list[str]:
    """The text's units; together they cover it."""
    count = max(1, len(text) // UNIT_CHARS)
    edges = [len(text) * i // count for i in range(count + 1)]
    return [text[a:b] for a, b in zip(edges, edges[1:], strict=False)] if text else []


def budget_of(unit: str) -> int:
    return len(unit) // CHARS_PER_EDIT


def bordered(unit: str) -> str:
    """A short unit with the spaces that have to be around it; a longer one as it is."""
    if len(unit) >= WHOLE_CHARS:
        return unit
    return ("" if _UNSPACED(unit[0]) else " ") + unit + ("" if _UNSPACED(unit[-1]) else " ")


def stands(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] begins and ends at borders of words."""
    return all(at in (0, len(text)) or any(c == " " or _UNSPACED(c) for c in text[at - 1 : at + 1]) for at in (start, end))


def pieces_of(unit: str) -> list[tuple[int, str]]:
    """Budget + 1 pieces (offset, piece) of nearly equal length that cover the unit."""
    count = budget_of(unit) + 1
    edges = [len(unit) * i // count for i in range(count + 1)]
    return [(a, unit[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def char_masks(unit: str) -> dict[str, int]:
    """For every character, the bits of its places in the unit."""
    masks: dict[str, int] = {}
    for i, char in enumerate(unit):
        masks[char] = masks.get(char, 0) | 1 << i
    return masks


def best_distance(masks: dict[str, int], size: int, text: str) -> int:
    """The smallest edit distance of a unit (its masks and size) to any substring of ``text``: Myers' bit vectors."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, distance, best = full, 0, size, size
    for char in text:
        match = masks.get(char, 0)
        across = (((match & up) + up) ^ up) | match | down
        plus, minus = down | (full & ~(across | up)), up & across
        if plus & top:
            distance += 1
        elif minus & top:
            distance -= 1
            best = min(best, distance)
        plus, minus = plus << 1, minus << 1
        vertical = match | down
        up, down = (minus | ~(vertical | plus)) & full, plus & vertical & full
    return best


class Matcher:
    """The units of a block of items, ready to be looked for."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(item_id, units) for item_id, text in items if (units := units_of(normal(text)))]
        self.units = [(n, unit, char_masks(bordered(unit))) for n, (_, units) in enumerate(self.items) for unit in units]
        places: dict[str, list[tuple[int, int]]] = {}
        for u, (_, unit, _) in enumerate(self.units):
            for offset, piece in pieces_of(unit):
                places.setdefault(piece, []).append((u, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.memo: dict[tuple[int, str], int] = {}

    def leaks(self, text: str | None) -> list[dict]:
        """The items that the text holds: number of units, units found, smallest distance of a found unit."""
        if not self.units or not (flat := normal(text)):
            return []
        found: dict[int, int] = {}
        tried: dict[int, list[int]] = {}  # by unit, sorted starts of the hits verified
        for end, (size, where) in self.automaton.iter(flat):
            for u, offset in where:
                _, unit, masks = self.units[u]
                if found.get(u) == 0:
                    continue
                if not (budget := budget_of(unit)):
                    if stands(flat, end + 1 - size, end + 1):
                        found[u] = 0
                    continue
                start = end + 1 - size - offset - budget
                starts = tried.setdefault(u, [])
                at = bisect_left(starts, start - budget)
                if at < len(starts) and starts[at] <= start + budget:
                    continue  # this hit's window lies within the one verified there
                starts.insert(at, start)
                whole = bordered(unit)
                part = flat[max(0, start - budget) : start + len(unit) + 4 * budget + 1]
                if whole != unit:  # with one character more on both sides; the text's ends are borders too
                    low, high = start - budget - 1, start + len(unit) + 4 * budget + 2
                    part = (" " if low < 0 else "") + flat[max(0, low) : high] + (" " if high > len(flat) else "")
                distance = self.memo.get((u, part))
                if distance is None:
                    if len(self.memo) > 20_000:
                        self.memo.clear()
                    distance = self.memo[u, part] = best_distance(masks, len(whole), part)
                if distance <= budget and distance < found.get(u, budget + 1):
                    found[u] = distance
        by_item: dict[int, list[int]] = {}
        for u, distance in found.items():
            by_item.setdefault(self.units[u][0], []).append(distance)
        return [{"item_id": self.items[n][0], "units": len(self.items[n][1]), "units_hit": len(d), "distance": min(d)} for n, d in sorted(by_item.items())]


_LEAK_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("units", pa.int32()), ("units_hit", pa.int32()), ("distance", pa.int32())]))


def _block_leaks(docs: DataFrame, shared, keep: list[str], to: str, text_col: str) -> DataFrame:
    """The leaks of one broadcast block of items."""

    def make():
        matcher = Matcher(shared.value)
        return lambda batch: [pa.array([matcher.leaks(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()], _LEAK_TYPE)]

    return map_texts(docs, make, keep, f"{to} {LEAK}")


def leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], to: str = "leaks", text_col: str = "text") -> DataFrame:
    """Adds the array ``to`` (see LEAK; empty for a clean document) to the columns ``keep`` of ``docs``."""
    items, context = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct(), docs.sparkSession.sparkContext
    blocks = list(packed(items, ["item_id", "text"], F.length("text"), BLOCK_CHARS))
    if len(blocks) < 2:
        return _block_leaks(docs, context.broadcast([tuple(r) for b in blocks for r in b.collect()]), keep, to, text_col)
    digest, found = F.sha2(F.col(text_col), 256), None
    texts = docs.select(digest.alias("digest"), F.col(text_col).alias("text")).where("text is not null")
    for block in blocks:
        shared = context.broadcast([tuple(r) for r in block.collect()])
        hits = stored(_block_leaks(texts, shared, ["digest"], "part", "text").where(F.size("part") > 0).groupBy("digest").agg(F.first("part").alias("part")))
        shared.destroy()
        found = hits if found is None else found.union(hits)
    key, own = fresh(docs, "_digest"), fresh(docs, "_leaks_of_text")
    found = found.select("digest", F.explode("part").alias("leak")).groupBy("digest").agg(F.array_sort(F.collect_list("leak")).alias("leaks"))
    joined = docs.join(found.toDF(key, own), digest == F.col(key), "left")
    return joined.select(*[F.col("`" + c.replace("`", "``") + "`") for c in keep], F.coalesce(own, F.array().cast(LEAK)).alias(to))
