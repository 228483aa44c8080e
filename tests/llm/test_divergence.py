"""Source divergence: against plain loops in whole numbers, and defined cases."""

import random
import re
from collections import Counter

import pytest

from dwellspark.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile(divergence.TERM)


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, min_docs=30, top=50):
    rows = [(t or "", lang or "", source or "") for _, t, lang, source, *_ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [(terms_of(t), source) for t, of, source in rows if of == lang]
        docs = Counter(w for words, _ in mine for w in set(words))
        kept = {w for w, n in docs.items() if n >= min_docs}
        count = {s: Counter() for _, s in mine}
        for words, s in mine:
            count[s].update(w for w in words if w in kept)
        whole = sum(count.values(), Counter())
        share = lambda c: {w: 1 + 1_000_000_000 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}  # noqa: B023, E731
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in count:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in count if o != s]
            own = [(p[s][w] - q[w], w) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", own)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def run(spark, rows, **kwargs):
    found = divergence.divergence(spark.createDataFrame(rows, SCHEMA), **kwargs)
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(tuple(r) for r in found.collect())


def corpus(n, sources, langs=("xx", "yy"), seed=1):
    rng = random.Random(seed)
    words = ["Ab", "aB", "cé", "É", "é", "zz9zz", "x-y", "the", "THE", "of", "naïve", "日本", "ab\tcd", "😀"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(n):
        s = rng.randrange(sources)
        text = rng.choice((" ", ", ", "1", "\n")).join(rng.choices(words[s % 5 :], k=rng.randrange(12)))
        rows.append((i, text, rng.choice(langs), f"s{s}"))
    return rows


def test_against_plain_loops(spark):
    rows = corpus(400, 7) + [(900, None, None, None), (901, "", "yy", None), (902, "only here", None, "lone"), (903, "the", "empty", "a"), (904, None, "empty", "b")] + [(905, "the the The", "xx", "s1")] * 3
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, min_docs=1, top=3) == plain(rows, 1, 3)
    assert run(spark, rows, min_docs=1000) == plain(rows, 1000)


def test_several_automata(spark, monkeypatch):
    rows = corpus(300, 4)
    monkeypatch.setattr(divergence, "BLOCK_CHARS", 9)
    monkeypatch.setattr(divergence, "BUCKETS", 2)
    assert run(spark, rows, min_docs=5) == plain(rows, 5)


def test_many_sources(spark):
    rows = [(i, f"common w{chr(97 + i % 26)} w{chr(97 + i % 7)}", "xx", f"s{i % 530:03}") for i in range(1100)]
    assert run(spark, rows, min_docs=3, top=2) == plain(rows, 3, 2)


def test_counts_are_handed_on_in_parts(spark):
    docs = spark.createDataFrame(corpus(200, 3, ("xx",)), SCHEMA)
    names = {("xx", f"s{i}"): i for i in range(3)}
    terms = {"xx": [(w, i) for i, w in enumerate(("the", "of", "é", "wa", "wb", "wc"))]}
    whole, parts = (sorted(tuple(r) for r in divergence.recounted(docs, terms, names, most).groupBy("number", "source").sum("count").collect()) for most in (10**6, 2))
    assert whole == parts and len(whole) == 18
    whole, parts = (sorted(tuple(r) for r in divergence.document_counts(docs, most).groupBy("lang", "term").sum("docs").collect()) for most in (10**6, 2))
    want = Counter(w for r in corpus(200, 3, ("xx",)) for w in set(terms_of(r[1])))
    assert whole == parts == sorted(("xx", w, n) for w, n in want.items())


def test_shares_are_exact_beyond_sixty_bits():
    for count, n, terms in ((0, 0, 1), (10**15, 9 * 10**15, 10**6), (7, 11, 3), (123_456_789_012_345, 123_456_789_012_346, 1)):
        assert int(divergence.share(count, n, terms)) == 1 + 1_000_000_000 * (count + 5) // (n + 5 * terms)


def test_terms_are_whole():
    found = divergence.automaton_of([("a", 1), ("ab", 2), ("b", 3), ("é", 4)])
    assert [n for _, n in found.iter(divergence.padded("A ab B,b\x00aéa É é aa"))] == [1, 2, 3, 3, 4]
    assert divergence.padded(None) == "  " and terms_of("A1b") == divergence.padded("A1b").split()


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_nothing_to_compare(spark, rows):
    assert run(spark, rows) == []


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(r[0], r[1], r[2], r[3], "x", 1) for r in corpus(90, 3)], SCHEMA + ", number string, `total.n` int")
    assert sorted(tuple(r) for r in divergence.divergence(docs, 5).collect()) == plain(corpus(90, 3), 5)
