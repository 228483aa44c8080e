"""Periodic runs: against plain loops over all periods, and defined cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from dwellspark.llm import runs

SCHEMA = "doc_id bigint, text string"


def plain_runs(words, least=6, times=4):
    """All maximal stretches by every period, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, found):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def random_words(rng):
    words = []
    while len(words) < rng.choice((3, 20, 90, 300)):
        block = [rng.choice("abcd") for _ in range(rng.randint(1, rng.choice((2, 5, 20))))]
        words += block * rng.choice((1, 1, 3, 4, 5, 9)) + block[: rng.randint(0, len(block))]
    return words


def test_runs_are_those_of_plain_loops():
    rng = random.Random(3)
    for _ in range(60):
        texts = [random_words(rng) for _ in range(rng.randint(1, 9))] + [[]]
        for words, got in zip(texts, runs._searched(texts, 6, 4), strict=True):
            want = plain_runs(words)
            assert [tuple(r) for r in got.tolist()] == want
            assert runs.collapsed(words, got) == plain_collapsed(words, want)


@pytest.mark.parametrize(("least", "times"), [(2, 2), (6, 2), (9, 3), (30, 4)])
def test_other_lengths(least, times):
    rng = random.Random(least)
    for _ in range(30):
        words = random_words(rng)
        assert [tuple(r) for r in runs._searched([words], least, times)[0].tolist()] == plain_runs(words, least, times)


def test_candidates_in_many_parts(monkeypatch):
    monkeypatch.setattr(runs, "CANDIDATES", 7)
    rng = random.Random(9)
    for _ in range(20):
        words = random_words(rng)
        assert [tuple(r) for r in runs._searched([words, words], 6, 4)[1].tolist()] == plain_runs(words)


def test_one_period_throughout():
    words = list("abcde") * 4000
    assert runs._searched([words], 6, 4)[0].tolist() == [[0, 20_000, 5]]
    assert runs._searched([["a"] * 100_000], 6, 4)[0].tolist() == [[0, 100_000, 1]]
    assert runs._searched([[], []], 6, 4)[1].shape == (0, 3)


def test_prose_needs_few_levels():
    words = np.arange(50_000) % 30_000
    assert len(runs.names_of(np.arange(50_000), np.full(50_000, 50_000))) == 1
    assert len(runs.names_of(words, np.full(50_000, 50_000))) == 15  # 20,000 words occur twice in a row


def test_query_against_plain_loops(spark):
    rng = random.Random(5)
    texts = [None, "", " \n ", "a", "x " * 5, "x " * 6, "\ta b\r\na\x0bb\x0ca b\x1ca b a b ", "é é é é " * 4] + [rng.choice((" ", "\n", "  ")).join(random_words(rng)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, "r s " * 9), (7, texts[7]), (10**17, "u v w " * 30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in runs.digests(runs.find_runs(runs.with_planted_periods(docs, "text"), ["doc_id"])).collect()), key=str)
    want, changed = [], 0
    for doc_id, text in rows:
        before = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        words = planted(doc_id, before)
        changed += words != before
        found = plain_runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        facts = (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        text = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want.append((doc_id, *facts, *(hashlib.sha256(t.encode()).hexdigest() for t in (text, " ".join(plain_collapsed(words, found))))))
    assert got == sorted(want, key=str) and changed > 2


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 9, "x", 5)], "doc_id bigint, text string, Runs string, `_n.x` int")
    found = runs.find_runs(docs, ["doc_id", "Runs", "_n.x"]).toDF("doc_id", "other", "more", "runs", "collapsed").collect()
    kept = runs.with_planted_periods(docs.withColumnRenamed("Runs", "_words"), "text")
    assert kept.columns == ["doc_id", "text", "_words", "_n.x"] and kept.collect()[0]["_words"] == "x"
    assert found[0]["other"] == "x" and found[0]["collapsed"] == "a b" and found[0]["runs"][0]["period"] == 2
    assert runs.find_runs(docs.limit(0), ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(docs, ["doc_id"], times=1)
