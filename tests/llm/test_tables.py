"""The registered corpus queries over the test tables: against SQL where there is some, else against plain versions."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

from dwellspark.llm import bpe, decontam, minhash
from dwellspark.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.01"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def documents(data):
    return pq.read_table(f"{data}/documents.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df, result = QUERIES[name](spark, data), con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())


def test_shards(spark, data, documents):
    rows = QUERIES["op3_feistel_shards"](spark, data).collect()
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == len(documents) and max(counts.values()) - min(counts.values()) <= 1 and {r["law"] for r in rows} == {"rows"}
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows) and all(r["slot"] < counts[r["shard"]] for r in rows)


def test_leaks(spark, data, documents):
    items = pq.read_table(f"{data}/benchmark.parquet").to_pylist()
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontamination"](spark, data).collect()}
    plain = {(d["doc_id"], i["item_id"]) for d in documents for i in items if decontam.normal(i["text"]) in decontam.normal(d["text"])}
    assert plain <= got and len(plain) > 1
    for doc_id, item_id in got - plain:  # not whole, but a unit within its budget
        flat = decontam.normal(next(d["text"] for d in documents if d["doc_id"] == doc_id))
        units = decontam.units_of(decontam.normal(next(i["text"] for i in items if i["item_id"] == item_id)))
        assert any(decontam.best_distance(decontam.char_masks(u), len(u), flat) <= decontam.budget_of(u) for u in units)


def test_toxicity(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, SMALL).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SMALL}/labels.parquet").to_pylist()}
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in labels) and all(r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    share, rank = {}, {}
    for held in (False, True):
        toxic, clean = ([rows[i]["score"] for i in labels if labels[i] == y and rows[i]["held_out"] == held] for y in (1, 0))
        share[held] = (np.mean(np.array(toxic) >= 0.5) + np.mean(np.array(clean) < 0.5)) / 2
        rank[held] = np.mean([(t > c) + (t == c) / 2 for t in toxic for c in clean])
    assert share[False] >= 0.9 and rank[False] >= 0.95  # 45 toxic texts
    assert share[True] >= 0.75 and rank[True] >= 0.75  # 6, of which 2 hold no word that the toxic texts learned from share


def test_languages(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, SMALL).collect()}
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    held = [d for d in docs if rows[d["doc_id"]]["held_out"]]
    assert len(rows) == len(docs) and sum(rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held) >= 0.98 * len(held)


def test_licences(spark, data, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op7_licences"](spark, data).collect()}
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for d in documents:
        found = words.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d["text"]))
        places = [i for p in ("cc by", "general public license", "all rights reserved") for i in range(len(found)) if found[i : i + len(p.split())] == p.split()]
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(found), len(places), min(places, default=None), max(places, default=None))


def test_bpe(spark, data, documents):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r["doc_id"]: r for r in QUERIES["op9_byte_bpe"](spark, data).collect()}
    for d in documents:
        ids = plain.encode_ordinary(d["text"])
        assert rows[d["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[d["doc_id"]]["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_pipeline(spark, data, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet").withColumnRenamed("source", "Score")
    docs = docs.union(spark.createDataFrame([(-1, None, None, "x", 0), (-2, "12 34", "en", "x", 5), (None, "the text of nobody in particular", "en", "x", 9)], docs.schema))
    kept = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, data).write.parquet(path := str(tmp_path / str(n)))
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert n == 4 or docs.columns == before.columns
        if name == "near_duplicates":
            sets = {}
            for r in before.collect():
                w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]))
                sets[r["doc_id"]] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
            parent = {i: i for i in sets}

            def root(x, parent=parent):
                while parent[x] != x:
                    x = parent[x]
                return x

            ids = sorted(i for i in sets if i is not None)
            for a in ids:
                for b in ids:
                    if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
            assert kept[name] == {i for i in sets if i is None or root(i) == i}
    assert not {-1, -2} & kept["language_id"] and None in kept["byte_bpe"]
    leaks = {r["doc_id"] for r in QUERIES["op4_decontamination"](spark, data).collect()}
    assert not leaks & kept["decontamination"] and kept["decontamination"] == kept["near_duplicates"] - leaks
    assert len(kept["toxicity"]) > 0.7 * len(kept["language_id"])
    empty = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, data).count() == 0


def test_signature_recall():
    """A pair at the threshold meets in a band almost surely, and its signatures pass verification."""
    t = minhash.PERCENT / 100
    assert (1 - t**minhash.ROWS) ** minhash.BANDS < 1e-5
    assert minhash.least_agreement(80) < 150 * t - 4 * (150 * t * (1 - t)) ** 0.5


@pytest.mark.parametrize("width", [2, 5])
def test_no_link_of_near_copies_is_lost(spark, width):
    """All pairs by exact similarity: from 0.8 on both are in one component; below, only through others."""
    con = duckdb.connect()
    pairs = con.execute(rf"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM '{SMALL}/documents.parquet'),
      s AS (SELECT doc_id, CASE WHEN len(ws) < {width} THEN [ws] ELSE list_distinct(list_transform(range(1, len(ws) - {width - 2}), lambda i: ws[i : i + {width - 1}])) END AS items FROM w),
      u AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s)
      SELECT a.doc_id, b.doc_id, count(*) AS common, any_value(a.n) + any_value(b.n) - count(*) AS whole FROM u a JOIN u b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL HAVING 10 * common >= 3 * whole""").fetchall()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    of = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, width=width).collect()}
    linked = [(a, b) for a, b, common, whole in pairs if 100 * common >= 80 * whole]
    assert len(linked) > 90 and all(of[a] == of[b] for a, b in linked)
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert all(of[i] == root(i) for i in of)


def test_ties_of_turns_are_ordered_alike(spark, tmp_path):
    """Rows of one conversation, turn and role are ordered by their rendered text, in the query and in its SQL."""
    texts = ["a", "a !", "a [/INST]", "a \\[x", "a \\", "", None, "a", "A [/INST] b", "é", "\\\\"]
    rows = [(1, 1, "user", t) for t in texts] + [(1, None, "user", "null turn"), (1, 0, None, "x"), (1, 1, "assistant", "y </s> z"), (1, 1, "tool", "q <</>> \\<")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    df, result = QUERIES["op1_chat_format"](spark, str(tmp_path)), con.execute(ORACLES["op1_chat_format"])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical([d[0] for d in result.description], result.fetchall())
