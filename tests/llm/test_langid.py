"""The whole query of language ID against plain cosines: every letter, trigram, sum and argmax by loops."""

import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from dwellspark.llm import langid
from dwellspark.llm.queries import QUERIES


def symbols_of(text):
    out = [0]
    for char in text or "":
        point = ord(char.lower()[0]) if char.isalpha() else ord(char) if unicodedata.category(char)[0] == "M" else 0
        if point or out[-1]:
            out.append(point)
    return [*out, 0]


def plain(docs):
    """(doc_id, held out, language, cosine) of every document."""
    points = sorted({p for d in docs for p in symbols_of(d["text"])})
    letter = dict(zip(points, langid.letter_vectors(np.array(points)).astype(np.int64), strict=True))
    known = {}

    def bundle(text):
        s, total = symbols_of(text), np.zeros(langid.DIMENSIONS, np.int64)
        for key, n in Counter(zip(s, s[1:], s[2:], strict=False)).items():
            if key not in known:
                known[key] = np.roll(letter[key[0]], 2) * np.roll(letter[key[1]], 1) * letter[key[2]]
            total += n * known[key]
        return total

    bundles = [bundle(d["text"]) if any(map(str.isalpha, d["text"] or "")) else None for d in docs]
    held = [zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 for d in docs]
    sums = defaultdict(lambda: np.zeros(langid.DIMENSIONS, np.int64))
    for d, v, out in zip(docs, bundles, held, strict=True):
        if v is not None and d["lang"] is not None and not out:
            sums[d["lang"]] += v
    found = []
    for d, v, out in zip(docs, bundles, held, strict=True):
        cosines = [] if v is None else [(float(v @ sums[x] / np.linalg.norm(v) / np.linalg.norm(sums[x].astype(float))), x) for x in sorted(sums)]
        best = max(cosines, key=lambda c: c[0], default=(0.0, "und"))
        found.append((d["doc_id"], out, best[1], max(best[0], 0.0)))
    return found


def test_query_against_plain_cosines(spark, data, tmp_path):
    docs = pq.read_table(f"{data}/documents.parquet").to_pylist()
    extra = [(9001, None, "en"), (9002, "12 34", None), (9003, "́", "fr"), (9004, "Ünïcödé nаme 漢字", None), (9005, "x", "zz")]
    docs += [dict.fromkeys(docs[0]) | {"doc_id": i, "text": t, "lang": lang} for i, t, lang in extra]
    frame = spark.read.parquet(f"{data}/documents.parquet")
    spark.createDataFrame([tuple(d[c] for c in frame.columns) for d in docs], frame.schema).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    for doc_id, held, lang, cosine in plain(docs):
        r = got[doc_id]
        assert (r["held_out"], r["lang_pred"]) == (held, lang) and abs(r["score"] - min(cosine, 1.0)) < 1e-5, doc_id
