"""From raw documents to token ids: language, toxicity, near copies, benchmark leaks, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.  Defined cases: null ids and null
texts pass through until a stage rejects them (the language stage rejects null texts, texts without a letter and texts
in no labelled language; without labels to learn from, it keeps all texts with letters); further columns of documents, whatever their names, are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.llm import bpe, decontam, langid, minhash, toxicity
from dwellspark.llm.common import fresh, stored, table, training_row
from dwellspark.session import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those whose cosine tells that they are in none of the labelled languages."""
    ship(spark)
    bundled = langid.bundles(docs, where=training_row())
    decided, known = langid.decided_sizes(docs, bundled, where=training_row()), fresh(docs, "_known")
    return langid.in_language(docs, bundled, decided, docs.columns, to=known).where(F.col(known)).select(*_same(docs))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the network scores 0.5 or more; none where there are no labels to train one."""
    ship(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    if isinstance(model, float):
        return docs
    score = fresh(docs, "_toxicity")
    return toxicity.score(docs, model, docs.columns, to=score).where(F.col(score) < 0.5).select(*_same(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: shingles of five words, similarity 0.8."""
    ship(spark)
    return minhash.without_near_duplicates(docs, width=5).select(*_same(docs))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a unit of a test item within its error budget."""
    ship(spark)
    leaks = fresh(docs, "_leaks")
    return decontam.leaks(docs, table(spark, sf_dir, "benchmark"), docs.columns, to=leaks).where(F.size(leaks) == 0).select(*_same(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens and the digests of ids and decoded bytes."""
    ship(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


def _same(docs: DataFrame) -> list:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


STAGES = [
    ("language_id", identify_language),
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode),
]
#: Trained models and exact merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
