"""Exact top-k search by MaxScore over integer vectors, in blocks.

The dimensions are the terms, and a candidate's component is its posting.  Candidates are traversed in steps of STEP;
in a step, the largest product a query can have with any posting of a dimension bounds that dimension's part of a
score, and all bounds together the whole score: a query whose bound is under its mark, the k-th best score so far,
passes the step over.  For the others the dimensions stand in the order of their mean bounds, and a query's last ones
are non-essential as long as their bounds add up to at most SLACK of its mark.  Only essential postings are traversed,
PANEL dimensions at a time for the queries that still need them; the other dimensions are probed only for candidates
whose part of the score plus the remaining bounds still reaches the mark.  Marks rise from step to step, and the lists
of all blocks are merged.  Ties go to the smaller id, also across blocks.

Queries and candidates are dealt by hash into blocks of about QUERIES and CANDIDATES rows (more, up to MOST_CANDIDATES,
where there are more than SPREAD blocks), and every query block meets every candidate block in a task of its own; the
query set is a stated share of the rows.

Defined cases: a vector that is null or holds a null or non-finite component takes no part (an empty one scores 0), nor do rows with a
null id; x is a double; scale * x beyond doubles counts as the largest double; vectors of different lengths are
compared on the dimensions they share; rows that share an id are candidates of their own, also for each other, and a
query each; components too large for exact doubles are multiplied as Python integers, and scores beyond 64 bits are
limited to 64 bits; a query without any candidate has no rows.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

QUERIES, CANDIDATES, MOST_CANDIDATES, SPREAD = 16_384, 8192, 65_536, 64
STEP, PANEL, SLACK = 512, 8, 0.5


class Best:
    """The k best (score, id) of every query so far, and its mark."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score, self.id = np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max)

    @property
    def mark(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(row)
        rows = np.concatenate([row, np.repeat(touched, self.k)])
        scores, ids = np.concatenate([score, self.score[touched].ravel()]), np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((ids, -scores, rows))
        rows = rows[order]
        first = np.searchsorted(rows, rows)
        good = np.arange(len(rows)) - first < self.k
        self.score[touched], self.id[touched] = scores[order][good].reshape(-1, self.k), ids[order][good].reshape(-1, self.k)


def _step(queries: np.ndarray, rows: np.ndarray, block: np.ndarray, block_rows: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Traverses one step of candidates; the number of multiplications."""
    width, mark = block.shape[1], best.mark
    bounds = np.maximum(queries * block.max(axis=0), queries * block.min(axis=0))
    order = np.argsort(-bounds.mean(axis=0), kind="stable")
    done = 2 * bounds.size
    live = np.flatnonzero(bounds.sum(axis=1) >= mark)
    bounds = bounds[live][:, order]
    tails = np.concatenate([np.cumsum(bounds[:, ::-1], axis=1)[:, ::-1], np.zeros((len(live), 1), bounds.dtype)], axis=1)
    positive = np.cumsum(np.maximum(bounds[:, ::-1], 0), axis=1)[:, ::-1]
    essential = (positive > SLACK * np.maximum(mark[live], 0)[:, None]).sum(axis=1)
    essential = np.minimum(-(-essential // PANEL) * PANEL, width)
    by_need = np.argsort(-essential, kind="stable")
    live, essential, tails = live[by_need], essential[by_need], tails[by_need]
    mark, asked, block = mark[live], queries[live][:, order], block[:, order]
    part = np.zeros((len(live), len(block)), queries.dtype)
    for at in range(0, width, PANEL):
        need = int((essential > at).sum())
        if not need:
            break
        part[:need] += asked[:need, at : at + PANEL] @ block[:, at : at + PANEL].T
        done += need * len(block) * min(PANEL, width - at)
    rest = tails[np.arange(len(live)), essential]
    place = {r: i for i, r in enumerate(block_rows.tolist())}
    own = [(i, place[r]) for i, r in enumerate(rows[live].tolist()) if r in place]
    if own:
        part[tuple(np.array(own).T)] = -np.inf
    floor = mark - rest
    if len(block) > best.k and (unknown := np.flatnonzero((mark == -np.inf) & (essential == width))).size:
        floor[unknown] = np.partition(part[unknown], -best.k, axis=1)[:, -best.k]
    row, col = np.nonzero((part >= floor[:, None]) & (part > -np.inf))
    score = part[row, col].astype(np.float64)
    for at in np.unique(essential[row]):
        if at < width:
            some = np.flatnonzero(essential[row] == at)
            for k in range(0, len(some), 100_000):
                few = some[k : k + 100_000]
                score[few] += np.einsum("ij,ij->i", block[col[few], at:], asked[row[few], at:])
            done += len(some) * (width - int(at))
    good = score >= mark[row]
    if good.any():
        best.add(live[row[good]], ids[col[good]], score[good])
    return done


def search(queries: np.ndarray, query_rows: np.ndarray, block: np.ndarray, block_rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """(query row, id, score) of each query's k best in a block, and the multiplications it took.

    Components are whole numbers in doubles; those of narrow rows are small enough that all products and sums are exact.
    """
    width = max(block.shape[1] if len(block) else 1, 1)
    limit = (2**53 / width) ** 0.5
    wide_q, wide_c = ((np.abs(x).max(axis=1, initial=0) >= limit) for x in (queries, block))
    narrow_q, narrow = np.flatnonzero(~wide_q), np.flatnonzero(~wide_c)
    best, done = Best(len(narrow_q), k), 0
    asked, found = queries[narrow_q], block[narrow]
    if np.abs(asked).max(initial=0) * np.abs(found).max(initial=0) * width < 2**23:
        asked, found = asked.astype(np.float32), found.astype(np.float32)
    for at in range(0, len(narrow), STEP):
        some = slice(at, at + STEP)
        done += _step(asked, query_rows[narrow_q], found[some], block_rows[narrow[some]], ids[narrow[some]], best)
    lists = {int(query_rows[q]): [(-int(s), int(i)) for s, i in zip(best.score[n], best.id[n], strict=True) if s > -np.inf] for n, q in enumerate(narrow_q)}
    whole = lambda x: [[int(c) for c in v] for v in x]
    for q, v in enumerate(whole(queries) if wide_q.any() or wide_c.any() else ()):
        others = np.arange(len(block)) if wide_q[q] else np.flatnonzero(wide_c)
        row = int(query_rows[q])
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), int(ids[c])) for c, w in zip(others, whole(block[others]), strict=True) if block_rows[c] != row]
        done += len(scored) * width
        lists[row] = sorted(lists.get(row, []) + scored)[:k]
    return [(row, i, max(min(-s, 2**63 - 1), -(2**63))) for row, best_of in lists.items() for s, i in best_of], done


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """(id, v array<double>): floor(scale * x) of the valid vectors, as whole numbers."""

    def whole(x: Column) -> Column:
        y, most = F.lit(scale) * x.cast("double"), F.lit(sys.float_info.max)
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(F.greatest(F.least(y, most), -most))

    good = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return rows.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("bigint").alias("id"), F.transform(vector_col, whole).alias("v"))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score over (id, v) rows; the rows where ``is_query`` holds are the queries."""
    vectors = stored(vectors.select("id", "v", F.monotonically_increasing_id().alias("row")))
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(F.size("v")).alias("width")).first()
    candidates = min(max(CANDIDATES, counts["n"] // SPREAD), MOST_CANDIDATES)
    query_blocks, blocks, width = 1 + counts["q"] // QUERIES, 1 + counts["n"] // candidates, counts["width"] or 1
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = vectors.where(is_query).select(F.lit(1).alias("q"), dealt(query_blocks).alias("i"), every(blocks).alias("j"), "row", "id", "v")
    offered = vectors.select(F.lit(0).alias("q"), every(query_blocks).alias("i"), dealt(blocks).alias("j"), "row", "id", "v")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one = rows["q"].to_numpy() == 1
        matrix, row, ids = _matrix(rows["v"], width), rows["row"].to_numpy(), rows["id"].to_numpy()
        id_of = dict(zip(row[one].tolist(), ids[one].tolist(), strict=True))
        found, _ = search(matrix[one], row[one], matrix[~one], row[~one], ids[~one], k)
        return pd.DataFrame([(r, id_of[r], i, s) for r, i, s in found], columns=["row", "query_id", "vec_id", "score"])

    found = asked.union(offered).groupBy("i", "j").applyInPandas(run, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
