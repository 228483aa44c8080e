"""Byte-level BPE: encoding by backtracking over longest matches, and decoding.

Bytes are mapped to Latin-1 characters, so that one pyahocorasick automaton finds every vocabulary token in a
piece.  An encoding is walked from left to right, longest match first; a token may follow another only if plain
merging of both tokens' bytes gives these two tokens back (a memoised fact about the pair), and positions from which
no continuation exists are marked and never tried again.  A sequence whose adjacent tokens are all compatible is
exactly the sequence that the merges give, so the walk is linear and exact.

Defined cases: a null text counts as the empty text (no ids, no bytes); nothing is normalised; special tokens are
ordinary text; repeated rows are encoded each for itself.
"""

from __future__ import annotations

import base64
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_texts

#: Pieces after which a worker's memo moves on (what is met again comes along), and pairs after which theirs starts
#: anew; they bound memory, not results.
MEMO_ENTRIES, PAIR_ENTRIES = 250_000, 400_000
NO_RANK = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tokenizer file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Encoder:
    """Exact BPE of single pieces (the matches of the splitting pattern)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length = [0] * (max(ranks.values()) + 1)
        self.shorter: list[int | None] = [None] * len(self.length)
        self.pairs: dict[int, bool] = {}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.automaton = ahocorasick.Automaton()
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
            self.length[rank] = len(token)
            self.shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None)
        self.automaton.make_automaton()

    def merged(self, piece: bytes) -> list[int]:
        """Plain merging, lowest rank first; only for the few bytes of two adjacent tokens."""
        rank_of, parts = self.ranks.get, [piece[i : i + 1] for i in range(len(piece))]
        ranks = [rank_of(a + b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (rank := min(ranks)) != NO_RANK:
            at = ranks.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at], NO_RANK)
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1], NO_RANK)
        return [self.ranks[p] for p in parts]

    def edges_of(self, token: int) -> tuple[list, list] | None:
        """How the token's last and first part grow while it is merged: (part, rank of the merge that takes it in).

        None if merging doesn't give the token, or not with rising ranks.
        """
        piece, rank_of = self.bytes_of[token], self.ranks.get
        parts, last_rank, ends, starts = [piece[i : i + 1] for i in range(len(piece))], -1, [], []
        while len(parts) > 1:
            rank, at = min((rank_of(parts[i] + parts[i + 1], NO_RANK), i) for i in range(len(parts) - 1))
            if rank == NO_RANK or rank < last_rank:
                return None
            if at == len(parts) - 2:
                ends.append((parts[-1], rank))
            if at == 0:
                starts.append((parts[0], rank))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            last_rank = rank
        return [*ends, (piece, NO_RANK)], [*starts, (piece, NO_RANK)]

    def _separate(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives both tokens: no merge across their border comes first."""
        for token in (left, right):
            if token not in self.edges:
                self.edges[token] = self.edges_of(token)
        if self.edges[left] is None or self.edges[right] is None:
            return self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        ends, starts, i, j = self.edges[left][0], self.edges[right][1], 0, 0
        while True:
            (end, taken_left), (start, taken_right) = ends[i], starts[j]
            across = self.ranks.get(end + start, NO_RANK)
            if across < taken_left and across <= taken_right:  # of equal ranks, the merge to the left goes first
                return False
            if taken_left == taken_right == NO_RANK:
                return True
            if taken_left <= taken_right:
                i += 1
            else:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[pair] = self._separate(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, known = piece.decode("latin-1"), self.pairs.get
        # the longest match at each place is mostly the answer
        chosen = [token for _, token in self.automaton.iter_long(text)]
        for left, right in zip(chosen, chosen[1:], strict=False):
            if not (known(left << 32 | right) or self.compatible(left, right)):
                break
        else:
            return chosen
        size, length, shorter, compatible = len(piece), self.length, self.shorter, self.compatible
        longest: list[int | None] = [None] * (size + 1)
        for end, token in self.automaton.iter(text):
            longest[end + 1 - length[token]] = token  # ends rise, so the last from a start is the longest
        dead = bytearray(size + 1)
        chosen = []
        at, token = 0, longest[0]
        while at < size:
            while token is not None and (dead[at + length[token]] or (chosen and not compatible(chosen[-1], token))):
                token = shorter[token]
            if token is None:
                dead[at] = 1
                at -= length[chosen[-1]]
                token = shorter[chosen.pop()]
            else:
                chosen.append(token)
                at += length[token]
                token = longest[at]
        return chosen


def _encoding(encoder: Encoder, pattern: str):
    """A function from a text to its ids, packed as 32-bit integers."""
    pieces, memo, before = regex.compile(pattern).findall, {}, {}

    def packed(piece: str) -> bytes:
        if len(memo) >= MEMO_ENTRIES:
            before.clear()
            before.update(memo)
            memo.clear()
        ids = before.get(piece)
        if ids is None:
            ids = array("i", encoder.encode(piece.encode())).tobytes()
        if len(piece) <= 64:
            memo[piece] = ids
        return ids

    known = memo.get
    return lambda text: b"".join([known(p) or packed(p) for p in pieces(text or "")])


def _lists(packed: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _decoded(ids: np.ndarray, token_of) -> bytes:
    return b"".join(map(token_of, ids.tolist()))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, token_ids array<int>) for each document; ``ranks`` is a fixed vocabulary and is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        encoded = _encoding(Encoder(shared.value), pattern)
        return lambda batch: [_lists([encoded(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()])]

    return map_texts(docs.select(id_col, text_col), make, [id_col], "token_ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "token_ids") -> DataFrame:
    """Adds ``decoded`` (binary; a fresh name where it is taken): the bytes of the ids, in order."""
    to = fresh(encoded, "decoded")
    shared = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def make():
        token_of = shared.value.__getitem__

        def work(batch: pa.RecordBatch) -> list:
            column = batch.column(batch.schema.get_field_index(ids_col))
            return [pa.array([_decoded(x.values.to_numpy(zero_copy_only=False), token_of) for x in column], pa.binary())]

        return work

    return map_texts(encoded, make, encoded.columns, f"{to} binary")


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode, then decode, in one pass of one worker: (id, token_ids, decoded)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        encoder = Encoder(shared.value)
        encoded, token_of = _encoding(encoder, pattern), encoder.bytes_of.__getitem__

        def work(batch: pa.RecordBatch) -> list:
            packed = [encoded(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            return [_lists(packed), pa.array([_decoded(np.frombuffer(p, np.int32), token_of) for p in packed], pa.binary())]

        return work

    return map_texts(docs.select(id_col, text_col), make, [id_col], "token_ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids (decimal, joined by commas) and of the decoded bytes."""
    return encode_and_decode(docs, ranks, pattern).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["token_ids"] if with_ids else []),
    )
