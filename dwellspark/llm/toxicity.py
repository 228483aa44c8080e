"""Toxicity of whole texts by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is its learned vector (one shared vector for words outside the vocabulary) beside the mean of learned
vectors of its runs of three characters, so unseen words still count by their spelling.  Two more inputs tell what the
labels of the training texts say of the word itself and of words that begin alike: how far beyond doubt it is that
they go with toxicity.  In training these come from other folds of texts than the one that is read, so the network
learns how much to trust them, also where labels are few.  Windows of WINDOW words, each overlapping the next by half,
cover a text; in each, two gated recurrent units read in both directions, attention pools their states, and a logistic
unit scores the pool.  A document's score is its highest window's.

The network is fitted on the driver on a bounded sample of labelled rows: of each class at most ``TRAINING_DOCS``
documents, those with the smallest hashes of their ids, passing over a document that would bring the class beyond
``TRAINING_WORDS`` words.  In the first epoch a chosen text teaches with all of its windows, later a toxic one with its
highest, a clean one with its highest and one drawn at random; highest windows are looked for every AGAIN epochs.  Each
class is weighted by its share of all labelled documents.  Training ends when the held part's loss has not fallen for a
while; where a class is too small for a held part, after FEW_EPOCHS.  The fewer texts of a class there are, the slower
the vectors of words learn.  Scoring reads every word of every text; only the network (some MB) is broadcast.

Defined cases: null text counts as empty; a text without words is one window of padding, scored by the same network;
without labelled rows of both classes the score is the share of label 1 (0 without any); repeated rows get equal
scores; labels of documents that do not exist, null labels and null ids teach nothing; of rows that share an id one
text teaches.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_texts, training_row

WINDOW, STEP = 32, 16
TRAINING_DOCS, TRAINING_WORDS = 1500, 1_000_000
WORD_DIM, RUN_DIM, HIDDEN, ATTENTION = 12, 8, 10, 8
RUNS, VOCABULARY = 16384, 20_000
EPOCHS, MOST_EPOCHS, STEPS, BATCH, RATE, DECAY, DROPPED = 12, 80, 250, 256, 0.006, 2e-5, 0.15
#: Evidence of labels: folds of texts; the root of a likelihood ratio from which it counts, its rise with every tenfold of
#: PLENTY texts, and how far beyond it counts as 1; buckets for words' beginnings, of so many characters.
FOLDS, DOUBT, MORE_DOUBT, SURE, STARTS, START_CHARS = 5, 3.0, 1.35, 3.0, 1 << 20, (3, 4, 5, 6)
#: Words whose inputs a worker keeps at once, and windows it scores at once.
KNOWN_WORDS, TOGETHER = 150_000, 2048
#: Texts of each class that the part kept for choosing the epoch has at least; with fewer all teach, and so many epochs; texts of the rarer class from which vectors of words learn at full pace.
LEAST_HELD, FEW_EPOCHS, PLENTY = 5, 80, 50
#: Epochs after which the highest windows of the texts that teach are looked for anew.
AGAIN = 3
PAD, UNSEEN = 0, 1
_words = re.compile(r"[^\W_]+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def window_starts(n: int, step: int = STEP) -> np.ndarray:
    """Starts of the windows that cover n words; the last ends at the last word."""
    return np.append(np.arange(0, max(n - WINDOW, 0), step), max(n - WINDOW, 0))


def char_runs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all runs of three characters (with a mark at both ends) of the words, and where each word's begin."""
    marked = "".join([f"\x02{w or chr(3)}\x02" for w in words])
    points = np.frombuffer(marked.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    inside = ((a != 2) | (b != 2)) & ((b != 2) | (c != 2))
    buckets = (a * 1_000_003 + b * 8191 + c * 131) % 1_000_000_007 % RUNS
    return buckets[inside], np.flatnonzero(a[inside] == 2)


def sum_rows(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """An array of ``size`` rows; each is the sum of the ``values`` whose place in ``at`` names it."""
    out = np.zeros((size, values.shape[1]), np.float32)
    if len(at):
        order = np.argsort(at, kind="stable")
        named = at[order]
        begin = np.flatnonzero(np.append(True, named[1:] != named[:-1]))
        out[named[begin]] = np.add.reduceat(values[order], begin, axis=0)
    return out


class Spelled:
    """Distinct words as their rows in the vocabulary and the buckets of their runs, looked up once."""

    def __init__(self, rows: np.ndarray, buckets: np.ndarray, sizes: np.ndarray):
        self.rows, self.buckets, self.sizes = rows, buckets, sizes
        self.begin = np.cumsum(sizes) - sizes

    def take(self, words: np.ndarray) -> Spelled:
        sizes = self.sizes[words]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return Spelled(self.rows[words], self.buckets[np.repeat(self.begin[words], sizes) + inner], sizes)


def start_buckets(words: list[str]) -> np.ndarray:
    """Bucket numbers (words, START_CHARS) of the words' beginnings, and 0 where a word is shorter."""
    most = START_CHARS[-1]
    points = np.frombuffer("".join(w[:most].ljust(most, "\0") for w in words).encode("utf-32-le", "replace"), np.uint32).reshape(len(words), most).astype(np.int64)
    powers = np.cumprod(np.full(most, 1_000_003, np.int64)) % 2_147_483_647
    sums = np.cumsum(points * powers % 2_147_483_647, axis=1)[:, [n - 1 for n in START_CHARS]]
    whole = points[:, [n - 1 for n in START_CHARS]] > 0
    return np.where(whole, (sums + np.array(START_CHARS)) % 2_147_483_647 % (STARTS - 1) + 1, 0)


def excess(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """0 to 2: how far beyond doubt it is that what ``toxic`` and ``clean`` texts have goes with toxicity."""
    share = all_toxic / max(all_toxic + all_clean, 1)
    both = np.maximum(toxic + clean, 1)
    ratio = lambda n, part: np.where(n > 0, n * np.log(np.maximum(n, 1) / (both * max(part, 1e-9))), 0)
    root = np.sqrt(np.maximum(2 * (ratio(toxic, share) + ratio(clean, 1 - share)), 0))
    doubt = DOUBT + MORE_DOUBT * np.log10(max(min(all_toxic, all_clean) / PLENTY, 1))
    return np.where(toxic * all_clean > clean * all_toxic, np.clip((root - doubt) / SURE, 0, 2), 0).astype(np.float32)


class Evidence:
    """What the labels of training texts say of single words, and of words that begin alike: two inputs of a word."""

    def __init__(self, words: dict[str, float], starts: np.ndarray):
        self.words, self.starts = words, starts

    def of(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, 2), np.float32)
        return np.stack([np.fromiter((self.words.get(w, 0.0) for w in words), np.float32, len(words)), self.starts[start_buckets(words)].max(axis=1)], axis=1)


def evidence_of(words: list[str], texts: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> tuple[Evidence, np.ndarray]:
    """Evidence from all texts, and (folds, words, 2): for each fold's texts that from the other folds, so that no text tells of itself.

    ``texts`` hold the distinct numbers of their words.
    """
    buckets = start_buckets(words)
    in_words, in_starts = np.zeros((FOLDS, 2, len(words)), np.int32), np.zeros((FOLDS, 2, STARTS), np.int32)
    for own, label, fold in zip(texts, labels, folds, strict=True):
        in_words[fold, label, own] += 1
        in_starts[fold, label, np.unique(buckets[own])] += 1
    sizes = np.array([[np.sum((folds == f) & (labels == y)) for y in (0, 1)] for f in range(FOLDS)])

    def without(fold: int | None) -> tuple[np.ndarray, np.ndarray]:
        rest = [f for f in range(FOLDS) if f != fold]
        clean, toxic = sizes[rest].sum(axis=0)
        of_words, of_starts = (excess(n[rest, 1].sum(axis=0), n[rest, 0].sum(axis=0), toxic, clean) for n in (in_words, in_starts))
        of_starts[0] = 0
        return of_words, of_starts

    crossed = np.stack([np.stack([w, t[buckets].max(axis=1)], axis=1) for w, t in map(without, range(FOLDS))])
    of_words, of_starts = without(None)
    return Evidence({words[i]: float(of_words[i]) for i in np.flatnonzero(of_words)}, of_starts), crossed


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gru(inputs: np.ndarray, recur: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
    """States (steps, rows, HIDDEN) for projected inputs (steps, rows, 3 * HIDDEN); ``keep`` gets what learning needs."""
    steps, rows, _ = inputs.shape
    state, states = np.zeros((rows, HIDDEN), np.float32), np.empty((steps, rows, HIDDEN), np.float32)
    for t in range(steps):
        mixed = state @ recur
        gates = np.tanh(0.5 * (inputs[t, :, : 2 * HIDDEN] + mixed[:, : 2 * HIDDEN])) * 0.5 + 0.5
        hold, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        fresh = np.tanh(inputs[t, :, 2 * HIDDEN :] + reset * mixed[:, 2 * HIDDEN :])
        new = fresh + hold * (state - fresh)
        if mask is not None:
            new = np.where(mask[t][:, None], new, state)
        if keep is not None:
            keep.append((state, hold, reset, fresh, mixed[:, 2 * HIDDEN :]))
        state = states[t] = new
    return states


def _gru_back(grads: np.ndarray, recur: np.ndarray, mask: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``recur`` from those of the states."""
    steps, rows, _ = grads.shape
    d_inputs, d_recur, d_state = np.zeros((steps, rows, 3 * HIDDEN), np.float32), np.zeros_like(recur), np.zeros((rows, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        state, hold, reset, fresh, mixed = kept[t]
        d_all = d_state + grads[t]
        d_new = d_all * mask[t][:, None]
        d_fresh = d_new * (1 - hold) * (1 - fresh**2)
        d_hold = d_new * (state - fresh) * hold * (1 - hold)
        d_reset = d_fresh * mixed * reset * (1 - reset)
        d_inputs[t] = np.concatenate([d_hold, d_reset, d_fresh], axis=1)
        d_mixed = np.concatenate([d_hold, d_reset, d_fresh * reset], axis=1)
        d_recur += state.T @ d_mixed
        d_state = d_mixed @ recur.T + d_new * hold + d_all * ~mask[t][:, None]
    return d_inputs, d_recur


class Network:
    """The parameters ``p`` and the vocabulary."""

    def __init__(self, vocabulary: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.vocabulary = {w: i + 2 for i, w in enumerate(vocabulary)}
        inputs = WORD_DIM + RUN_DIM
        self.p = {
            "words": draw(len(vocabulary) + 2, WORD_DIM) * 0.1 * np.sqrt(len(vocabulary) + 2, dtype=np.float32),
            "runs": draw(RUNS, RUN_DIM) * np.float32(0.1 * RUNS**0.5),
            **{f"in_{d}": draw(inputs, 3 * HIDDEN) for d in "fb"},
            **{f"bias_{d}": np.zeros(3 * HIDDEN, np.float32) for d in "fb"},
            **{f"recur_{d}": draw(HIDDEN, 3 * HIDDEN) for d in "fb"},
            **{f"told_{d}": draw(2, 3 * HIDDEN) for d in "fb"},
            "attend": draw(2 * HIDDEN, ATTENTION), "attend_bias": np.zeros(ATTENTION, np.float32), "focus": draw(ATTENTION),
            "out": draw(2 * HIDDEN), "out_bias": np.full(1, -2, np.float32),
        }
        self.p["words"][PAD] = 0
        self.evidence = Evidence({}, np.zeros(STARTS, np.float32))

    def word_rows(self, words: list[str]) -> np.ndarray:
        return np.fromiter((self.vocabulary.get(w, UNSEEN) for w in words), np.int64, len(words))

    def spelled(self, words: list[str]) -> Spelled:
        buckets, begin = char_runs(words)
        return Spelled(self.word_rows(words), buckets, np.diff(np.append(begin, len(buckets))))

    def inputs_of(self, words: list[str] | Spelled) -> np.ndarray:
        """The inputs (words, WORD_DIM + RUN_DIM) of distinct words."""
        if isinstance(words, list):
            if not words:
                return np.zeros((0, WORD_DIM + RUN_DIM), np.float32)
            words = self.spelled(words)
        sums = np.add.reduceat(self.p["runs"][words.buckets], words.begin, axis=0)
        return np.concatenate([self.p["words"][words.rows], sums / words.sizes[:, None]], axis=1).astype(np.float32)

    def pooled(self, forward: np.ndarray, backward: np.ndarray, mask: np.ndarray | None):
        both = np.concatenate([forward, backward[::-1]], axis=2)
        hidden = np.tanh(both @ self.p["attend"] + self.p["attend_bias"])
        weight = hidden @ self.p["focus"]
        if mask is not None:
            weight = np.where(mask, weight, -30)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        if mask is not None:
            weight = weight * mask
        return both, hidden, weight, np.einsum("trh,tr->rh", both, weight)

    def logits(self, ids: np.ndarray, projected: dict[str, np.ndarray], mask: np.ndarray | None = None, told: np.ndarray | None = None) -> np.ndarray:
        """Logits of windows, ids (WINDOW, windows) being rows of the projected inputs, told (WINDOW, windows, 2) what evidence adds."""
        states = [_gru(self._inputs(projected, d, ids, told)[::s], self.p[f"recur_{d}"], None if mask is None else mask[::s], None) for d, s in (("f", 1), ("b", -1))]
        return self.pooled(*states, mask)[3] @ self.p["out"] + self.p["out_bias"]

    def _inputs(self, projected: dict[str, np.ndarray], d: str, ids: np.ndarray, told: np.ndarray | None) -> np.ndarray:
        return projected[d][ids] if told is None else projected[d][ids] + told @ self.p[f"told_{d}"]

    def projections(self, inputs: np.ndarray, told: np.ndarray | None = None) -> dict[str, np.ndarray]:
        return {d: inputs @ self.p[f"in_{d}"] + self.p[f"bias_{d}"] + (0 if told is None else told @ self.p[f"told_{d}"]) for d in "fb"}

    def gradients(self, ids: np.ndarray, mask: np.ndarray, words: list[str] | Spelled, y: np.ndarray, weight: np.ndarray, rng: np.random.Generator | None = None, told: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Gradients of the weighted mean log loss; ids are rows of ``words``, the first of which is padding.

        With ``rng``, a share DROPPED of the batch's words is taken as outside the vocabulary.
        """
        words = self.spelled(words) if isinstance(words, list) else words
        p, x, g, rows_of = self.p, self.inputs_of(words), {}, words.rows
        if rng is not None:
            rows_of = np.where(rng.random(len(rows_of)) < DROPPED, UNSEEN, rows_of)
            x[:, :WORD_DIM] = p["words"][rows_of]
        projected, kept = self.projections(x), {"f": [], "b": []}
        states = [_gru(self._inputs(projected, d, ids, told)[::s], p[f"recur_{d}"], mask[::s], kept[d]) for d, s in (("f", 1), ("b", -1))]
        both, hidden, share, pool = self.pooled(*states, mask)
        error = ((_sigmoid(pool @ p["out"] + p["out_bias"]) - y) * weight / weight.sum()).astype(np.float32)
        g["out"], g["out_bias"] = pool.T @ error, error.sum(keepdims=True)
        d_pool = error[:, None] * p["out"]
        d_share = np.einsum("trh,rh->tr", both, d_pool)
        d_focus = share * (d_share - (share * d_share).sum(axis=0))
        g["focus"] = np.einsum("tra,tr->a", hidden, d_focus)
        d_hidden = d_focus[:, :, None] * p["focus"] * (1 - hidden**2)
        g["attend"], g["attend_bias"] = np.einsum("trh,tra->ha", both, d_hidden, optimize=True), d_hidden.sum(axis=(0, 1))
        d_both = share[:, :, None] * d_pool + d_hidden @ p["attend"].T
        d_x = np.zeros_like(x)
        for d, s, part in (("f", 1, d_both[:, :, :HIDDEN]), ("b", -1, d_both[:, :, HIDDEN:])):
            d_in, g[f"recur_{d}"] = _gru_back(part[::s], p[f"recur_{d}"], mask[::s], kept[d])
            if told is not None:
                g[f"told_{d}"] = np.einsum("tre,trh->eh", told[::s], d_in, optimize=True)
            rows = sum_rows(ids[::s].ravel(), d_in.reshape(-1, 3 * HIDDEN), len(rows_of))
            g[f"in_{d}"], g[f"bias_{d}"] = x.T @ rows, rows.sum(axis=0)
            d_x += rows @ p[f"in_{d}"].T
        g["words"] = sum_rows(rows_of, d_x[:, :WORD_DIM], len(p["words"]))
        g["words"][PAD] = 0
        g["runs"] = sum_rows(words.buckets, np.repeat(d_x[:, WORD_DIM:] / words.sizes[:, None], words.sizes, axis=0), RUNS)
        return g


class _Adam:
    def __init__(self, params: dict[str, np.ndarray], pace: dict[str, float]):
        self.params, self.step, self.pace = params, 0, pace
        self.first, self.second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))

    def move(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.step += 1
        for name, grad in grads.items():
            grad = grad + DECAY * self.params[name]
            self.first[name] += 0.1 * (grad - self.first[name])
            self.second[name] += 0.001 * (grad**2 - self.second[name])
            change = self.first[name] / (1 - 0.9**self.step) / (np.sqrt(self.second[name] / (1 - 0.999**self.step)) + 1e-8)
            self.params[name] -= (rate * self.pace.get(name, 1.0) * change).astype(np.float32)


def training_windows(text: str | None) -> list[str]:
    """Windows that cover the whole text, each beginning where the last ended, as words joined by spaces."""
    words = words_of(text)
    return [" ".join(words[at : at + WINDOW]) for at in window_starts(len(words), WINDOW)]


def fit(texts: list[list[str]], labels: np.ndarray, shares: tuple[float, float], seed: int = 7) -> Network:
    """Trains on the windows of labelled texts; ``shares`` are the classes' shares among all labelled rows.

    A text is toxic if any window is, so a toxic text teaches by its highest window only, a clean text by its highest
    and one drawn at random.  One text of six of each class is kept for choosing the epoch with the least log
    loss (the mean of three epochs'), if that makes LEAST_HELD; otherwise all texts teach for FEW_EPOCHS.
    """
    rng, y = np.random.default_rng(seed), labels.astype(np.float32)
    share = max(float(y.mean()), 1e-9)
    weight = np.where(y == 1, shares[1] / share, shares[0] / max(1 - share, 1e-9)).astype(np.float32)
    at, seen_in = {"": 0}, np.zeros(1, np.int64)
    found: list[np.ndarray] = []
    distinct: list[np.ndarray] = []
    for text in texts:
        own = np.zeros((len(text), WINDOW), np.int32)
        for row, window in zip(own, text, strict=True):
            words = window.split()
            row[: len(words)] = [at.setdefault(w, len(at)) for w in words]
        seen_in = np.append(seen_in, np.zeros(len(at) - len(seen_in), np.int64)) if len(at) > len(seen_in) else seen_in
        distinct.append(np.unique(own[own > 0]))
        seen_in[distinct[-1]] += 1
        found.append(own)
    spans = [(int(b) - len(own), int(b)) for own, b in zip(found, np.cumsum([len(own) for own in found]), strict=True)]
    ids, all_words = np.concatenate(found).T.astype(np.int64, order="C"), list(at)
    del found, at
    least = max(2, len(texts) // 400)
    often = [(all_words[i], int(seen_in[i])) for i in np.flatnonzero(seen_in >= least) if i]
    network = Network([w for w, _ in sorted(often, key=lambda x: (-x[1], x[0]))[:VOCABULARY]], seed)
    folds = np.zeros(len(texts), np.int64)
    for of_class in (np.flatnonzero(y == 0), np.flatnonzero(y == 1)):  # each fold has its part of both classes
        folds[rng.permutation(of_class)] = np.arange(len(of_class)) % FOLDS
    network.evidence, crossed = evidence_of(all_words, distinct, labels.astype(np.int64), folds)
    del distinct
    held = np.concatenate([rng.permutation(np.flatnonzero(y == k))[: int((y == k).sum()) // 6] for k in (0, 1)])
    if min(y[held].sum(), (1 - y[held]).sum()) < LEAST_HELD:
        held = held[:0]
    learners = np.setdiff1d(np.arange(len(texts)), held)
    spelled = network.spelled(all_words)
    owners = np.repeat(np.arange(len(texts)), [b - a for a, b in spans])
    kept = np.isin(owners, held)
    parts, logits = [np.flatnonzero(kept), np.flatnonzero(~kept)], np.zeros(len(owners), np.float32)
    slow = min(1.0, float(min(y.sum(), (1 - y).sum())) / PLENTY)  # few texts can't tell the vectors of many words
    adam, best, chosen, since = _Adam(network.p, {"words": slow, "runs": slow}), np.inf, None, 0
    most, losses = MOST_EPOCHS if len(held) else FEW_EPOCHS, []
    epochs = min(max(EPOCHS, STEPS * BATCH // (2 * len(learners) + 1)), most)  # few texts are gone through more often
    for epoch in range(epochs):
        projected = network.projections(network.inputs_of(spelled))
        for i, part in enumerate(parts):
            if epoch % AGAIN == 1 or i == 0:
                logits[part] = np.concatenate([network.logits(ids[:, some], projected, ids[:, some] > 0, crossed[folds[owners[some]], ids[:, some]]) for some in np.split(part, range(TOGETHER, len(part), TOGETHER))])
        top = np.array([a + int(np.argmax(logits[a:b])) for a, b in spans])
        if epoch and len(held):
            chance = np.clip(_sigmoid(logits[top[held]]), 1e-6, 1 - 1e-6)
            losses.append(float(-(weight[held] * np.where(y[held] == 1, np.log(chance), np.log(1 - chance))).sum()))
            loss = sum(losses[-3:]) / len(losses[-3:])  # one epoch's is chance where the held part is small
            since += 1
            if loss < best:
                best, chosen, since = loss, {k: v.copy() for k, v in network.p.items()}, 0
            if since > max(4, epochs // 5):
                break
        if epoch == 0:
            rows = parts[1].copy()
        else:
            clean = learners[y[learners] == 0]
            rows = np.concatenate([top[learners], [rng.integers(*spans[i]) for i in clean]]).astype(np.int64)
        rng.shuffle(rows)
        for k in range(0, len(rows), BATCH):
            some = rows[k : k + BATCH]
            used, inverse = np.unique(np.append(ids[:, some].ravel(), 0), return_inverse=True)
            local = inverse[:-1].reshape(WINDOW, len(some))
            grads = network.gradients(local, local > 0, spelled.take(used), y[owners[some]], weight[owners[some]], rng, crossed[folds[owners[some]], ids[:, some]])
            adam.move(grads, RATE * (1 - 0.9 * epoch / epochs))
    network.p = chosen or network.p
    return network


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = TRAINING_DOCS) -> Network | float:
    """The network, or the share of label 1 where a class is missing."""
    known = docs.select("doc_id").where("doc_id is not null")
    rows = labels.where(training_row() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y"))
    rows = checkpointed(rows.join(known, "doc_id", "left_semi"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return float(counts.get(1, 0) > 0)
    picked = [rows.where(F.col("y") == y).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = picked[0].union(picked[1])  # 2 * per_class rows at most
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def make():
        return lambda batch: [pa.array([training_windows(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()], pa.list_(pa.string()))]

    # windows are cut on the executors and stay in the shared folder; the driver gets those it has room for
    cut = map_texts(sample, make, ["doc_id", "y"], "windows array<string>").groupBy("doc_id", "y").agg(F.min_by("windows", F.xxhash64("windows")).alias("windows"))
    cut = checkpointed(cut.select(F.xxhash64("doc_id").alias("place"), "doc_id", "y", "windows"))
    room, taken = {0: TRAINING_WORDS, 1: TRAINING_WORDS}, []
    for r in sorted(cut.select("place", "doc_id", "y", (F.size("windows") * WINDOW).alias("words")).collect()):
        if r["words"] <= room[r["y"]]:
            room[r["y"]] -= r["words"]
            taken.append((r["doc_id"], r["y"]))
    if len({y for _, y in taken}) < 2:
        return counts[1] / sum(counts.values())
    taught = sorted(cut.join(F.broadcast(docs.sparkSession.createDataFrame(taken, cut.select("doc_id", "y").schema)), ["doc_id", "y"]).select("place", "doc_id", "y", "windows").collect())
    share = counts[1] / sum(counts.values())
    return fit([r["windows"] for r in taught], np.array([r["y"] for r in taught]), (1 - share, share))


class Scorer:
    """Scores texts, keeping the projected inputs of the words it has met."""

    def __init__(self, network: Network):
        self.network, self.at = network, {}
        self.tables = {d: np.zeros((KNOWN_WORDS + 1, 3 * HIDDEN), np.float32) for d in "fb"}
        self.add([""])

    def add(self, words: list[str]) -> None:
        n = len(self.at)
        for d, rows in self.network.projections(self.network.inputs_of(words), self.network.evidence.of(words)).items():
            if n + len(words) > len(self.tables[d]):
                self.tables[d] = np.concatenate([self.tables[d], np.zeros((n + len(words) - len(self.tables[d]), 3 * HIDDEN), np.float32)])
            self.tables[d][n : n + len(words)] = rows
        self.at.update(zip(words, range(n, n + len(words)), strict=True))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        docs = [words_of(t) for t in texts]
        distinct = set().union(*docs)
        new = [w for w in distinct if w not in self.at]
        if len(self.at) + len(new) > KNOWN_WORDS:
            self.at = {}
            self.add(["", *sorted(distinct)])
        elif new:
            self.add(new)
        ids = [np.fromiter(map(self.at.__getitem__, d), np.int64, len(d)) for d in docs]
        best = np.full(len(docs), -np.inf)
        full = [(i, at) for i, d in enumerate(ids) if len(d) >= WINDOW for at in window_starts(len(d))]
        base = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        owners, starts = (np.array([x[k] for x in full], np.int64) for k in (0, 1))
        for k in range(0, len(full), TOGETHER):
            who = owners[k : k + TOGETHER]
            at = np.arange(WINDOW)[:, None] + (base[who] + starts[k : k + TOGETHER])[None, :]
            np.maximum.at(best, who, self.network.logits(flat[at], self.tables))
        short = [i for i, d in enumerate(ids) if len(d) < WINDOW]
        for k in range(0, len(short), TOGETHER):
            some = short[k : k + TOGETHER]
            padded, mask = np.zeros((WINDOW, len(some)), np.int64), np.zeros((WINDOW, len(some)), bool)
            for j, i in enumerate(some):
                padded[: len(ids[i]), j], mask[: len(ids[i]), j] = ids[i], True
            best[some] = self.network.logits(padded, self.tables, mask)
        return _sigmoid(best)


def score(docs: DataFrame, model: Network | float, keep: list[str], to: str = "score", text_col: str = "text") -> DataFrame:
    """Adds the score ``to`` to the columns ``keep``."""
    if isinstance(model, float):
        return docs.select(*keep, F.lit(model).alias(to))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)
        return lambda batch: [pa.array(scorer.scores(batch.column(batch.schema.get_field_index(text_col)).to_pylist()), pa.float64())]

    return map_texts(docs, make, keep, f"{to} double")
