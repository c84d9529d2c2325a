"""Toxicity: a bidirectional gated recurrent network with attention pooling, over words and their characters.

A text is cut into overlapping windows of words. A word's input is its embedding (of the training vocabulary, else
nothing) and the mean embedding of its letter trigrams; two gated recurrent layers read the window in both directions,
attention weighs their states, and a logistic unit scores the pooled state. A document's score is that of its highest
window, over all windows of the whole text. Labels belong to documents, so training takes for each document the windows
that score highest so far (all windows of short documents to begin with).

Training runs in numpy on the driver, on a bounded sample of labelled documents; scoring runs in tasks.

Cases: a null or empty text and one without words has one empty window, which gets a score as well; documents without
labels are scored but not learned from; labels that are null or repeated for an id count once, by their largest; with
labels of one kind only, or none, all scores are that share (0.0 without labels); an empty table gives no rows; a column
``score`` is replaced, others are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import schema_with, slices, with_column

WORDS = re.compile(r"\w+")
WINDOW, STRIDE = 32, 24
REJECT = 0.7
TRIGRAMS = 4096
REMEMBERED = 150_000
# a word in fewer than this share of the sample is known by its trigrams alone, so rare words are not learned by heart
WORD_SHARE, MOST_WORDS = 1 / 180, 30_000
BATCH, PASSES, LEAST_STEPS = 128, 3, 90

# bounds of the training sample
TOXIC_DOCS, CLEAN_DOCS, SAMPLE_CHARS = 1200, 2400, 20_000


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def window_starts(n: int) -> list[int]:
    """Starts of the windows over ``n`` words; the last one reaches the end"""
    return list(range(0, max(1, n - WINDOW + STRIDE), STRIDE)) if n > WINDOW else [0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights and passes of the network; all arrays are float32"""

    words: dict[str, int]
    dim: int = 8
    hidden: int = 8
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int) -> None:
        rng, d, h = np.random.default_rng(seed), 2 * self.dim, self.hidden

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.weights = {
            "word": normal(len(self.words) + 1, self.dim, scale=0.1),  # row 0: unknown words
            "char": normal(TRIGRAMS, self.dim, scale=0.1),
            "wx": normal(2, d, 3 * h, scale=d**-0.5),
            "b": np.zeros((2, 1, 3 * h), np.float32),
            "wh": normal(2, h, 3 * h, scale=h**-0.5),
            "att": normal(2 * h, scale=0.1),
            "out": normal(2 * h, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        self.weights["word"][0] = 0

    # ------------------------------------------------------------ inputs

    def trigrams(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Trigram numbers of all words, one after the other, and where each word's start"""
        marked = [f"<{w}>" for w in words]
        codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
        lengths = np.array([len(m) for m in marked])
        ends = np.cumsum(lengths)
        number = (codes[:-2] * 7919 + codes[1:-1] * 104729 + codes[2:] * 1299709) % 999983 % TRIGRAMS
        inside = np.ones(len(codes), bool)
        inside[ends - 1] = inside[ends - 2] = False
        return number[inside[:-2]].astype(np.int32), np.cumsum(lengths - 2) - (lengths - 2)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word rows, trigram numbers, their starts, input vectors)"""
        rows = np.array([self.words.get(w, 0) for w in words], np.int32)
        grams, starts = self.trigrams(words)
        counts = np.maximum(np.diff(np.append(starts, len(grams))), 1)[:, None]
        chars = np.add.reduceat(self.weights["char"][grams], starts, axis=0) / counts
        return rows, grams, starts, np.hstack([self.weights["word"][rows], chars]).astype(np.float32)

    # ------------------------------------------------------------ passes

    def forward(self, projected: np.ndarray, index: np.ndarray, keep: bool = False):
        """Scores (before the logistic) of windows given as rows of ``projected`` [2, words, 3 hidden]; row 0 is none"""
        w, hid, (n, steps) = self.weights, self.hidden, index.shape
        h = np.zeros((2, n, hid), np.float32)
        states = np.empty((steps, 2, n, hid), np.float32)
        tape = []
        for t in range(steps):
            x = np.stack([projected[0][index[:, t]], projected[1][index[:, steps - 1 - t]]])
            u = h @ w["wh"]
            gates = sigmoid(x[:, :, : 2 * hid] + u[:, :, : 2 * hid])
            z, r = gates[:, :, :hid], gates[:, :, hid:]
            fresh = np.tanh(x[:, :, 2 * hid :] + r * u[:, :, 2 * hid :])
            if keep:
                tape.append((h, u[:, :, 2 * hid :], z, r, fresh))
            h = fresh + z * (h - fresh)
            states[t] = h
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)  # steps, windows, 2 hidden
        attention = both @ w["att"]
        attention[index.T == 0] = -1e9
        attention = np.exp(attention - attention.max(0))
        attention /= attention.sum(0)
        pooled = (both * attention[:, :, None]).sum(0)
        score = pooled @ w["out"] + w["bias"]
        return (score, (both, attention, pooled, tape)) if keep else score

    def gradients(self, index: np.ndarray, inputs, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss of windows; word 0 of ``inputs`` stands for none"""
        w, hid, (n, steps) = self.weights, self.hidden, index.shape
        rows, grams, starts, x = inputs
        projected = x @ w["wx"] + w["b"]
        score, (both, attention, pooled, tape) = self.forward(projected, index, keep=True)
        slope = ((sigmoid(score) - labels) / n).astype(np.float32)
        g = {"out": pooled.T @ slope, "bias": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * w["out"]
        d_att = (both * d_pooled).sum(2)
        d_att = attention * (d_att - (attention * d_att).sum(0))
        g["att"] = np.einsum("tn,tnh->h", d_att, both)
        d_both = attention[:, :, None] * d_pooled + d_att[:, :, None] * w["att"]
        d_states = np.stack([d_both[:, :, :hid], d_both[::-1, :, hid:]], axis=1)
        g["wh"], d_x = np.zeros_like(w["wh"]), np.zeros_like(projected)
        d_h = np.zeros((2, n, hid), np.float32)
        for t in range(steps - 1, -1, -1):
            before, u, z, r, fresh = tape[t]
            d_h = d_h + d_states[t]
            d_fresh = d_h * (1 - z) * (1 - fresh**2)
            d_z = d_h * (before - fresh) * z * (1 - z)
            d_r = d_fresh * u * r * (1 - r)
            d_in = np.concatenate([d_z, d_r, d_fresh], axis=2)
            d_u = np.concatenate([d_z, d_r, d_fresh * r], axis=2)
            g["wh"] += np.swapaxes(before, 1, 2) @ d_u
            d_h = d_h * z + d_u @ np.swapaxes(w["wh"], 1, 2)
            np.add.at(d_x[0], index[:, t], d_in[0])
            np.add.at(d_x[1], index[:, steps - 1 - t], d_in[1])
        g["b"] = d_x.sum(1, keepdims=True)
        g["wx"] = x.T @ d_x
        d_input = (d_x @ np.swapaxes(w["wx"], 1, 2)).sum(0)
        g["word"] = np.zeros_like(w["word"])
        np.add.at(g["word"], rows, d_input[:, : self.dim])
        g["word"][0] = 0
        counts = np.diff(np.append(starts, len(grams)))
        g["char"] = np.zeros_like(w["char"])
        shares = d_input[:, self.dim :] / np.maximum(counts, 1)[:, None]
        np.add.at(g["char"], grams, np.repeat(shares, counts, axis=0))
        return g

    # ------------------------------------------------------------ scoring

    def scores(self, texts: list[list[str]], table: "WordTable") -> np.ndarray:
        """Highest window score of each text"""
        index, first = windows([table.numbers(words) for words in texts])
        score = np.concatenate(
            [self.forward(table.projected, index[i : i + 4096]) for i in range(0, len(index), 4096)]
        )
        return np.maximum.reduceat(score, first)


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of texts given as word numbers, filled up with 0, and the first window of each text"""
    rows, first = [], []
    for numbers in texts:
        first.append(len(rows))
        for s in window_starts(len(numbers)):
            rows.append(numbers[s : s + WINDOW])
    out = np.zeros((len(rows), WINDOW), np.int32)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out, np.array(first)


class WordTable:
    """Projected inputs of the words met so far; starts anew when there are too many"""

    def __init__(self, network: Network, most: int = REMEMBERED):
        self.network, self.most = network, most
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.projected = np.repeat(self.network.weights["b"], 1, axis=1)  # row 0: no word

    def learn(self, texts: list[list[str]]) -> None:
        """Make sure that all words of the texts have a number"""
        met = set().union(*texts) if texts else set()
        new = met - self.number.keys()
        if len(self.number) + len(new) > self.most and self.number:
            self._clear()
            new = met
        if new:
            listed = list(new)
            start = self.projected.shape[1]
            _, _, _, x = self.network.inputs(listed)
            more = x @ self.network.weights["wx"] + self.network.weights["b"]
            self.projected = np.concatenate([self.projected, more], axis=1)
            self.number.update(zip(listed, range(start, start + len(listed))))

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.array([self.number[w] for w in words], np.int32)


# ---------------------------------------------------------------- training


def train(texts: list[str], labels: np.ndarray, seed: int = 5, rounds: int = 8, rate: float = 0.01) -> Network:
    """Fit the network to document labels"""
    words = [words_of(t) for t in texts]
    seen = Counter(w for doc in words for w in set(doc))
    least = max(2, int(len(texts) * WORD_SHARE))
    common = sorted((w for w, n in seen.items() if n >= least), key=lambda w: (-seen[w], w))[:MOST_WORDS]
    network = Network({w: i + 1 for i, w in enumerate(common)})
    network.start(seed)
    listed = ["", *sorted({w for doc in words for w in doc})]  # number 0 is no word
    number = {w: i for i, w in enumerate(listed)}
    index, first = windows([np.array([number[w] for w in doc], np.int32) for doc in words])
    owner = np.repeat(np.arange(len(words)), np.diff(np.append(first, len(index))))
    rng, moments = np.random.default_rng(seed), {}
    step = 0
    for turn in range(rounds):
        if turn < 2:
            counts = np.diff(np.append(first, len(index)))
            chosen = np.flatnonzero(counts[owner] <= 2 + 2 * turn)
            chosen = chosen if len(chosen) else np.arange(len(index))
        else:
            chosen = hardest(network, listed, index, owner, labels, rng)
        steps = max(1, len(chosen) // BATCH)
        for _ in range(max(PASSES, -(-LEAST_STEPS // steps))):
            for part in np.array_split(rng.permutation(chosen), steps):
                used, local = np.unique(index[part], return_inverse=True)
                used = used if len(used) and used[0] == 0 else np.append(0, used)
                local = local.reshape(-1, WINDOW) + (0 if 0 in index[part] else 1)
                inputs = network.inputs([listed[i] for i in used])
                inputs[3][0] = 0  # no word
                grads = network.gradients(local, inputs, labels[owner[part]].astype(np.float32))
                step += 1
                adam(network.weights, grads, moments, step, rate)
    return network


def hardest(network: Network, listed: list[str], index, owner, labels, rng) -> np.ndarray:
    """Of each toxic document the highest window; of each clean one the two highest and one at random"""
    x = network.inputs(listed)[3]
    x[0] = 0
    projected = x @ network.weights["wx"] + network.weights["b"]
    score = np.concatenate([network.forward(projected, index[i : i + 4096]) for i in range(0, len(index), 4096)])
    order = np.lexsort((-score, owner))
    rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
    top = order[rank < np.where(labels[owner[order]] == 1, 1, 2)]
    some = order[(rank == 2 + rng.integers(0, 8)) & (labels[owner[order]] == 0)]
    return np.concatenate([top, some])


def adam(weights: dict, grads: dict, moments: dict, step: int, rate: float) -> None:
    for name, g in grads.items():
        m, v = moments.setdefault(name, [np.zeros_like(weights[name]), np.zeros_like(weights[name])])
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        weights[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from: crc32 of the id as text has remainder 1"""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Bounded training sample: up to TOXIC_DOCS and CLEAN_DOCS labelled texts of up to SAMPLE_CHARS characters that are
    not held out, in the order of a hash of their id."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).filter(~held_out("doc_id"))
    texts = docs.select("doc_id", "text").filter(F.length("text") <= SAMPLE_CHARS)
    order = [F.xxhash64("doc_id"), "doc_id", "text"]

    def chosen(mark: int, most: int) -> list:
        # ids first, so that texts of the chosen few only are sorted
        own = marks.filter(F.col("_toxic") == mark).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * most)
        return texts.join(own, "doc_id", "left_semi").orderBy(*order).limit(most).collect()

    toxic, clean = chosen(1, TOXIC_DOCS), chosen(0, CLEAN_DOCS)
    return [r["text"] for r in toxic + clean], np.array([1] * len(toxic) + [0] * len(clean))


def score(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """Add the toxicity score (0 to 1) of the column ``text``; learns from ``labels`` (doc_id, toxic) first"""
    texts, marks = sample(docs, labels)
    if len(set(marks.tolist())) < 2:
        return docs.withColumn(name, F.lit(float(marks.mean()) if len(marks) else 0.0))
    shared = docs.sparkSession.sparkContext.broadcast(train(texts, marks))  # as large as the network

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        table = WordTable(network)
        for batch in slices(batches, "text", 1_000_000):
            found = [words_of(t) if t else [] for t in batch.column("text").to_pylist()]
            table.learn(found)
            yield with_column(batch, name, pa.array(sigmoid(network.scores(found, table).astype(np.float64))))

    return docs.mapInArrow(run, schema_with(docs, name, T.DoubleType()))
