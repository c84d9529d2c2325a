"""Language-model scores by online logistic context mixing, next to a smoothed word model.

The text is lower-cased (A-Z) and read as its tokens: each word's bytes and a blank, at last an end byte that no word can
hold. So the model gives a probability to the very sequence of tokens that the base score is of. A byte is coded as
the bits of its prefix code (as many as the byte is rare), and every bit is predicted by

* corpus predictors: for each of the CONTEXTS (the last two to four bytes of the word, and the whole word so far) the ones
  and zeros seen in the training tokens after that context at that place of the code, in one hashed table;
* document predictors: the same for the word so far, alone and after the word before it, learnt while the document is read.

A prediction is a logarithm of odds. The corpus predictors' are added up with weights from a set that is chosen by how often
the longer contexts were seen (gate); these weights are fitted once to all training words, each word's own count taken
out of what predicts it. The sum and the document predictors are added up by a second set, chosen by what the document has
shown so far, and those weights are moved after every word by the error of the word's bits. The score is the sum of the
bits' log10 probabilities; bits_per_byte is the same as bits for a byte of the lower-cased tokens.

On a cluster the training tokens are counted by word (combined in runs, then shuffled): that table is what the corpus gives,
it grows with the corpus, and all later counting is over its rows, a word's bits counted once with the word's count as
weight. The predictors' table has at most 2^TABLE_BITS slots, 64 for each word below that, and is broadcast as two bytes
a slot. Words counted often (at most FREQUENT of LONGEST bytes) are sent to the tasks for the base score; the others, per
document, are joined with the table of words, hot ones spread. A task reads documents in runs, many at once, word by word.
Every document is read from its first word to its last with what it has taught so far. A task reads the documents of about
TOGETHER words side by side, the longest first, so a long one is in company for as long as there are others.

Cases: null text is an empty one, of the end token alone; rows without doc_id count as the empty id; repeated rows are
scored and counted each; equal texts have equal scores; a corpus without training rows has N = V = 0 and predicts every bit
by what the document shows; very long words are spelled like others; an empty table gives no rows; a column that a
result's name needs is replaced, others are kept except the text.
"""

from __future__ import annotations

import heapq
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import salted_join, slices

END = b"\n"
CONTEXTS = (2, 3, 4, 0)  # bytes of the word before a bit's byte; 0 for all of them
TABLE_BITS = 22
LEAST_BITS = 10
FREQUENT = 1 << 17
LONGEST = 64
WINDOW = 1024
RUN = 3 << 20
LANES = 128
TOGETHER = 4_000_000
HELD = 8_000_000
TOTALLED = 1 << 14
COUNTED = 500_000
SORTED = 1 << 17
CHUNK = 512
WORDS = 2_500

LOCAL_BITS = 13
CERTAIN = 4.0
RATE = np.float32(0.015)
PRIOR = 0.1
START = np.array([[1, 0, 0], [1, 0.2, 0], [1, 0.4, 0], [0.7, 0.3, 0.6]], np.float32)  # per document gate
FIRST_WEIGHT = 0.2
RIDGE = 10.0
NATS = np.log(10)

LOW = 0 if sys.byteorder == "little" else 1
ODD, EVEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
STEP32, MIX32 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words: bytes.lower changes A-Z only, and bytes.split cuts at 20 and 09 to 0D"""
    return text.encode().lower().split() if text else []


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes, each followed by a blank (the end by none), and how many each has"""
    lengths = np.array([len(w) + (w != END) for w in words], np.int64)
    return np.frombuffer(b"".join([w if w == END else w + b" " for w in words]), np.uint8), lengths


class ByteCode:
    """Prefix code of bytes by their counts: for each byte the places of the tree it passes and the bits taken there"""

    def __init__(self, counts: list[int]):
        queue = [(c, i) for i, c in enumerate(counts)]
        heapq.heapify(queue)
        children = {}
        while len(queue) > 1:
            (c, a), (d, b) = heapq.heappop(queue), heapq.heappop(queue)
            children[256 + len(children)] = (a, b)
            heapq.heappush(queue, (c + d, 255 + len(children)))
        paths, open_ = {}, [(queue[0][1], [])]
        while open_:
            at, path = open_.pop()
            if at < 256:
                paths[at] = path
            else:
                open_ += [(child, [*path, (at - 256, bit)]) for bit, child in enumerate(children[at])]
        self.length = np.array([len(paths[b]) for b in range(256)], np.int64)
        self.place = np.zeros((256, self.length.max()), np.uint32)
        self.bit = np.zeros((256, self.length.max()), np.uint8)
        for b, path in paths.items():
            for i, (place, bit) in enumerate(path):
                self.place[b, i], self.bit[b, i] = place, bit
        # run_hash of a byte's bits: of those before each, and of all
        taken = np.arange(self.length.max()) < self.length[:, None]
        terms = np.where(taken, self.bit.astype(np.uint64) + np.uint64(1), np.uint64(0))
        sums = np.cumsum(terms * np.cumprod(np.r_[np.uint64(1), np.full(terms.shape[1] - 1, ODD)]), axis=1, dtype=np.uint64)
        self.before, self.whole = np.hstack([np.zeros((256, 1), np.uint64), sums[:, :-1]]), sums[:, -1].copy()


def run_hash(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every place a hash of the values from place ``first`` on up to, but without, itself"""
    n = len(values)
    powers = np.full(n + 1, ODD, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    back = np.full(n, INVERSE, np.uint64)
    back[:1] = 1
    back = np.cumprod(back, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:n], dtype=np.uint64)])
    return (sums[:-1] - sums[first]) * back[first]


class Bits:
    """The bits of words: values, places in the code, where each word's bits start and how many there are"""

    def __init__(self, words: list[bytes], code: ByteCode):
        self.spell(words)
        self.unfold(code, np.arange(len(self.codes)))
        ends = np.cumsum(self.count)
        last = ends[np.cumsum(self.lengths) - 1]
        self.first = np.concatenate([[0], last[:-1]]).astype(np.int64)
        self.count = last - self.first

    def spell(self, words: list[bytes]) -> None:
        self.codes, self.lengths = spell(words)
        self.start = np.cumsum(self.lengths) - self.lengths
        self.start_of_byte = np.repeat(self.start, self.lengths)
        self.so_far = run_hash(self.codes.astype(np.uint64) + np.uint64(1), self.start_of_byte)

    def unfold(self, code: ByteCode, kept: np.ndarray) -> None:
        """The bits of the bytes at the places ``kept``: where each byte's bits start and how many there are"""
        self.kept, spelled = kept, self.codes[kept]
        self.per_byte = self.count = code.length[spelled]
        ends = np.cumsum(self.count)
        self.first = ends - self.count
        self.inner = np.arange(ends[-1], dtype=np.int32) - np.repeat(self.first.astype(np.int32), self.count)
        self.spelled = np.repeat(spelled, self.count)
        self.place, self.bit = code.place[self.spelled, self.inner], code.bit[self.spelled, self.inner]

    def slots(self, bits: int) -> Iterator[np.ndarray]:
        """Per context the table slot of every bit"""
        off = self.kept - self.start_of_byte[self.kept]
        before = np.zeros(len(off), np.uint64)
        hashes = {0: self.so_far[self.kept]}
        for k in range(1, max(CONTEXTS) + 1):
            # the byte k places before, if the word has begun by then
            previous = np.where(off >= k, self.codes.take(self.kept - k, mode="clip") + np.uint64(1), np.uint64(0))
            before |= previous << np.uint64(9 * (k - 1))
            hashes[k] = before.copy()
        place = self.place * STEP32
        for k in CONTEXTS:
            x = (hashes[k] + np.uint64(7919 * k + 1)) * ODD
            x ^= x >> np.uint64(29)
            base = ((x * EVEN) >> np.uint64(32)).astype(np.uint32)
            slot = np.repeat(base, self.per_byte)
            slot += place
            slot *= MIX32
            slot >>= np.uint32(32 - bits)
            yield slot

    def paths(self) -> np.ndarray:
        """Per bit a hash of the word's bits before it"""
        first = np.repeat(self.first, self.count)
        x = run_hash(self.bit.astype(np.uint64) + np.uint64(1), first) * EVEN
        return (x >> np.uint64(32)).astype(np.uint32)


class SharedBits(Bits):
    """The bits of words, those of a byte once for all words that are the same up to it

    ``of`` is the number of each byte among the different ones; ``first`` and ``count`` are of these, not of words.
    """

    def __init__(self, words: list[bytes], code: ByteCode):
        self.spell(words)
        self.code = code
        self.of, different = pd.factorize(self.so_far * ODD + self.codes)
        kept = np.empty(len(different), np.int64)
        kept[self.of[::-1]] = np.arange(len(self.codes) - 1, -1, -1)
        self.unfold(code, kept)

    def heads(self) -> np.ndarray:
        """Of the words' first bytes, their first bits"""
        return self.first[self.start_of_byte[self.kept] == self.kept]

    def weights(self, c: np.ndarray) -> np.ndarray:
        """How often each bit stands in words that stand ``c`` times"""
        return np.repeat(np.bincount(self.of, np.repeat(c, self.lengths)), self.count)

    def paths(self) -> np.ndarray:
        bits = self.code.length[self.codes]
        ahead = np.cumsum(bits) - bits
        ahead -= ahead[self.start_of_byte]
        powers = np.full(ahead.max() + 1, ODD, np.uint64)
        powers[0] = 1
        power = np.cumprod(powers, dtype=np.uint64)[ahead]
        terms = self.code.whole[self.codes] * power
        sums = np.cumsum(terms, dtype=np.uint64) - terms
        sums -= sums[self.start_of_byte]
        x = self.code.before[self.spelled, self.inner]
        x *= np.repeat(power[self.kept], self.count)
        x += np.repeat(sums[self.kept], self.count)
        x *= EVEN
        return (x >> np.uint64(32)).astype(np.uint32)


def table_bits(distinct: int) -> int:
    return min(TABLE_BITS, max(LEAST_BITS, (64 * distinct).bit_length()))


# ---------------------------------------------------------------- corpus predictors


def small(n: np.ndarray) -> np.ndarray:
    """Counts in a byte: up to 15 as they are, larger ones by their logarithm"""
    large = 16 + np.log2(np.maximum(n, 16) / 16.0) * 4
    return np.where(n < 16, n, np.minimum(large, 255)).astype(np.uint8)


#: what a byte stands for
SIZES = np.where(np.arange(256) < 16, np.arange(256), 16 * 2 ** ((np.arange(256) - 16) / 4.0))
#: places of the gate: how often the whole word so far, the last four and the last three bytes were seen
LEVELS = {3: (1, 3, 20, 300), 2: (1, 30), 1: (3, 100)}
GATES = 5 * 3 * 3


def meanings() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """What a table entry (size, log odds in eighths) stands for: log odds; log odds without a zero or a one; gate steps"""
    size, odds = SIZES[:, None], np.arange(256).astype(np.uint8).view(np.int8)[None, :] / 8.0
    ones = (size + 2 * PRIOR) / (1 + np.exp(-odds)) - PRIOR
    ones = np.clip(np.where(size < 16, np.rint(ones), ones), 0, size)
    without = [np.log((np.maximum(ones - y, 0) + PRIOR) / (np.maximum(size - ones - 1 + y, 0) + PRIOR)) for y in (0, 1)]
    plain = np.broadcast_to(odds, ones.shape)
    steps = [np.searchsorted(np.array(LEVELS[k]), SIZES, side="right").astype(np.int64) for k in LEVELS]
    return plain.ravel().astype(np.float32), np.stack(without).reshape(-1).astype(np.float32), steps


PLAIN, WITHOUT, STEPS = meanings()


class Model:
    """Code, hashed table (a byte of size and a byte of log odds for each slot) and weights by gate"""

    def __init__(self, code: ByteCode, table: np.ndarray, weights: np.ndarray):
        self.code, self.table, self.weights = code, table, weights
        self.bits = len(table).bit_length() - 1

    def inputs(self, bits: Bits, without_own: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
        """Log odds of each corpus predictor for all bits, and the gate"""
        out, gate, levels = [], np.zeros(len(bits.bit), np.int64), dict(zip(LEVELS, STEPS))
        for k, slots in enumerate(bits.slots(self.bits)):
            entry = self.table.take(slots)
            seen = entry >> np.uint16(8)
            if without_own:
                seen = np.where((seen > 0) & (seen < 16), seen - np.uint16(1), seen)
                out.append(WITHOUT.take(entry + (bits.bit.astype(np.int64) << 16)))
            else:
                out.append(PLAIN.take(entry))
            if k in levels:
                gate = gate * (1 + len(LEVELS[k])) + levels[k].take(seen)
        return out, gate

    def corpus_odds(self, bits: Bits) -> np.ndarray:
        """Log odds of every bit by the corpus alone"""
        inputs, gate = self.inputs(bits)
        out = np.zeros(len(gate), np.float32)
        for weight, x in zip(np.ascontiguousarray(self.weights.T), inputs):
            out += weight.take(gate) * x
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """word, c (times in training tokens), n (times in all) from (text, held_out); the end is a word"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter(), Counter()]
        for batch in slices(batches, "text", RUN):
            for text, held in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist()):
                counts[held].update(words_of(text))
                counts[held][END] += 1
            if sum(map(len, counts)) > COUNTED:
                yield from rows_of(counts)
                counts = [Counter(), Counter()]
        yield from rows_of(counts)

    def rows_of(counts: list[Counter]) -> Iterator[pa.RecordBatch]:
        for held, found in enumerate(counts):
            words = list(found)
            n = np.fromiter(found.values(), np.int64, len(words))
            for i in range(0, len(words), 10_000):
                some = pa.array(n[i : i + 10_000])
                c = pa.array(np.zeros(len(some), np.int64)) if held else some
                names = pa.array(words[i : i + 10_000], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([names, c, some], names=["word", "c", "n"])

    counted = docs.select("text", "held_out").mapInArrow(run, "word string, c long, n long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def runs_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for part in slices(batches, "word", 10 * WORDS):
        yield part.column("word").cast(pa.binary()).to_pylist(), part.column("c").to_numpy()


def similar_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The same from words brought into their order, so that those of a run share most of their bytes"""
    held, rows = [], 0
    for batch in batches:
        for part in slices([batch], "word", RUN):
            if held and (rows + part.num_rows > SORTED or sum(h.nbytes for h in held) > RUN):
                yield from runs_of_words(in_order(held))
                held, rows = [], 0
            held.append(part)
            rows += part.num_rows
    if held:
        yield from runs_of_words(in_order(held))


def in_order(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    table = pa.Table.from_batches(held)
    return table.take(pc.sort_indices(table.column("word"))).combine_chunks().to_batches()


def byte_counts(words: DataFrame) -> list[int]:
    """How often each byte stands in the training tokens, and once more"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256)
        for some, c in runs_of_words(batches):
            codes, lengths = spell(some)
            total += np.bincount(codes, np.repeat(c, lengths), 256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total.astype(np.int64))], names=["b", "n"])

    counts = [1] * 256
    for b, n in words.mapInArrow(run, "b long, n long").groupBy("b").agg(F.sum("n")).collect():
        counts[b] += n
    return counts


def predictor_table(words: DataFrame, code: ByteCode, bits: int) -> np.ndarray:
    """Size and log odds by slot, from the weighted bits of all training words"""
    shared = words.sparkSession.sparkContext.broadcast(code)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 << bits, np.int64)
        for some, c in similar_words(batches):
            held = SharedBits(some, shared.value)
            weight, bit = held.weights(c).astype(np.int64), held.bit.astype(np.int64)
            for slots in held.slots(bits):
                np.add.at(counts, 2 * slots.astype(np.int64) + bit, weight)
        counts = counts.reshape(-1, 2 * CHUNK)
        used = np.flatnonzero(counts.any(1))
        for i in range(0, len(used), 1000):
            yield packed(used[i : i + 1000], counts)

    def packed(some: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        small_ = counts[some].max(1) < 1 << 31
        held = [(x.astype(np.int32) if s else x).tobytes() for x, s in zip(counts[some], small_)]
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held, pa.binary())], names=["chunk", "n"])

    rows = words.mapInArrow(run, "chunk int, n binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for chunk, n in zip(*(c.to_pylist() for c in batch.columns)):
                n = np.frombuffer(n, np.int32 if len(n) == 8 * CHUNK else np.int64)
                if chunk in sums:
                    sums[chunk] += n
                else:
                    sums[chunk] = n.astype(np.int64)
        for chunk, n in sums.items():
            zeros, ones = n.reshape(-1, 2).T
            odds = np.clip(np.rint(8 * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)
            entry = small(zeros + ones).astype(np.uint16) << np.uint16(8) | odds.view(np.uint8)
            columns = [pa.array([chunk], pa.int32()), pa.array([entry.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "entry"])

    table = np.zeros(((1 << bits) // CHUNK, CHUNK), np.uint16)
    # at most 2^TABLE_BITS slots of two bytes
    for row in rows.repartition("chunk").mapInArrow(pack, "chunk int, entry binary").toLocalIterator():
        table[row["chunk"]] = np.frombuffer(row["entry"], np.uint16)
    return table.reshape(-1)


def fitted_weights(words: DataFrame, model: Model) -> np.ndarray:
    """Weights by gate after one Newton step over the bits of all training words, own counts taken out"""
    shared = words.sparkSession.sparkContext.broadcast(model)
    k = len(CONTEXTS)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, total = shared.value, np.zeros((k + len(pairs), GATES))
        for some, c in similar_words(batches):
            bits = SharedBits(some, start.code)
            x, gate = start.inputs(bits, without_own=True)
            weight = bits.weights(c).astype(np.float32)
            p = 1 / (1 + np.exp(-np.clip(np.float32(FIRST_WEIGHT) * sum(x), -20, 20)))
            error, spread = weight * (bits.bit - p), weight * p * (1 - p)
            for i in range(k):
                total[i] += np.bincount(gate, error * x[i], GATES)
            for n, (i, j) in enumerate(pairs):
                total[k + n] += np.bincount(gate, spread * x[i] * x[j], GATES)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "x"])

    total = np.zeros((k + len(pairs), GATES))
    for i, x in words.mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x")).collect():
        total.ravel()[i] = x
    out = np.full((GATES, k), FIRST_WEIGHT)
    for g in range(GATES):
        curve = np.eye(k) * RIDGE
        for n, (i, j) in enumerate(pairs):
            curve[i, j] += total[k + n, g]
            curve[j, i] = curve[i, j]
        out[g] += np.linalg.solve(curve, total[:k, g])
    # rounded, so that the order of sums doesn't show
    return np.clip(out, -1, 2).round(4).astype(np.float32)


# ---------------------------------------------------------------- document predictors


def histories() -> tuple[np.ndarray, np.ndarray]:
    """A slot's byte holds zeros and ones seen (up to 15 each): its log odds, and the byte after a zero or a one"""
    zeros, ones = np.divmod(np.arange(256), 16)
    odds = np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)
    after = np.empty((2, 256), np.uint8)
    for bit in (0, 1):
        z, o = zeros + (1 - bit), ones + bit
        full = (z > 15) | (o > 15)
        after[bit] = np.where(full, z // 2 * 16 + o // 2, np.minimum(z, 15) * 16 + np.minimum(o, 15))
    return odds, after


ODDS, AFTER = histories()
AFTER = AFTER.ravel()
#: log odds of the bit that came, a zero's and then a one's
SIGNED = np.concatenate([-ODDS, ODDS])
#: document gates: nothing seen, seen once, seen more often; 3 when the word before was the same
ALONE = np.tile(np.minimum(np.arange(256) // 16 + np.arange(256) % 16, 2).astype(np.uint8), 2)
PAIRED = np.tile(np.where(np.arange(256) > 0, 3, 0).astype(np.uint8), 2)


class Lexicon:
    """The bits of the words a task has met.

    Bits that the corpus is certain of are left to it: the sum of their log probabilities is the word's ``fixed``. Of the
    others, and of each word's first, corpus log odds of the bit's value, path and value stand packed in 64 bits from
    ``first`` on.
    """

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[bytes, int] = {}
        self.packed, self.name = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first, self.count, self.fixed = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def full(self) -> bool:
        return len(self.packed) > HELD

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of different words; those met before keep theirs as long as no more than HELD bits are kept

        Above that the words not asked for are dropped.
        """
        if self.full():
            self.keep([w for w in words if w in self.number])
        new = [w for w in words if w not in self.number]
        # a block shares what its words have in common: more with neighbours by their spelling
        self.add(sorted(new) if len(new) > WORDS else new)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def keep(self, words: list[bytes]) -> None:
        """These words alone, numbered in this order"""
        old = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        first, self.count = self.first[old], self.count[old]
        self.name, self.fixed = self.name[old], self.fixed[old]
        self.first = np.cumsum(self.count) - self.count
        self.packed = self.packed.take(np.repeat(first - self.first, self.count) + np.arange(self.count.sum()))
        self.number = dict(zip(words, range(len(words))))

    def add(self, words: list[bytes]) -> None:
        packed, counts, names, fixed = [self.packed], [self.count], [self.name], [self.fixed]
        for i in range(0, len(words), WORDS):
            bits = SharedBits(words[i : i + WORDS], self.model.code)
            odds, paths = self.model.corpus_odds(bits), bits.paths()
            low = (paths & np.uint32(0xFFFFFFFE)) | bits.bit
            open_ = np.abs(odds) < CERTAIN
            open_[bits.heads()] = True
            np.negative(odds, out=odds, where=bits.bit == 0)
            sure = np.flatnonzero(~open_)
            lost = np.zeros(len(odds), np.float32)
            lost[sure] = -np.log1p(np.exp(-np.clip(odds[sure], -15, 15)))
            # of the different bytes, then of each word's bytes
            lost, n_open = (np.add.reduceat(x, bits.first, dtype=t) for x, t in ((lost, np.float64), (open_, np.int64)))
            here = odds[open_].view(np.uint32).astype(np.uint64) << np.uint64(32) | low[open_]
            count = n_open[bits.of]
            ends = np.cumsum(count)
            at = np.repeat((np.cumsum(n_open) - n_open)[bits.of] - (ends - count), count)
            at += np.arange(ends[-1])
            packed.append(here.take(at))
            counts.append(np.add.reduceat(count, bits.start))
            fixed.append(np.add.reduceat(lost[bits.of], bits.start))
            names.append(low[bits.first + bits.count - 1][bits.of[bits.start + bits.lengths - 1]] * STEP32)
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.packed, self.count = np.concatenate(packed), np.concatenate(counts)
        self.name, self.fixed = np.concatenate(names), np.concatenate(fixed)
        self.first = np.cumsum(self.count) - self.count


def schedule(first: np.ndarray, sizes: np.ndarray, order: np.ndarray, lanes: int, most: int) -> Iterator[list[tuple]]:
    """What is read together, in batches of about ``most`` words: runs of (lanes that start anew, lanes, texts, places)

    Places are of words, a row for each step. A lane reads one text from its first word to its last, then starts anew with
    the longest text left.
    """
    text = order[:lanes].copy()
    at_word, left = first[text], sizes[text]
    live, fresh, given = np.arange(lanes), np.arange(lanes), lanes
    batch, n = [], 0
    while len(live):
        steps = min(left[live].min(), max(1, (most - n) // len(live)))
        batch.append((fresh, live, text[live], at_word[live] + np.arange(steps)[:, None]))
        at_word[live] += steps
        left[live] -= steps
        n += steps * len(live)
        if n >= most or len(batch) > most:
            yield batch
            batch, n = [], 0
        done = live[left[live] == 0]
        fresh = done[: len(order) - given]
        text[fresh] = order[given : given + len(fresh)]
        given += len(fresh)
        at_word[fresh], left[fresh] = first[text[fresh]], sizes[text[fresh]]
        live = live[left[live] > 0]
    if batch:
        yield batch


def read_texts(words: Lexicon, ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probability of texts (runs of word numbers), many read side by side

    What a text has taught so far is known before any weight is, so a batch is read twice: for the slots' states, then for
    the weights; all else is done for the whole batch. All log odds are those of the bit that came, so an error is always
    one minus its probability.
    """
    order = np.argsort(-sizes, kind="stable")
    lanes = min(LANES, len(order))
    # a lane's slots by word, then those by pair of words
    seen = np.zeros((2, lanes, 1 << LOCAL_BITS), np.uint8)
    of_all = seen.reshape(2, -1)
    # an input by pair of words is none but at the last gate, so that is the only weight of it that matters
    by_gate, by_pair = np.empty((lanes, 4), np.float32), np.empty(lanes, np.float32)
    by_word = by_gate.reshape(-1)
    less_corpus = -START[:, 0]
    shift, places = np.uint32(32 - LOCAL_BITS), 4 * lanes
    least, most, one = np.float32(-15), np.float32(15), np.float32(1)
    opens = np.zeros(len(ids), bool)
    opens[first] = True
    out = np.zeros(len(order))
    for batch in schedule(first, sizes, order, lanes, max(1, TOTALLED >> 4)):
        place = np.concatenate([at.ravel() for *_, at in batch])
        lane = np.concatenate([np.tile(live, len(at)) for _, live, _, at in batch])
        texts = np.concatenate([np.tile(text, len(at)) for _, _, text, at in batch])
        now, before = ids.take(place), words.name.take(ids.take(place - 1))
        before[opens.take(place)] = 0
        count = words.count.take(now)
        ends = count.cumsum()
        starts, n = ends - count, ends[-1]
        at = (words.first.take(now) - starts).repeat(count)
        at += np.arange(n)
        halves = words.packed.take(at).view(np.uint32).reshape(n, 2)
        low = halves[:, LOW]
        y = low & np.uint32(1)
        paths = np.empty((2, n), np.uint32)
        np.bitwise_xor(low, y, out=paths[0])
        np.bitwise_xor(paths[0], before.repeat(count), out=paths[1])
        paths *= MIX32
        paths >>= shift
        slots = paths.astype(np.int64)
        lane = lane.repeat(count)
        slots += lane << LOCAL_BITS
        # for each run the lanes that start anew, and where the bits of its steps start and end
        stops, steps, start = ends.tolist(), [], 0
        word = 0
        for fresh, live, _, at in batch:
            spans = []
            for _ in at:
                word += len(live)
                spans.append((start, stop := stops[word - 1], word - len(live), word))
                start = stop
            steps.append((fresh, live, spans))
        y <<= np.uint32(8)
        y = y.astype(np.uint16)
        both = np.empty((2, n), np.int64)
        for table, places_of, slot, moved in zip(seen, of_all, slots, both):
            for fresh, _, spans in steps:
                table[fresh] = 0
                for start, stop, *_ in spans:
                    here = slot[start:stop]
                    states = np.add(places_of.take(here), y[start:stop]).astype(np.int64)
                    moved[start:stop] = states
                    places_of[here] = AFTER.take(states)
        x1, x2 = SIGNED.take(both)
        gate = np.maximum(ALONE.take(both[0]), PAIRED.take(both[1]))
        # log odds of the other bit
        odds = halves[:, 1 - LOW].view(np.float32) * less_corpus.take(gate)
        lane <<= 2
        lane += gate
        for fresh, live, spans in steps:
            by_gate[fresh], by_pair[fresh] = START[:, 1], START[3, 2]
            for start, stop, word, end in spans:
                p, here, input_, pair = odds[start:stop], lane[start:stop], x1[start:stop], x2[start:stop]
                share = by_word.take(here)
                share *= input_
                p -= share
                share = by_pair.take(live).repeat(count[word:end])
                share *= pair
                p -= share
                np.maximum(p, least, out=p)
                np.minimum(p, most, out=p)
                np.exp(p, out=p)
                p += one
                np.divide(one, p, out=p)
                error = one - p
                error *= RATE
                np.multiply(error, input_, out=share)
                by_word += np.bincount(here, share, places)
                error *= pair
                by_pair[live] += np.add.reduceat(error, starts[word:end] - start, dtype=np.float64)
        out += np.bincount(texts, np.add.reduceat(np.log(odds), starts, dtype=np.float64), len(out))
    return out


def log_probabilities(
    words: Lexicon, ids: np.ndarray, first: np.ndarray, sizes: np.ndarray, window: int | None = WINDOW
) -> np.ndarray:
    """log10 probability of each text, a run of word numbers that closes with the end

    The document predictors start anew every ``window`` words; with None they learn from the whole text.
    """
    pieces = -(-sizes // window) if window else np.ones_like(sizes)
    text = np.repeat(np.arange(len(sizes)), pieces)
    off = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * (window or 0)
    lengths = np.minimum(sizes[text] - off, window) if window else sizes
    out = np.zeros(len(sizes))
    np.add.at(out, text, read_texts(words, ids, first[text] + off, lengths))
    out += np.add.reduceat(words.fixed[ids], first) if len(first) else 0
    return out / NATS


# ---------------------------------------------------------------- on the corpus


def frequent_words(words: DataFrame) -> dict[bytes, int]:
    """Training counts of the words that stand most often: at most FREQUENT of LONGEST bytes"""
    short = words.filter(F.octet_length("word") <= LONGEST)
    bucket = F.floor(F.log2(F.col("n").cast("double")) * 4)
    sizes = sorted(short.groupBy(bucket.alias("b")).count().collect(), reverse=True)  # one row a quarter of a doubling
    least, held = None, 0
    for b, n in sizes:
        if held + n > FREQUENT:
            break
        least, held = b, held + n
    if least is None:
        return {}
    return {w.encode(): c for w, c in short.filter(bucket >= least).select("word", "c").collect()}


def scored(docs: DataFrame, model: Model, frequent: dict[bytes, int]) -> DataFrame:
    """The model's score and what the frequent words give to the base; other words with their times in ``_rare``"""
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent))
    rare = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("times", T.LongType())]))
    made = [("n_tokens", T.LongType()), ("_bytes", T.LongType()), ("score", T.DoubleType())]
    made += [("_known", T.LongType()), ("_base", T.DoubleType()), ("_rare", rare)]
    schema = T.StructType([docs.schema["_row"], *[T.StructField(n, t) for n, t in made]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, frequent = shared.value
        lexicon = Lexicon(model)
        held, n_words = [], 0
        # texts of many runs are read together, so that a long one has company to its end
        for batch in slices(batches, "text", RUN):
            if n_words > TOGETHER or lexicon.full():
                yield from finished(lexicon, held)
                held, n_words = [], 0
            ids, *made = of_tokens(lexicon, frequent, *tokens_of(batch.column("text")))
            held.append((batch.column("_row"), ids, made))
            n_words += len(ids)
        yield from finished(lexicon, held)

    def finished(lexicon: Lexicon, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        scores = read_together(lexicon, [(ids, made[0].to_numpy()) for _, ids, made in held])
        for (row, _, (sizes, n_bytes, *others)), score in zip(held, scores):
            yield pa.RecordBatch.from_arrays([row, sizes, n_bytes, pa.array(score), *others], names=schema.names)

    return docs.mapInArrow(run, schema)


def read_together(lexicon: Lexicon, runs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The scores of the texts of each run (word numbers, sizes)"""
    if not runs:
        return []
    sizes = np.concatenate([sizes for _, sizes in runs])
    ids = np.concatenate([ids for ids, _ in runs])
    scores = log_probabilities(lexicon, ids, np.cumsum(sizes) - sizes, sizes, window=None)
    return np.split(scores, np.cumsum([len(sizes) for _, sizes in runs])[:-1])


def of_run(lexicon: Lexicon, frequent: dict[bytes, int], texts: list[list[bytes]]) -> list[pa.Array]:
    """n_tokens, _bytes, score, _known, _base and _rare of texts"""
    ids, sizes, n_bytes, *others = of_texts(lexicon, frequent, texts)
    (score,) = read_together(lexicon, [(ids, sizes.to_numpy())])
    return [sizes, n_bytes, pa.array(score), *others]


def of_texts(lexicon: Lexicon, frequent: dict[bytes, int], texts: list[list[bytes]]) -> list:
    """The same as ``of_tokens`` from lists of words"""
    ids, names = pd.factorize(np.array([w for words in texts for w in words], object))
    return of_tokens(lexicon, frequent, ids, names.tolist(), np.array([len(words) for words in texts], np.int64))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Each token's place among the different ones, these, and how many each text has: ``words_of`` and the end"""
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, offsets = pieces.flatten(), pieces.offsets.to_numpy()
    # blanks at a text's ends leave an empty piece
    kept = pc.greater(pc.binary_length(words), 0)
    ends = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])[offsets[1:] - offsets[0]]
    found = words.filter(kept).dictionary_encode()
    names = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    return np.insert(found.indices.to_numpy(), ends, len(names)), [*names, END], np.diff(ends, prepend=0) + 1


def of_tokens(lexicon: Lexicon, frequent: dict[bytes, int], ids: np.ndarray, names: list[bytes], sizes: np.ndarray) -> list:
    """Word numbers, then n_tokens, _bytes, _known, _base and _rare of texts"""
    first = np.cumsum(sizes) - sizes
    numbers = lexicon.numbers(names).astype(np.int32)[ids]
    c = np.array([frequent.get(w, -1) for w in names], np.int64)
    per_word = [np.array([len(w) + 1 for w in names]), c > 0, np.log10(np.maximum(c, 0) + 1.0)]
    n_bytes, known, base = (np.add.reduceat(x[ids], first, dtype=t) for x, t in zip(per_word, ("i8", "i8", "f8")))
    # the other words: once for each text, with their times
    text = np.repeat(np.arange(len(sizes)), sizes)
    other = c[ids] < 0
    pairs, times = np.unique(text[other] * len(names) + ids[other], return_counts=True)
    words = pa.array(names, pa.binary()).cast(pa.string()).take(pa.array(pairs % len(names)))
    ends = np.searchsorted(pairs // len(names), np.arange(len(sizes) + 1)).astype(np.int32)
    rare = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([words, pa.array(times)], ["word", "times"]))
    # the end is one byte
    return [numbers, *map(pa.array, (sizes, n_bytes - 1, known, base)), rare]


MADE = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def score(docs: DataFrame) -> DataFrame:
    """The columns of (text, held_out, ...) but the text, with MADE; rows with ``held_out`` are not learnt from"""
    kept = [c for c in docs.columns if c != "text" and c not in MADE]
    rows = docs.select(F.struct(*kept).alias("_row"), "text", "held_out")
    words = materialize(count_words(rows), "words")
    learnt = words.filter(F.col("c") > 0).select("word", "c")
    tokens, distinct = learnt.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    code = ByteCode(byte_counts(learnt))
    table = predictor_table(learnt, code, table_bits(distinct))
    first = Model(code, table, np.full((GATES, len(CONTEXTS)), FIRST_WEIGHT, np.float32))
    model = Model(code, table, fitted_weights(learnt, first))

    found = scored(rows, model, frequent_words(words))
    found = materialize(found.withColumn("_id", F.monotonically_increasing_id()), "scored")
    others = found.select("_id", F.explode("_rare").alias("r"))
    rare = others.select("_id", F.col("r.word").alias("word"), F.col("r.times").alias("_t"))
    met = salted_join(rare, words, ["word"], "n", ["_id"])
    log = F.log10(F.col("c") + F.lit(1.0)) * F.col("_t")
    sums = met.groupBy("_id").agg(
        F.sum(F.when(F.col("c") > 0, F.col("_t")).otherwise(0)).alias("_more"), F.sum(log).alias("_add")
    )
    whole = found.drop("_rare").join(sums, "_id", "left")
    share = F.lit(float(np.log10(tokens + distinct + 1.0))) * F.col("n_tokens")
    return whole.select(
        *[F.col("_row").getField(c).alias(c) for c in kept],
        "n_tokens",
        (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_add", F.lit(0.0)) - share).alias("base_score"),
        "score",
        (F.col("score") * F.lit(-1 / np.log10(2)) / F.col("_bytes")).alias("bits_per_byte"),
    )


def is_held_out(doc_id: str = "doc_id"):
    """Whether the rest of the id's checksum by 7 is 2; a null id counts as the empty text"""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2
