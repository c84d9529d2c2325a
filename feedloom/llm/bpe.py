"""Byte-level BPE encoding and decoding with a given vocabulary file.

A text is cut at the added tokens, then into chunks (a run of characters other than white space with at most one blank
before it, or white space), which are unions of the pieces of the tokenizer's pattern. Pieces are cut further by forced
boundaries: two neighbouring bytes that never stand together inside any vocabulary token can't be merged by any rule, so
the parts between are encoded independently and their ids put one after the other.

The file is read on the driver and sent to the tasks. Chunks that a task does not know are encoded together: one merge
for each fragment a round, as arrays; fragments of over WIDTH bytes go through a queue one by one. Ids of chunks that
stand more than once in a run of texts are kept in a table of at most REMEMBERED bytes, so a worker's memory follows
neither the texts' number nor their words; only a single text is held as a whole. ``code`` and ``round_trip`` encode and
decode in one worker.

Cases: null text is encoded as an empty one (no ids); ids that are null decode to the empty text; unknown ids raise;
bytes that are not UTF-8 decode to the replacement character; a very long text is one row of its own run; repeated rows
are coded each; an existing column of the result's name is replaced, all others are kept; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import schema_with, slices, with_column

# fixed values: the byte-level pattern of the tokenizer and Unicode's white space
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

REMEMBERED = 16 << 20
ENTRY = 250  # bytes of a table entry besides text and ids
WIDTH = 24
ROWS = 20_000
RUN = 1 << 20  # bytes of text encoded at a time
NEVER = np.int32(2**31 - 1)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself where printable, else the next free one from 256"""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """What the file says: bytes of every id, merge rules, added tokens and the table of byte pairs inside tokens"""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        plain = {token: bytes(letters[c] for c in token) for token in model["vocab"]}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = {i: plain[token] for token, i in model["vocab"].items()}
        self.token_bytes |= {i: content.encode() for content, i in self.added.items()}
        self.byte_id = [0] * 256
        for i, token in self.token_bytes.items():
            if len(token) == 1:
                self.byte_id[token[0]] = i
        self.ids = max(self.token_bytes) + 1
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.rules[model["vocab"][a], model["vocab"][b]] = (rank, model["vocab"][a + b])
        # the rules as arrays: sorted pairs with their ranks, and what each rank makes
        pairs = np.array([a * self.ids + b for a, b in self.rules], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], np.array([r for r, _ in self.rules.values()], np.int32)[order]
        self.made = np.zeros(len(model["merges"]) + 1, np.int32)
        for rank, made in self.rules.values():
            self.made[rank] = made
        inside = np.zeros((256, 256), bool)
        for token in plain.values():
            for a, b in zip(token, token[1:]):
                inside[a, b] = True
        self.inside = inside


class Encoder:
    """Encodes texts of one task"""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(PATTERN)
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.known: dict[str, bytes] = {}
        self.held = 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NEVER where no rule merges them or one is missing (-1)"""
        v = self.vocabulary
        if not len(v.pairs):
            return np.full(left.shape, NEVER)
        code = left.astype(np.int64) * v.ids + right
        at = np.minimum(np.searchsorted(v.pairs, code), len(v.pairs) - 1)
        return np.where((v.pairs[at] == code) & (left >= 0) & (right >= 0), v.ranks[at], NEVER)

    def merge_all(self, ids: np.ndarray) -> np.ndarray:
        """Merge the rows of a matrix of ids, padded with -1, one merge for each row a round"""
        done = ids.copy()
        rows = np.arange(len(ids))
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        column = np.arange(ids.shape[1])
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            open_ = best != NEVER
            done[rows[~open_]] = ids[~open_]
            rows, ids, ranks, at, best = rows[open_], ids[open_], ranks[open_], at[open_], best[open_]
            if not len(rows):
                break
            every = np.arange(len(rows))
            # what stands right of the pair moves one place to the left
            moved = column[None, :-1] > at[:, None]
            ids[:, :-1] = np.where(moved, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ids[every, at] = self.vocabulary.made[best]
            ranks[:, :-1] = np.where(moved[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NEVER
            ranks[every, at] = self.rank(ids[every, at], ids[every, at + 1])
            left = at > 0
            before = at[left] - 1
            ranks[every[left], before] = self.rank(ids[every[left], before], ids[every[left], before + 1])
        return done

    def merge(self, fragment: bytes) -> list[int]:
        """Apply merge rules to a fragment, lowest rank first, leftmost among equals"""
        rules = self.vocabulary.rules
        ids: list[int | None] = [self.vocabulary.byte_id[b] for b in fragment]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(*rules[pair], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in rules]
        heapq.heapify(queue)
        while queue:
            _, made, i = heapq.heappop(queue)
            j = after[i] if ids[i] is not None else n
            if j >= n or rules.get((ids[i], ids[j]), (0, None))[1] != made:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = made, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) < n and (pair := (ids[left], ids[right])) in rules:
                    heapq.heappush(queue, (*rules[pair], left))
        return [x for x in ids if x is not None]

    def fragments(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the chunks put together, and where fragments start: at pieces and forced boundaries"""
        lengths = [len(p.encode()) for c in chunks for p in self.pieces.findall(c)]
        codes = np.frombuffer("".join(chunks).encode(), np.uint8)
        starts = np.zeros(len(codes), bool)
        starts[np.cumsum([0, *lengths[:-1]])] = True
        starts[1:] |= ~self.vocabulary.inside[codes[:-1], codes[1:]]
        return codes, np.flatnonzero(starts)

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Packed ids of chunks"""
        codes, starts = self.fragments(chunks)
        lengths = np.diff(np.append(starts, len(codes)))
        first = np.array(self.vocabulary.byte_id, np.int32)[codes]
        short, counts = np.flatnonzero(lengths <= WIDTH), np.zeros(len(starts), np.int64)
        parts, places = [], []
        for i in range(0, len(short), ROWS):
            some = short[i : i + ROWS]
            here = np.arange(WIDTH)[None, :]
            held = here < lengths[some][:, None]
            ids = np.where(held, first[np.minimum(starts[some][:, None] + here, len(codes) - 1)], np.int32(-1))
            merged = self.merge_all(ids)
            counts[some] = (merged >= 0).sum(1)
            parts.append(merged[merged >= 0])
            places.append(some)
        for i in np.flatnonzero(lengths > WIDTH):
            ids = np.array(self.merge(codes[starts[i] : starts[i] + lengths[i]].tobytes()), np.int32)
            counts[i] = len(ids)
            parts.append(ids)
            places.append(np.array([i]))
        ends = np.cumsum(counts)
        out = np.empty(ends[-1], np.int32)
        for ids, some in zip(parts, places):
            n = counts[some]
            inner = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(ends[some] - n, n) + inner] = ids
        packed = out.tobytes()
        chunk_ends = np.cumsum([len(c.encode()) for c in chunks])
        upto = ends[np.searchsorted(starts, chunk_ends) - 1].tolist()
        return {chunk: packed[4 * a : 4 * b] for chunk, a, b in zip(chunks, [0, *upto], upto)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The texts' ids as packed 32-bit integers"""
        added = self.vocabulary.added
        cut = [self.split.split(t) if self.split else [t] for t in texts]
        found = [[[p] if i % 2 else self.chunks.findall(p) for i, p in enumerate(parts)] for parts in cut]
        times = Counter(chain.from_iterable(chunks for parts in found for chunks in parts[::2]))
        new = [c for c in times if c not in self.known]
        learnt = self.learn(new) if new else {}
        self.known.update(learnt)
        ids_of, special = self.known.__getitem__, {k: np.array([i], np.int32).tobytes() for k, i in added.items()}
        out = [
            b"".join([special[chunks[0]] if i % 2 else b"".join(map(ids_of, chunks)) for i, chunks in enumerate(parts)])
            for parts in found
        ]
        for chunk, packed in learnt.items():
            if times[chunk] > 1:
                self.held += ENTRY + 4 * len(chunk) + len(packed)
            else:
                del self.known[chunk]
        if self.held > REMEMBERED:
            self.known, self.held = {}, 0
        return out


class Decoder:
    """Decodes ids: the bytes of all tokens as one buffer with offsets"""

    def __init__(self, vocabulary: Vocabulary):
        tokens = [vocabulary.token_bytes.get(i, b"") for i in range(vocabulary.ids)]
        self.known = np.array([i in vocabulary.token_bytes for i in range(vocabulary.ids)])
        self.buffer = np.frombuffer(b"".join(tokens), np.uint8)
        self.ends = np.cumsum([len(t) for t in tokens])
        self.lengths = np.array([len(t) for t in tokens])

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        if ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all():
            raise ValueError("an id that the vocabulary does not have")
        lengths = self.lengths[ids]
        upto = np.cumsum(lengths)
        places = np.repeat(self.ends[ids] - upto, lengths) + np.arange(upto[-1])
        return self.buffer[places].tobytes().decode("utf-8", "replace")


def packed_lists(packed: list[bytes]) -> pa.Array:
    """Arrow lists of packed 32-bit integers"""
    offsets = pa.array([0, *accumulate(len(p) // 4 for p in packed)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Add the ids (array<int>) of a text column"""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))  # as large as the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in slices(batches, text, RUN):
            packed = encoder.encode([t or "" for t in batch.column(text).to_pylist()])
            yield with_column(batch, name, packed_lists(packed))

    return docs.mapInArrow(run, schema_with(docs, name, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of an id column: the bytes of the tokens put together, read as UTF-8"""
    shared = df.sparkSession.sparkContext.broadcast(Decoder(Vocabulary(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows = [r.values for r in batch.column(ids)]
                texts = [decoder.decode(r.to_numpy(zero_copy_only=False)) if r is not None else "" for r in rows]
                yield with_column(batch, name, pa.array(texts, pa.string()))

    return df.mapInArrow(run, schema_with(df, name, T.StringType()))


def code(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", compare: str | None = None
) -> DataFrame:
    """Add ids and the text they decode to, in one worker; the given text is not returned.

    With ``compare`` the decoded text is not returned either: that column tells whether it equals the text.
    """
    vocabulary = Vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, Decoder(vocabulary)))
    kept = docs.select(*[c for c in docs.columns if c not in (ids, compare or decoded)])
    out = schema_with(kept.drop(text), ids, T.ArrayType(T.IntegerType()))
    last = T.StructField(compare, T.BooleanType()) if compare else T.StructField(decoded, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, decoder = shared.value
        encoder = Encoder(vocabulary)
        for batch in slices(batches, text, RUN):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            packed = encoder.encode(texts)
            again = [decoder.decode(np.frombuffer(p, np.int32)) for p in packed]
            if compare:
                end = pa.array([a == t for a, t in zip(again, texts)], pa.bool_())
            else:
                end = pa.array(again, pa.string())
            names = [n for n in batch.schema.names if n != text]
            columns = [batch.column(n) for n in names] + [packed_lists(packed), end]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, ids, last.name])

    return kept.mapInArrow(run, T.StructType([*out.fields, last]))
