"""Suffix-array dedup: bytes covered by a long string that also starts in a document with a smaller id are removed.

Two equal strings of ``length`` bytes have equal anchors: the grams of GRAM bytes whose hash is least among all grams of
the string (leftmost among equals). So a text is cut into pieces, each the run of strings that share an anchor. A piece is
cut once more by whether its strings begin at least half of the possible distance before the anchor; all strings of one
half have about 30 bytes around the anchor in common, the key. Only pieces with the same key can hold equal strings, at
the same distance from the anchor.

The pieces of a key are a collection of short texts, and their suffixes are sorted by column-wise construction: the
texts are laid on each other at the anchor, and in each round, from the last column to the first, one symbol of every
text is put before what has been read. The round's symbols, in the order of the suffixes read so far, are the collection's
Burrows-Wheeler column; sorting them stably gives the order of the longer suffixes, and common prefixes are carried along
as one more than the least common prefix between the two places of a symbol, or 0 where symbols differ. Suffixes that
have a common prefix of ``length`` or more hold the same string; the smallest doc_id among them decides.

On a cluster: keys are counted by (key, smallest and largest doc_id), combined on the map side, and a Bloom filter of
fixed size of the keys found in more than one document lets a second pass over the texts write only pieces that can
matter. Equal pieces become one row with the smallest doc_id before they are sorted. Sorted, shuffled runs on disk take
the part of the sequential external files, and a task reads them in one pass, whole keys at a time. A key with more than
``hot_pieces`` different pieces is not sorted by one task: its strings are compared by a plain aggregate.

Cases: null text counts as empty; texts shorter than ``length`` lose nothing; repeats within a document or between rows
of one doc_id are no reason to remove; rows without doc_id neither lose bytes nor make others lose any; equal rows lose the
same; an empty table gives no rows; ``kept`` is binary, as a cut may split a character; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import salted_join, slices

LENGTH = 50
GRAM = 8
FILTER_BITS = 1 << 27
HOT_PIECES = 100_000
BATCH_PIECES = 50_000
SLICE = 200_000
NONE = 256


# ---------------------------------------------------------------- anchors


def eights(codes: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as an integer; bytes beyond the end are 0"""
    padded = np.concatenate([codes, np.zeros(8, np.uint8)])
    return np.ndarray(len(codes), "<u8", padded, strides=(1,)).copy()


def mixed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of pairs of integers"""
    x = low * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += high * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def hash_of(grams: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` bytes (at least eight) from each place on, from the eight bytes at every place"""
    out = np.full(len(start), size, np.uint64)
    for shift in [*range(0, size - 8, 8), size - 8]:
        out = mixed(out, grams[start + shift])
    return out


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the place of its leftmost least one, by the values' upper 32 bits

    Value and place stand in one integer, so the least of these is leftmost. Windows past the end are not given.
    """
    best, have = values >> np.uint64(32) << np.uint64(32) | np.arange(len(values), dtype=np.uint64), 1
    while have < width:
        shift = min(have, width - have)
        best = np.minimum(best[:-shift], best[shift:])
        have += shift
    return (best & np.uint64(0xFFFFFFFF)).view(np.int64)


def pieces(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int):
    """Pieces of texts that stand one after the other: (text, start, anchor, strings, key), places in ``codes``"""
    long = lengths >= length
    if not long.any():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    grams = eights(codes)
    hashes = mixed(grams, np.uint64(1))
    width = length - GRAM + 1
    half = width // 2
    anchor = least_places(hashes[: len(codes) - GRAM + 1], width)
    early = anchor - np.arange(len(anchor)) >= half  # begins far before the anchor
    # places where a string begins; between two texts there is always a place where none does
    steps = np.zeros(len(anchor) + 1, np.int8)
    steps[starts[long]] = 1
    steps[(starts + lengths)[long] - length + 1] = -1
    inside = np.cumsum(steps[:-1], dtype=np.int8).view(bool)
    change = np.ones(len(anchor) + 1, bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (early[1:] != early[:-1]) | (inside[1:] != inside[:-1])
    begin = np.flatnonzero(inside & change[:-1])
    count = np.flatnonzero(inside & change[1:]) + 1 - begin
    at, is_early = anchor[begin], early[begin]
    key = np.empty(len(begin), np.uint64)
    # what all strings of a half have in common: `half` bytes before the anchor, or what follows from the anchor on
    key[is_early] = hash_of(grams, at[is_early] - half, half + GRAM)
    key[~is_early] = hash_of(grams, at[~is_early], length - half + 1)
    return np.searchsorted(starts, begin, side="right") - 1, begin, at, count, key.view(np.int64)


def laid_out(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a batch's texts one after the other, their starts and lengths"""
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0], np.diff(offsets)


# ---------------------------------------------------------------- Bloom filter of fixed size


def filter_places(keys: np.ndarray) -> list[np.ndarray]:
    """Two places of each key in the filter"""
    bits = FILTER_BITS.bit_length() - 1
    values = keys.view(np.uint64)
    other = values * np.uint64(0xFF51AFD7ED558CCD)
    return [values >> np.uint64(64 - bits), other >> np.uint64(64 - bits)]


def shared_keys(marked: DataFrame, length: int) -> np.ndarray:
    """Filter (FILTER_BITS bits) of the keys of pieces in more than one document.

    The driver gets the filter's words, whatever the data; when it fills up, more pieces are looked at, none is missed.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            codes, starts, lengths = laid_out(batch)
            text, _, _, _, key = pieces(codes, starts, lengths, length)
            ids = batch.column("doc_id").take(pa.array(text))
            yield pa.RecordBatch.from_arrays([pa.array(key), ids], names=["key", "doc_id"])

    seen = marked.select("doc_id", "text").mapInArrow(keys, "key long, doc_id long")
    both = seen.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = materialize(both.filter(F.col("least") < F.col("most")).select("key"), "shared_keys")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(filter_places(batch.column(0).to_numpy(zero_copy_only=False)))
            word, bit = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
            order = np.argsort(word, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(word[order]) != 0)[: len(order)])
            if len(first):
                held = np.bitwise_or.reduceat(bit[order], first).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word[order][first]), pa.array(held)], names=["word", "bits"])

    rows = shared.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def shared_pieces(marked: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, start, key, ahead, piece): pieces whose key stands in several documents.

    ``start`` is the piece's place in its text and ``ahead`` how many bytes before its anchor it begins.
    """
    held = marked.sparkSession.sparkContext.broadcast(shared_keys(marked, length))  # FILTER_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in slices(batches, "text", SLICE):
            codes, starts, lengths = laid_out(batch)
            text, begin, anchor, count, key = pieces(codes, starts, lengths, length)
            wanted = np.ones(len(key), bool)
            for place in filter_places(key):
                wanted &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            text, begin, anchor, count, key = (x[wanted] for x in (text, begin, anchor, count, key))
            if not len(text):
                continue
            raw = codes.tobytes()
            cut = [raw[b : b + c + length - 1] for b, c in zip(begin.tolist(), count.tolist())]
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("mark").take(at),
                    pa.array(begin - starts[text]),
                    pa.array(key),
                    pa.array((anchor - begin).astype(np.int32)),
                    pa.array(cut, pa.binary()),
                ],
                names=["doc_id", "mark", "start", "key", "ahead", "piece"],
            )

    kind = "doc_id long, mark long, start long, key long, ahead int, piece binary"
    return marked.select("doc_id", "mark", "text").mapInArrow(run, kind)


# ---------------------------------------------------------------- column-wise construction


def range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high], both included, from tables of powers of two"""
    span = high - low + 1
    level = np.frexp(span)[1] - 1
    out = np.empty(len(low), values.dtype)
    table, width = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        some = level == k
        out[some] = np.minimum(table[low[some]], table[high[some] - width + 1])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def column_order(symbols: np.ndarray, length: int, rows_of_column) -> None:
    """Sort all suffixes of the texts (rows of ``symbols``, NONE where there is none), a column a round.

    After each round ``rows_of_column(column, order, common)`` gets the rows in the order of their suffixes from that
    column on, and the common prefix of each with the one before it.
    """
    n, columns = symbols.shape
    order, common = np.arange(n), np.zeros(n, np.uint8)
    for column in range(columns - 1, -1, -1):
        read = symbols[order, column]  # the Burrows-Wheeler column of the suffixes so far
        place = np.argsort(read, kind="stable")
        sorted_read = read[place]
        same = np.zeros(n, bool)
        same[1:] = (sorted_read[1:] == sorted_read[:-1]) & (sorted_read[1:] != NONE)
        later = np.flatnonzero(same)
        longer = np.zeros(n, np.uint8)
        if len(later):
            least = range_least(common, place[later - 1] + 1, place[later])
            longer[later] = np.minimum(least, 250) + 1
        order, common = order[place], longer
        rows_of_column(column, order, common)


def smallest_holders(cut: list[bytes], ahead: np.ndarray, doc_id: np.ndarray, length: int) -> list[np.ndarray]:
    """For every piece the smallest doc_id that holds each of its strings, among these pieces"""
    sizes = np.array([len(p) for p in cut])
    left = int(ahead.max())
    width = int((left - ahead + sizes).max())
    flat = np.frombuffer(b"".join(cut), np.uint8)
    row = np.repeat(np.arange(len(cut)), sizes)
    inner = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols = np.full((len(cut), width), NONE, np.uint16)
    symbols[row, (left - ahead)[row] + inner] = flat
    holders = np.repeat(doc_id[:, None], left + 1, axis=1)

    def note(column: int, order: np.ndarray, common: np.ndarray) -> None:
        if column <= left:
            first = np.flatnonzero(common < length)
            least = np.minimum.reduceat(doc_id[order], first)
            holders[order, column] = np.repeat(least, np.diff(np.append(first, len(order))))

    column_order(symbols, length, note)
    counts = sizes - length + 1
    return [holders[i, left - a : left - a + c] for i, (a, c) in enumerate(zip(ahead.tolist(), counts.tolist()))]


def resolve(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Distinct pieces sorted by key -> (k1, k2, copies, holders); reads whole keys, about BATCH_PIECES at a time"""

    def solved(table: pa.Table) -> pa.RecordBatch:
        cut = table.column("piece").to_pylist()
        ids = table.column("least").to_numpy().astype(np.int64)
        key = table.column("key").to_numpy()
        ahead = table.column("ahead").to_numpy().astype(np.int64)
        change = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lone = np.repeat(np.diff(np.append(change, len(key))) == 1, np.diff(np.append(change, len(key))))
        out: list[np.ndarray] = [np.full(len(p) - length + 1, d) for p, d in zip(cut, ids)]
        several = np.flatnonzero(~lone)  # a key with one piece needs no sorting
        if len(several):
            found = smallest_holders([cut[i] for i in several], ahead[several], ids[several], length)
            for i, holders in zip(several.tolist(), found):
                out[i] = holders
        offsets = np.append(0, np.cumsum([len(x) for x in out])).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out)))
        kept = [table.column(c).combine_chunks() for c in ("k1", "k2", "copies")]
        return pa.RecordBatch.from_arrays([*kept, lists], names=["k1", "k2", "copies", "holders"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BATCH_PIECES:
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if last:
                yield solved(table.slice(0, last))
            held = table.slice(last).to_batches()
            rows -= last
    if rows:
        yield solved(pa.Table.from_batches(held).combine_chunks())


def hot_holders(hot: DataFrame, length: int) -> DataFrame:
    """The same for keys with very many pieces: every string is a row, and the smallest doc_id a plain aggregate"""
    strings = F.transform(
        F.sequence(F.lit(1), F.length("piece") - F.lit(length - 1)),
        lambda i: F.struct(i.alias("at"), F.substring(F.col("piece"), i, F.lit(length)).alias("string")),
    )
    rows = hot.select("k1", "k2", "copies", "least", F.explode(strings).alias("s"))
    rows = materialize(rows.select("k1", "k2", "copies", "least", "s.at", "s.string"), "hot_strings")
    least = rows.groupBy("string").agg(F.min("least").alias("holder"), F.count(F.lit(1)).alias("_n"))
    met = salted_join(rows, materialize(least, "hot_least"), ["string"], "_n", ["k1", "k2", "at"])
    holders = F.transform(F.array_sort(F.collect_list(F.struct("at", "holder"))), lambda x: x["holder"])
    return met.groupBy("k1", "k2", "copies").agg(holders.alias("holders"))


# ---------------------------------------------------------------- what goes


def spans_of_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, mark, start, holders) -> runs of covered bytes (doc_id, mark, low, high)"""
    for batch in batches:
        holders = batch.column("holders")
        counts = np.diff(holders.offsets.to_numpy())
        row = np.repeat(np.arange(batch.num_rows), counts)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        goes = holders.flatten().to_numpy() < ids[row]
        before = np.append(False, goes[:-1] & (row[1:] == row[:-1])) if len(row) else goes
        after = np.append(goes[1:] & (row[1:] == row[:-1]), False) if len(row) else goes
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        first, last = np.flatnonzero(goes & ~before), np.flatnonzero(goes & ~after)
        if len(first):
            at, start = row[first], batch.column("start").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[at]),
                    batch.column("mark").take(pa.array(at)),
                    pa.array(start[at] + place[first]),
                    pa.array(start[at] + place[last] + length),
                ],
                names=["doc_id", "mark", "low", "high"],
            )


def cut_spans(batch: pa.RecordBatch) -> list[pa.Array]:
    """kept, n_bytes, n_removed and n_spans (maximal runs removed) of a batch's texts and their ``_spans``"""
    codes, starts, lengths = laid_out(batch)
    spans = batch.column("_spans")
    row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(spans), 0).to_numpy())
    steps = np.zeros(len(codes) + 1, np.int32)
    for name, step in (("low", 1), ("high", -1)):
        np.add.at(steps, starts[row] + spans.flatten().field(name).to_numpy(), step)
    lost = np.cumsum(steps[:-1]) > 0
    # a run goes no further than its text
    begins = lost.copy()
    begins[1:] &= ~lost[:-1]
    first = starts[lengths > 0]
    begins[first] = lost[first]
    n_lost, n_spans = (np.diff(np.append(0, np.cumsum(x))[np.append(starts, len(codes))]) for x in (lost, begins))
    ends = np.append(0, np.cumsum(lengths - n_lost)).astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(codes[~lost])])
    return [kept, *map(pa.array, (lengths, n_lost, n_spans))]


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """(doc_id, mark, spans): runs of bytes of a text that are covered by strings found in smaller doc_ids"""
    if length < 3 * GRAM:
        raise ValueError(f"strings of at least {3 * GRAM} bytes")
    marked = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    name = [F.xxhash64("key", "piece").alias("k1"), F.xxhash64(F.lit(1), "key", "piece").alias("k2")]
    found = materialize(shared_pieces(marked, length), "pieces")
    equal = found.groupBy("key", "ahead", "piece")
    distinct = materialize(equal.agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "distinct")
    hot = materialize(distinct.groupBy("key").count().filter(F.col("count") > hot_pieces).select("key"), "hot_keys")
    usual = distinct.join(hot, "key", "left_anti")
    in_order = usual.repartition("key").sortWithinPartitions("key").select("*", *name)
    kind = "k1 long, k2 long, copies long, holders array<long>"
    holders = in_order.mapInArrow(lambda b: resolve(b, length), kind)
    if not hot.isEmpty():
        named = distinct.join(hot, "key", "left_semi").select("*", *name)
        holders = holders.unionByName(hot_holders(named, length))
    holders = materialize(holders, "holders")
    discard(distinct)
    places = found.select("doc_id", "mark", "start", *name)
    met = salted_join(places, holders, ["k1", "k2"], "copies", ["doc_id", "mark", "start"])
    runs = met.select("doc_id", "mark", "start", "holders").mapInArrow(
        lambda b: spans_of_pieces(b, length), "doc_id long, mark long, low long, high long"
    )
    spans = runs.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    out = materialize(spans, "spans")
    for table in (found, holders):
        discard(table)
    return out


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, hot_pieces: int = HOT_PIECES, keep_text: bool = True
) -> DataFrame:
    """The documents with ``kept`` (binary, the bytes left), ``n_bytes``, ``n_removed`` and ``n_spans``

    Without ``keep_text`` the result has no ``text``, and the whole texts don't come back from the tasks' Python.
    """
    made = ("kept", "n_bytes", "n_removed", "n_spans")
    spans = repeated_spans(docs, length, hot_pieces).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_of"), F.col("spans").alias("_spans")
    )
    rest = [c for c in docs.columns if c not in made]
    packed = docs.select("doc_id", F.xxhash64("text").alias("_mark"), "text", F.struct(*rest).alias("_row"))
    met = packed.join(spans, (F.col("doc_id") == F.col("_id")) & (F.col("_mark") == F.col("_of")), "left")
    lean = met.select(
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        "_spans",
        F.struct(*[F.col("_row").getField(c).alias(c) for c in rest if c != "text"]).alias("_row"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            whole = [batch.column("text")] if keep_text else []
            yield pa.RecordBatch.from_arrays([*whole, batch.column("_row"), *cut_spans(batch)], names=names)

    names = [*(["text"] if keep_text else []), "_row", *made]
    row = lean.schema["_row"].dataType.simpleString()
    kinds = {"text": "binary", "_row": row, "kept": "binary"}
    out = lean.mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))
    text = [F.col("text").cast("string").alias("text")] if keep_text else []
    return out.select(*text, "_row.*", *made).select(*[c for c in rest if keep_text or c != "text"], *made)


SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS row_no, doc_id, encode(coalesce(text, '')) AS raw FROM documents
), s AS (
  SELECT row_no, doc_id, pos, raw[pos : pos + {LENGTH - 1}] AS string, raw[pos : pos] AS byte
  FROM (SELECT *, unnest(range(1, octet_length(raw) + 1)) AS pos FROM t)
), l AS (
  SELECT string, min(doc_id) AS holder FROM s WHERE octet_length(string) = {LENGTH} GROUP BY string
), m AS (
  SELECT row_no, pos, byte, max(CASE WHEN holder < doc_id THEN 1 END) OVER (
    PARTITION BY row_no ORDER BY pos ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS lost
  FROM s LEFT JOIN l USING (string)
), r AS (
  SELECT *, lost AND NOT coalesce(lag(lost) OVER (PARTITION BY row_no ORDER BY pos), false) AS starts FROM m
)
SELECT t.doc_id, count(r.pos)::BIGINT AS n_bytes, count(*) FILTER (lost)::BIGINT AS n_removed,
  count(*) FILTER (starts)::BIGINT AS n_spans,
  sha256(unhex(coalesce(string_agg(hex(byte), '' ORDER BY pos) FILTER (NOT lost), ''))) AS kept_sha256
FROM t LEFT JOIN r USING (row_no) GROUP BY t.row_no, t.doc_id
"""
