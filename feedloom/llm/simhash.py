"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked when few bits differ.

Candidates come from the generalised pigeonhole principle. The 64 bits are cut into parts, correlated bits together. Part
i gets a threshold t_i (-1: not searched) with sum(t_i) = distance - parts + 1, so two fingerprints within the distance
differ by at most t_i bits in some part. Thresholds are the cheapest by dynamic programming over expected candidates
and probes, which follow from the bits' shares among all fingerprints; so does the number of parts. Fingerprints meet by
(part, value): each stands under its own value and probes the values within t_i of it. Met ones are verified bit by bit.

Documents with one fingerprint are one node, so copies are never paired. A large group of a value is cut into blocks and
every pair of blocks is compared by a task of its own; of a group only the links that hold it together are written, each
on the smallest fingerprint it leads to.

Cases: a null or empty text and one without words have fingerprint zero; fewer words than a shingle are one shingle; rows
with the same doc_id keep their own fingerprints; a null doc_id does not name a component unless all are null; an empty
table gives no rows; ``groups`` returns no other columns, ``keep_first`` all of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import salted_join, schema_with, slices, with_column
from .components import components

BITS = 64
SEED = 42
GROUP_ROWS = 1024


def simhash(text: str, words: int) -> int:
    """Bit b is set when it is set in over half of the shingles' hashes; as a signed integer"""
    found = text.encode().lower().split()  # bytes: only A-Z are lower-cased, only ASCII white space splits
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, name: str = "_fp") -> DataFrame:
    """Add the fingerprint of the column ``text`` as a signed 64-bit integer"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = [simhash(t, words) if t else 0 for t in batch.column("text").to_pylist()]
            yield with_column(batch, name, pa.array(values, pa.int64()))

    return docs.mapInArrow(run, schema_with(docs, name, T.LongType()))


# ---------------------------------------------------------------- parts and thresholds


def bit_statistics(values: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each pair of bits is set together, over all of them.

    A task adds its own up; 64 x 64 sums come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        cells = np.append(both.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    rows = values.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for r in rows:
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into equal parts; a part grows by the bit most correlated with it"""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    relation = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    left = list(range(BITS))
    out = []
    for i in range(parts):
        size = (BITS - sum(map(len, out))) // (parts - i)
        part = [left.pop(0)]
        while len(part) < size:
            best = max(left, key=lambda b: (relation[b, part].sum(), -b))
            left.remove(best)
            part.append(best)
        out.append(sorted(part))
    return out


def within(share: np.ndarray, distance: int) -> np.ndarray:
    """Chance that two fingerprints differ by at most 0, 1 ... ``distance`` of the bits with these shares"""
    exactly = np.zeros(distance + 2)
    exactly[0] = 1.0
    for p in share:
        differ = 2 * p * (1 - p)
        exactly[1:] = exactly[1:] * (1 - differ) + exactly[:-1] * differ
        exactly[0] *= 1 - differ
    return np.cumsum(exactly[: distance + 1])


def allocate(n: int, share: np.ndarray, parts: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """The thresholds with sum distance - parts + 1 of least cost: probes and expected candidates"""
    costs = []
    for part in parts:
        near = within(share[part], distance)
        probes = np.cumsum([comb(len(part), k) for k in range(distance + 1)])
        costs.append([0.0, *(n * probes + 0.5 * n * n * near)])

    @lru_cache(None)
    def best(i: int, rest: int) -> tuple[float, tuple[int, ...]]:
        if i == len(parts):
            return (0.0, ()) if rest == 0 else (np.inf, ())
        found = []
        for t in range(-1, distance + 1):
            cost, chosen = best(i + 1, rest - t)
            found.append((costs[i][t + 1] + cost, (t, *chosen)))
        return min(found)

    cost, chosen = best(0, distance - len(parts) + 1)
    return float(cost), list(chosen)


def plan(values: DataFrame, distance: int, most_parts: int = 4) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to search, for the number of parts that costs least"""
    n, both = bit_statistics(values)
    share = np.diag(both) / max(n, 1)
    tried = []
    for m in range(1, most_parts + 1):
        parts = correlated_parts(n, both, m)
        cost, thresholds = allocate(n, share, parts, distance)
        tried.append((cost, m, list(zip(parts, thresholds))))
    return [(bits, t) for bits, t in min(tried)[2] if t >= 0]


# ---------------------------------------------------------------- probes, groups and links


def mask_of(bits: tuple[int, ...] | list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def probes(values: DataFrame, search: list[tuple[list[int], int]]) -> DataFrame:
    """(part, value, fp): every fingerprint under the values within the threshold of its own, in every part"""
    rows = []
    for i, (bits, t) in enumerate(search):
        flips = [mask_of(c) for k in range(t + 1) for c in combinations(bits, k)]
        own = F.col("fp").bitwiseAND(F.lit(mask_of(bits)).cast("bigint"))
        near = F.transform(
            F.array(*[F.lit(m).cast("bigint") for m in flips]), lambda m: own.bitwiseXOR(m)
        )
        rows.append(F.transform(near, lambda v, i=i: F.struct(F.lit(i).alias("part"), v.alias("value"))))
    return values.select("fp", F.explode(F.flatten(F.array(*rows))).alias("p")).select("p.part", "p.value", "fp")


def group_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that hold the groups together which form among distinct fingerprints, each to the group's smallest"""
    fps = np.sort(fps)
    left = np.ones(len(fps), bool)
    out = []
    for i in range(len(fps)):
        if not left[i]:
            continue
        left[i] = False
        open_ = [i]
        while open_:
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            near = rest[np.bitwise_count((fps[rest] ^ fps[open_.pop()]).view(np.uint64)) <= distance]
            left[near] = False
            open_.extend(near.tolist())
            out.extend((int(fps[j]), int(fps[i])) for j in near)
    return out


def verify(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, value, lo, hi) -> links; a group is at most two blocks"""
    kept: np.ndarray | None = None
    out: list[tuple[int, int]] = []

    def table(links: list[tuple[int, int]]) -> pa.RecordBatch:
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    def groups(rows: np.ndarray, ends: np.ndarray) -> None:
        starts = np.append(0, ends[:-1])
        pairs = ends - starts == 2
        a, b = rows[starts[pairs], 4], rows[starts[pairs] + 1, 4]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
        out.extend(zip(a[near].tolist(), b[near].tolist()))
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            out.extend(group_links(rows[s:e, 4], distance))

    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
        rows = rows if kept is None else np.concatenate([kept, rows])
        changes = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
        if len(changes):
            groups(rows[: changes[-1]], changes)
        kept = rows[changes[-1] :] if len(changes) else rows
        if out:
            yield table(out)
            out = []
    if kept is not None and len(kept):
        groups(kept, np.array([len(kept)]))
    yield table(out)


def links(values: DataFrame, distance: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): enough links between distinct fingerprints within the distance to give all their components"""
    rows = probes(values, plan(values, distance))
    met = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    sized = salted_join(rows, materialize(met, "values"), ["part", "value"], "n", ["fp"])
    # blocks of half the limit; a row goes to every pair of blocks that has its own
    blocks = F.when(F.col("n") <= group_rows, 1).otherwise(F.ceil(F.col("n") / F.lit(group_rows // 2))).cast("bigint")
    own = sized.withColumn("_own", F.pmod(F.xxhash64("fp"), blocks))
    other = own.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    dealt = other.select(
        "part", "value", F.least("_own", "_other").alias("lo"), F.greatest("_own", "_other").alias("hi"), "fp"
    )
    key = ["part", "value", "lo", "hi"]
    in_order = dealt.repartition(*key).sortWithinPartitions(*key)
    return in_order.mapInArrow(lambda b: verify(b, distance), "a long, b long")


def groups(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) of every row, without the texts.

    ``_mark`` is a hash of the text and ``_stays`` holds (without id, doc_id, mark) of the document that stands for the
    component; hot fingerprints and hot components are salted on the way back to the rows.
    """
    marked = docs.select("doc_id", F.xxhash64("text").alias("_mark"), "text")
    hashed = materialize(fingerprints(marked, words).drop("text"), "fingerprints")
    person = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_mark")
    nodes = materialize(
        hashed.groupBy(F.col("_fp").alias("fp")).agg(F.count(F.lit(1)).alias("_n"), F.min(person).alias("_first")),
        "nodes",
    )
    found = components(links(nodes.select("fp"), distance)).withColumnRenamed("node", "fp")
    labeled = materialize(
        nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "labeled"
    )
    firsts = materialize(
        labeled.groupBy("component").agg(F.min("_first").alias("_stays"), F.count(F.lit(1)).alias("_m")), "firsts"
    )
    named = salted_join(labeled.drop("_first"), firsts, ["component"], "_m", ["fp"])
    named = materialize(named.select(F.col("fp").alias("_fp"), "_n", "_stays"), "named")
    return salted_join(hashed, named, ["_fp"], "_n", ["doc_id", "_mark"]).select(
        "doc_id",
        "_mark",
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        F.col("_stays.doc_id").alias("component_id"),
        "_stays",
    )


def keep_first(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """One document of each component: the one with the smallest id, of rows with that id one"""
    stays = groups(docs, words, distance).select(
        F.col("_stays.doc_id").alias("_id"), F.col("_stays._mark").alias("_of"), "doc_id", "_mark"
    )
    kept = stays.filter(F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of")))
    ids = kept.select("_id", "_of").distinct()
    packed = docs.select("doc_id", F.xxhash64("text").alias("_mark"), F.struct(*docs.columns).alias("_row"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of"))
    met = packed.join(ids, same)
    one = Window.partitionBy("doc_id", "_mark").orderBy(F.to_json("_row"))
    return met.withColumn("_rank", F.row_number().over(one)).filter("_rank = 1").select("_row.*")
