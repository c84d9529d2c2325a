"""Neighbour tables: each item's nearest others by cosine, found through an inverted file of lists around centroids.

Vectors become whole numbers (floor of SCALE times the unit vector), so that all sums and products below are exact and
do not depend on the order in which tasks deliver them. The lists' first centroids are a hash sample of the items; each
round puts every item into the list whose centroid is nearest and moves the centroids to the floor of their items' mean,
from sums that every task makes for itself. An item is looked for in the ``share`` of lists nearest to it. Vectors are
compared as blocks, and the whole-number products of whole vectors rank the candidates.

Blocks are dealt by hash, whatever the lists: a row goes to every block of the other side once, not to every list it asks.
The share of lists makes the work grow with the square of the items; what is sent grows with items x items / BLOCK_ROWS.

Equal vectors are one class with its smallest ids, as many as a result can hold, so a vector that many items share is one
row of a list. There are at most about MAX_LISTS lists, whose centroids are all that is sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .skew import lookup_join

SCALE = 10_000
MAX_LISTS = 4096
BLOCK_ROWS = 16_384
LEAST_BLOCKS = 8
SEEN = 1024
# cells are at most SCALE + 1
CELL = "<i2"


def unit_vectors(items: DataFrame, item: str, vector: str) -> DataFrame:
    """(id, u): usable vectors as whole numbers; null, empty, zero or non-finite ones take no part"""
    rows = items.filter(F.col(item).isNotNull()).select(
        F.col(item).cast("bigint").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sound = rows.filter(F.coalesce(finite, F.lit(False))).withColumn("_norm", norm).filter(F.col("_norm") > 0)
    whole = F.transform("v", lambda x: F.floor(x / F.col("_norm") * SCALE).cast("int"))
    return sound.select("id", whole.alias("u"))


def sampled(ids: str, share: float) -> Column:
    """A hash sample: the first eight digits of the id's MD5 as a fraction"""
    digits = F.conv(F.substring(F.md5(F.col(ids).cast("string").cast("binary")), 1, 8), 16, 10).cast("double")
    return digits / F.lit(4294967296.0) < F.lit(share)


def lists_near(u: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """Per row the ``n`` lists with the nearest centroids, the smaller number first among equals"""
    norms = np.sqrt((centroids * centroids).sum(1))
    near = (u @ centroids.T) / np.where(norms > 0, norms, 1.0)
    if n == 1:
        return near.argmax(1)[:, None]
    return np.argsort(-near, axis=1, kind="stable")[:, :n]


def in_lists(classes: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """(cls, first, v, list, asked): the vector's bytes, its nearest list and a bit for each of the ``probes`` nearest"""
    shared = classes.sparkSession.sparkContext.broadcast(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for start in range(0, len(whole), 2048):
                frame = whole.iloc[start : start + 2048]
                u = np.stack(frame["u"].to_numpy())
                near = lists_near(u.astype(np.float64), shared.value, probes)
                asked = np.zeros((len(u), len(shared.value)), bool)
                np.put_along_axis(asked, near, True, 1)
                yield pd.DataFrame({"cls": frame["cls"], "first": frame["first"], "v": [x.tobytes() for x in u.astype(CELL)],
                                    "list": near[:, 0].astype(np.int32),
                                    "asked": [x.tobytes() for x in np.packbits(asked, axis=1)]})

    return classes.select("cls", "first", "u").mapInPandas(run, "cls long, first long, v binary, list int, asked binary")


def moved(classes: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round; a list without items keeps its own"""
    shared = classes.sparkSession.sparkContext.broadcast(centroids)
    width = centroids.shape[1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros(shared.value.shape, np.int64), np.zeros(len(shared.value), np.int64)
        for frame in frames:
            u = np.stack(frame["u"].to_numpy()).astype(np.int64)
            weight = frame["weight"].to_numpy()
            near = lists_near(u.astype(np.float64), shared.value, 1)[:, 0]
            np.add.at(sums, near, u * weight[:, None])
            np.add.at(counts, near, weight)
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"list": used.astype(np.int32), "n": counts[used], "s": list(sums[used])})

    parts = classes.select("u", "weight").mapInPandas(run, "list int, n long, s array<long>")
    totals = parts.groupBy("list").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)])
    out = centroids.copy()
    for row in totals.collect():  # one row for each list
        out[row["list"]] = np.floor(np.array([row[f"s{i}"] for i in range(width)], np.float64) / row["n"])
    return out


def rows_of(cells: pd.Series, kind: object) -> np.ndarray:
    return np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1)


def exact_products(q: np.ndarray, x: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    out = np.empty(len(row), np.int64)
    for i in range(0, len(row), 1 << 16):
        some = slice(i, i + (1 << 16))
        out[some] = np.einsum("ij,ij->i", q[row[some]].astype(np.int64), x[column[some]].astype(np.int64))
    return out


def best_in_block(k: int):
    """Each question's ``k`` best rows of a block of data, of those whose list it asks

    Products in single precision tell which rows can be among them: what they may be off by is added to the bound, which
    is the k-th best of the first SEEN rows. The products of those that remain are whole numbers.
    """

    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(data):
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "cls": pd.Series(dtype="int64"),
                                 "first": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        data = data.sort_values(["first", "cls"])
        q, x = (rows_of(side["v"], CELL) for side in (queries, data))
        single = np.ascontiguousarray(x.T, np.float32)
        own = data["list"].to_numpy()
        longest = [np.sqrt((side.astype(np.int64) ** 2).sum(1).max()) for side in (q, x)]
        off = np.float32(q.shape[1] * 2.0**-22 * longest[0] * longest[1])
        out = []
        for i in range(0, len(q), 256):
            part = q[i : i + 256]
            near = part.astype(np.float32) @ single
            asked = np.unpackbits(rows_of(queries["asked"].iloc[i : i + 256], np.uint8), axis=1).view(bool)
            bound = np.full(len(part), -np.inf, np.float32)
            if len(x) > k:
                seen = np.where(asked[:, own[:SEEN]], near[:, :SEEN], np.float32(-np.inf))
                if seen.shape[1] > k:
                    bound = -np.partition(-seen, k - 1, axis=1)[:, k - 1] - off
            row, column = np.nonzero(near >= bound[:, None])
            can = asked[row, own[column]]
            row, column = row[can], column[can]
            score = exact_products(part, x, row, column)
            # rows stand by their first id, so the column breaks ties by it
            order = np.lexsort((column, -score, row))
            row, column, score = row[order], column[order], score[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            picked = column[best]
            out.append(pd.DataFrame({"query": queries["cls"].to_numpy()[i + row[best]], "cls": data["cls"].to_numpy()[picked],
                                     "first": data["first"].to_numpy()[picked], "score": score[best]}))
        return pd.concat(out)

    return run


def nearest(
    items: DataFrame, item: str, vector: str, k: int = 5, share: float = 2 / 3, rounds: int = 1, lists: int | None = None
) -> DataFrame:
    """(item, neighbor, score): each item's ``k`` nearest others found, equal scores by id.

    ``lists`` defaults to the root of the number of items; ``share`` of them are searched for each item. The default share
    is for vectors without clusters, as measured in the README; clustered ones need far less. Vectors of another length
    than most are left out.
    """
    units = materialize(unit_vectors(items, item, vector), "units")
    widths = units.groupBy(F.size("u").alias("w")).count().orderBy(F.desc("count"), "w").first()
    empty = units.sparkSession.createDataFrame([], f"{item} long, neighbor long, score long")
    if widths is None:
        return empty
    n = widths["count"]
    units = units.filter(F.size("u") == widths["w"])
    listed = units.withColumn("_r", F.row_number().over(Window.partitionBy("u").orderBy("id"))).filter(F.col("_r") <= k + 1)
    ids = listed.groupBy("u").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    weighted = ids.join(units.groupBy("u").agg(F.count(F.lit(1)).alias("weight")), "u")
    numbered = weighted.select(
        F.monotonically_increasing_id().alias("cls"), "u", "ids", F.col("ids")[0].alias("first"), "weight"
    )
    classes = materialize(numbered, "vector_classes")

    wanted = lists or max(1, min(MAX_LISTS, int(np.floor(np.sqrt(n)))))
    # about ``wanted`` rows, told apart by their id
    seeds = units.filter(sampled("id", wanted / n)).collect() or [units.agg(F.min_by(F.struct("id", "u"), "id")).first()[0]]
    centroids = np.array([s["u"] for s in sorted(seeds, key=lambda s: s["id"])], np.float64)
    for _ in range(rounds):
        centroids = moved(classes, centroids)

    probes = max(1, int(np.ceil(len(centroids) * share)))
    listed = materialize(in_lists(classes, centroids, probes), "lists")
    # every block of questions meets every block of data: rows are sent n / BLOCK_ROWS times, to groups of two blocks
    blocks = max(-(-n // BLOCK_ROWS), min(LEAST_BLOCKS, -(-n // 1024)))
    block, every = F.pmod(F.xxhash64("cls"), F.lit(blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = listed.select("cls", "v", "asked", block.alias("q"), every.alias("d"))
    right = listed.select("cls", "first", "v", "list", block.alias("d"), every.alias("q"))
    found = left.groupBy("q", "d").cogroup(right.groupBy("q", "d")).applyInPandas(
        best_in_block(k + 1), "query long, cls long, first long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first", "cls")
    near = materialize(found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1), "near")
    with_ids = near.join(classes.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("neighbor"))
    # at most (k + 1)^2 ids a class
    minus = F.struct((-F.col("score")).alias("minus"), "neighbor")
    answers = with_ids.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(minus)), 1, k + 1).alias("found"))
    named = lookup_join(units, classes.select("u", "cls"), "u", "inner", spread=["id"]).select("id", "cls")
    met = lookup_join(named, answers.withColumnRenamed("query", "cls"), "cls", "inner", spread=["id"])
    others = F.slice(F.filter("found", lambda x: x["neighbor"] != F.col("id")), 1, k)
    out = met.select("id", F.explode(others).alias("x"))
    return out.select(F.col("id").alias(item), F.col("x.neighbor").alias("neighbor"), (-F.col("x.minus")).alias("score"))
