"""Hard-negative mining by threshold joins with an inverted index that leaves out what norms can bound.

An anchor's positives are its best rows of the same label, its hard negatives the best rows of other labels whose score
lies within a share of a positive's score. Both are threshold joins: which rows score at least t with an anchor? A block
of rows is indexed by dimension. A row's least components are left out of the index as long as their norm times the
largest anchor norm stays below t: rows that agree on those alone can't reach t. Scores are accumulated dimension by
dimension; after every few of them a pair is dropped when its partial score, plus the product of the remaining norms of
both, plus the row's left-out norm times the anchor's, is below t. What is left is scored exactly, in integers.

Thresholds start high and are lowered, in rounds, for the anchors whose windows are not full: positives from half of the
largest possible score, negatives from just below the upper end of the least positive's window. The last threshold of
either is the lowest score that counts, so nothing is lost. Every round is a written table.

Rows with equal vectors and labels are one class with its smallest ids, as many as a window can hold, and anchors of one
class are answered once. So a vector that a third of all rows share is a single row of a block, and its windows go back to
its anchors by a salted join. Classes are dealt to blocks of at most CELLS components, which meet blocks of anchors.

Cases: rows with a null id, label or vector, or a null or non-finite component take no part; components become
floor(scale * x) as 64-bit integers and products are meant to stay within 64 bits; vectors of different lengths are
compared on their common components, so an empty one scores 0 with all; other rows are those of other ids; a row that
is repeated as a whole counts once; equal scores rank by id; a negative positive score has an empty window; anchors
without positives or negatives give no rows; an empty table gives no rows; other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import salted_join

CELLS = 1 << 19
ANCHORS = 1024
TOGETHER = 64
STEP = 8
FEW = 0.02
PAIRS = 1 << 15
SLACK = 1 + 1e-9
#: thresholds of the rounds: shares of the largest possible score, then of a window's width below its upper end
POSITIVE_ROUNDS = (0.5, 0.25, 0.125, None)
NEGATIVE_ROUNDS = (0.125, 0.5, 1.0)

FOUND = "anchor long, win int, cls long, first long, n int, score long"


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Rows padded with 0 to ``width``"""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Index:
    """Inverted index over the rows of a block for scores of at least ``reach`` times an anchor's norm"""

    def __init__(self, x: np.ndarray, reach: float):
        self.x = x
        n, width = x.shape
        squares = x.astype(np.float64) ** 2
        small = np.argsort(squares, axis=1)
        grown = np.sqrt(np.cumsum(np.take_along_axis(squares, small, 1), axis=1))
        out = grown * SLACK < reach
        # norms of what is left out: the last sum that stays below the reach
        self.left_out = np.where(out, grown, 0.0).max(1, initial=0.0)
        kept = np.ones((n, width), bool)
        np.put_along_axis(kept, small, ~out, 1)
        self.dims = np.argsort(-squares.sum(0), kind="stable")
        self.rows = [np.flatnonzero(kept[:, d]) for d in self.dims]
        self.values = [x[rows, d] for rows, d in zip(self.rows, self.dims)]
        # norms of the indexed components that are still to come after each step
        self.steps = list(range(STEP, width, STEP))
        ordered = np.where(kept, squares, 0.0)[:, self.dims]
        self.to_come = {s: np.sqrt(ordered[:, s:].sum(1)) for s in self.steps}

    def search(self, a: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Rows, anchors and scores of all allowed pairs that score at least their anchor's threshold"""
        squares = a.astype(np.float64) ** 2
        norms = np.sqrt(squares.sum(1))
        by_dim = squares[:, self.dims]
        scores = np.zeros((len(self.x), len(a)), np.int64)
        never = self.left_out[:, None] * norms[None, :]
        alive = allowed
        for i, d in enumerate(self.dims):
            scores[self.rows[i]] += self.values[i][:, None] * a[None, :, d]
            if i + 1 in self.to_come:
                rest = np.sqrt(by_dim[:, i + 1 :].sum(1))
                bound = (self.to_come[i + 1][:, None] * rest[None, :] + never) * SLACK
                alive = allowed & (scores + bound >= least[None, :])
                if alive.mean() < FEW:
                    break
        else:
            alive = allowed & (scores + never * SLACK >= least[None, :])
        rows, anchors = np.nonzero(alive)
        for i in range(0, len(rows), PAIRS):
            r, c = rows[i : i + PAIRS], anchors[i : i + PAIRS]
            exact = (self.x[r] * a[c]).sum(1)
            good = exact >= least[c]
            yield r[good], c[good], exact[good]


def pairs_of(index: Index, a: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
    found = list(index.search(a, least, allowed))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(part) for part in zip(*found))


def best(rows: np.ndarray, groups: np.ndarray, scores: np.ndarray, data: pd.DataFrame, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group, by falling score, then smallest id"""
    first, cls = data["first"].to_numpy()[rows], data["cls"].to_numpy()[rows]
    order = np.lexsort((cls, first, -scores, groups))
    sorted_groups = groups[order]
    starts = np.searchsorted(sorted_groups, sorted_groups)
    return order[np.arange(len(order)) - starts < k]


def answer(anchors: pd.DataFrame, wins: np.ndarray, rows: np.ndarray, scores: np.ndarray, names, data: pd.DataFrame):
    """Found pairs as rows of FOUND"""
    return pd.DataFrame(
        {
            "anchor": names,
            "win": wins.astype(np.int32),
            "cls": data["cls"].to_numpy()[rows],
            "first": data["first"].to_numpy()[rows],
            "n": data["n"].to_numpy()[rows].astype(np.int32),
            "score": scores,
        }
    )


def nothing() -> pd.DataFrame:
    kinds = dict(anchor="int64", win="int32", cls="int64", first="int64", n="int32", score="int64")
    return pd.DataFrame({c: pd.Series(dtype=t) for c, t in kinds.items()})


def same_label(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The best ``k`` rows of a block for each anchor, of its label and at least its threshold"""

    def run(anchors: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = [nothing()]
        if len(anchors) and len(data):
            width = max(map(len, [*anchors["v"], *data["v"]]))
            for label, asked in anchors.groupby("label"):
                rows = data[data["label"] == label]
                if len(rows):
                    out.append(of_label(asked, rows, width))
        return pd.concat(out)

    def of_label(asked: pd.DataFrame, rows: pd.DataFrame, width: int) -> pd.DataFrame:
        a, x = matrix(list(asked["v"]), width), matrix(list(rows["v"]), width)
        least, parts = asked["least"].to_numpy(), [nothing()]
        index = Index(x, reach(a, least))
        for i in range(0, len(a), TOGETHER):
            some, t = a[i : i + TOGETHER], least[i : i + TOGETHER]
            r, c, s = pairs_of(index, some, t, np.ones((len(x), len(some)), bool))
            pick = best(r, c, s, rows, k)
            names = asked["cls"].to_numpy()[i : i + TOGETHER][c[pick]]
            parts.append(answer(asked, np.zeros(len(pick)), r[pick], s[pick], names, rows))
        return pd.concat(parts)

    return run


def reach(a: np.ndarray, least: np.ndarray) -> float:
    """The least threshold of the anchors, as a multiple of the largest anchor norm"""
    norm = np.sqrt((a.astype(np.float64) ** 2).sum(1)).max()
    return least.min() / (norm * SLACK) if norm > 0 else 0.0


def other_labels(k: int, low: int, high: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The best ``k`` rows of a block for each window of each anchor, of other labels and at least its threshold"""

    def run(anchors: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(data):
            return nothing()
        anchors = anchors.sort_values("least").reset_index(drop=True)
        width = max(map(len, [*anchors["v"], *data["v"]]))
        a, x = matrix(list(anchors["v"]), width), matrix(list(data["v"]), width)
        least, labels, names = anchors["least"].to_numpy(), anchors["label"].to_numpy(), anchors["cls"].to_numpy()
        index = Index(x, reach(a, least))
        parts = [nothing()]
        for i in range(0, len(a), TOGETHER):
            chosen = slice(i, i + TOGETHER)
            allowed = data["label"].to_numpy()[:, None] != labels[None, chosen]
            r, c, s = pairs_of(index, a[chosen], least[chosen], allowed)
            for j in range(min(TOGETHER, len(a) - i)):
                mine = c == j
                rows, scores = r[mine], s[mine]
                for score in np.unique(anchors["positives"][i + j]):
                    inside = (low * score <= 100 * scores) & (100 * scores <= high * score)
                    pick = best(rows[inside], np.zeros(inside.sum(), np.int64), scores[inside], data, k)
                    # a window is named by its place among the anchor's positive scores
                    win = np.full(len(pick), np.flatnonzero(np.asarray(anchors["positives"][i + j]) == score)[0])
                    parts.append(
                        answer(anchors, win, rows[inside][pick], scores[inside][pick], names[i + j], data)
                    )
        return pd.concat(parts)

    return run


def meet(anchors: DataFrame, classes: DataFrame, blocks: int, run: Callable) -> DataFrame:
    """Every block of anchors with every block of classes"""
    n = max(1, -(-anchors.count() // ANCHORS))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    deal = lambda k: F.pmod(F.xxhash64("cls"), F.lit(k)).cast("int")
    left = anchors.withColumn("a", deal(n)).withColumn("d", every(blocks)).groupBy("a", "d")
    data = classes.select("cls", "v", "label", "first", F.size("ids").alias("n"))
    right = data.withColumn("d", deal(blocks)).withColumn("a", every(n)).groupBy("a", "d")
    return left.cogroup(right).applyInPandas(run, FOUND)


def first_of(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` classes of each window"""
    order = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "first", "cls")
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


def rounds(
    asked: DataFrame, classes: DataFrame, blocks: int, thresholds: list[Column], run: Callable, k: int, wins: Column
) -> DataFrame:
    """FOUND of all anchors: each threshold in turn for the anchors that have windows with under ``k`` ids.

    ``wins`` is the number of an anchor's windows. The last threshold is final.
    """
    done, open_ = None, asked
    for i, threshold in enumerate(thresholds):
        met = meet(open_.withColumn("least", threshold.cast("double")), classes, blocks, run)
        found = materialize(first_of(met, k), "found")
        if i + 1 < len(thresholds):
            full = found.groupBy("anchor", "win").agg(F.sum("n").alias("n")).filter(F.col("n") >= k)
            full = full.groupBy("anchor").agg(F.count(F.lit(1)).alias("_full")).withColumnRenamed("anchor", "cls")
            judged = open_.join(full, "cls", "left").withColumn("_ok", F.coalesce(F.col("_full") >= wins, F.lit(False)))
            judged = materialize(judged.drop("_full"), "open")
            settled = judged.filter("_ok").select(F.col("cls").alias("anchor"))
            found = found.join(settled, "anchor", "left_semi")
            open_ = judged.filter(~F.col("_ok")).drop("_ok")
        done = found if done is None else done.unionByName(found)
        if i + 1 < len(thresholds) and open_.isEmpty():
            break
    return done


def usable(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, each once"""
    number = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    there = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    sound = there.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), number.alias("v")).filter(finite)
    return sound.withColumn("v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x))).distinct()


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from (vec_id, embedding, label) rows.

    ``is_anchor`` is a condition on ``vec_id``. A negative's score is at least ``low`` and at most ``high`` hundredths
    of the positive's.
    """
    sound = materialize(usable(rows, scale), "usable")
    keep = max(positives + 1, negatives)
    listed = sound.withColumn("_r", F.row_number().over(Window.partitionBy("v", "label").orderBy("vec_id")))
    ids = listed.filter(F.col("_r") <= keep).groupBy("v", "label").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    askers = sound.filter(is_anchor)
    asking = askers.groupBy("v", "label").agg(F.count(F.lit(1)).alias("_askers"))
    named = ids.join(asking, ["v", "label"], "left").select(
        F.monotonically_increasing_id().alias("cls"), "v", "label", "ids", F.col("ids")[0].alias("first"), "_askers"
    )
    classes = materialize(named, "classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size = classes.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm)).first()
    blocks = max(1, -(-size[0] * max(size[1] or 1, 1) // CELLS))
    longest = size[2] or 0.0

    # positives: one more than asked, for an anchor finds its own class
    asked = materialize(classes.filter(F.col("_askers") > 0).select("cls", "v", "label", norm.alias("norm")), "anchors")
    shares = [F.lit(float("-inf")) if s is None else F.col("norm") * F.lit(s * longest) for s in POSITIVE_ROUNDS]
    found = rounds(asked, classes, blocks, shares, same_label(positives + 1), positives + 1, F.lit(1))
    by_id = found.join(classes.select("cls", "ids"), "cls").select("anchor", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = by_id.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= positives + 1)
    # at most positives + 1 entries
    near = ranked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("_r", "id", "score"))).alias("near"))
    near = materialize(near.withColumnRenamed("anchor", "cls"), "positives")

    # negatives: a window for every different score of a positive that has one
    scores = F.array_sort(F.array_distinct(F.filter(F.transform("near", lambda p: p["score"]), lambda s: s >= 0)))
    hungry = asked.join(near, "cls").withColumn("positives", scores).filter(F.size("positives") > 0).drop("near")
    hungry = materialize(hungry, "windows")
    bottom = F.ceil(F.col("positives")[0] * low / F.lit(100))
    top = F.col("positives")[0] * high / F.lit(100)
    steps = [bottom if f == 1.0 else top - (top - bottom) * f for f in NEGATIVE_ROUNDS]
    run = other_labels(negatives, low, high)
    found = rounds(hungry, classes, blocks, steps, run, negatives, F.size("positives"))
    by_id = found.join(classes.select("cls", "ids"), "cls").select("anchor", "win", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id")
    ranked = by_id.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= negatives)
    # at most (positives + 1) * negatives entries
    hard = ranked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("win", "_r", "id", "score"))).alias("hard"))
    lists = near.join(hungry.select("cls", "positives"), "cls").join(hard.withColumnRenamed("anchor", "cls"), "cls")
    lists = materialize(lists.join(classes.select("cls", "_askers"), "cls"), "lists")

    # back to the anchors: one row of a class for many of them
    mapped = salted_join(
        askers, classes.filter(F.col("_askers") > 0).select("v", "label", "cls", "_askers"), ["v", "label"], "_askers", ["vec_id"]
    ).select(F.col("vec_id").alias("anchor_id"), "cls")
    each = salted_join(mapped, lists, ["cls"], "_askers", ["anchor_id"])
    others = F.slice(F.filter("near", lambda p: p["id"] != F.col("anchor_id")), 1, positives)
    pairs = each.select("anchor_id", "positives", "hard", F.explode(others).alias("p"))
    window = F.array_position("positives", F.col("p.score")) - 1
    mine_ = F.filter("hard", lambda h: h["win"] == F.col("_win"))
    out = pairs.withColumn("_win", window).select("anchor_id", "p", F.explode(mine_).alias("h"))
    return out.select(
        "anchor_id",
        F.col("p.id").alias("positive_id"),
        F.col("h._r").alias("rank"),
        F.col("h.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("h.score").alias("negative_score"),
    )


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
