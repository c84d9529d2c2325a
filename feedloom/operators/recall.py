"""Recall lists from a user's latest clicks and the neighbours of the clicked items."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import lookup_join


def latest_n(df: DataFrame, user: str | Sequence[str], order: Sequence[Column], n: int = 20) -> DataFrame:
    """The ``n`` latest rows per user (or several key columns) with their rank as ``flag``.

    The filter on the rank lets Spark cut each user to ``n`` rows before the shuffle (window group limit),
    so a user with a third of all rows sends ``n`` rows per map task.
    """
    w = Window.partitionBy(*([user] if isinstance(user, str) else user)).orderBy(*order)
    return df.withColumn("flag", F.row_number().over(w)).filter(F.col("flag") <= n)


def topn_codes(
    weights: DataFrame, row_id: str, key: str, weight: str, n: int, key_code: Callable[[Column], Column]
) -> DataFrame:
    """(row_id, codes): of (row_id, key, weight) rows the ``n`` heaviest keys' codes as text, equal weights by key.

    Rows are cut to ``n`` for each id before they are collected, so no map of all keys is built or sorted.
    """
    top = latest_n(weights, row_id, [F.desc(weight), F.col(key)], n)
    coded = F.struct("flag", key_code(F.col(key)).cast("string").alias("code"))
    lists = top.groupBy(row_id).agg(F.array_sort(F.collect_list(coded)).alias("codes"))
    return lists.select(row_id, F.transform("codes", lambda x: x["code"]).alias("codes"))


def recall_by_neighbors(
    clicks: DataFrame, neighbors: DataFrame, user: str, order: Sequence[Column], n: int = 20
) -> DataFrame:
    """Per user and article type: the distinct neighbours of the user's ``n`` latest clicks, comma-joined.

    An item clicked twice brings its neighbours once, so clicks are made distinct before the join.
    """
    recent = latest_n(clicks, user, order, n).select(user, "news_id").distinct()
    joined = lookup_join(recent, neighbors.select("news_id", "recalled", "articletype"), "news_id", "inner")
    return joined.groupBy(user, "articletype").agg(
        F.array_join(F.array_sort(F.collect_set("recalled")), ",").alias("ids")
    )
