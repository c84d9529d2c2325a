"""Joins and running aggregates that survive a key holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 10 * 1024 * 1024
HOT_KEYS = 100_000
HOT_ROWS = 1_000_000


def estimated_bytes(df: DataFrame) -> int:
    """Size that the optimizer derives from the stored files below a plan; no job is run"""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    **skew: object,
) -> DataFrame:
    """Join a lookup side: as Spark plans it when its files are small, else a join that splits hot keys.

    Below the limit, which is Spark's own for broadcasts, there is no hint: Spark decides by the size it knows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if estimated_bytes(dim) <= max_bytes:
        return fact.join(dim, keys, how)
    return skew_join(fact, dim, keys, how, **skew)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and more than 1/HOT_KEYS of all rows.

    By the second bound there are fewer than ``HOT_KEYS`` of them, so the list may be broadcast whatever the data, and
    every key above the bounds is on it. The count is combined on the map side.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg((F.sum("_n") / HOT_KEYS).alias("_share")).scalar()
    return counts.filter(F.col("_n") > F.greatest(F.lit(float(hot_rows)), F.coalesce(share, F.lit(0.0)))).select(*keys)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int = 64,
    spread: Sequence[str] | None = None,
    count_from: DataFrame | None = None,
    counted: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffle join where the rows of hot left keys are spread over ``salts`` tasks.

    Only keys with more than ``hot_rows`` left rows get salted, and only their right rows are repeated.
    ``spread`` names the left columns that tell rows apart; the salt is a hash of them, so a retried task gives a row the same salt again. ``count_from`` is what the
    keys are counted on when ``left`` is expensive to compute and has the same keys. ``counted`` names some of the keys: rows
    are then counted, and called hot, by these alone, which is cheaper where they are much fewer and misses no hot key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the right side is repeated, so {how!r} would repeat its unmatched rows")
    keys = [on] if isinstance(on, str) else list(on)
    if spread is None:
        spread = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    told = list(counted or keys)
    hot = hot_keys(left if count_from is None else count_from, told, hot_rows).withColumn("_fan", F.lit(salts))
    fan = F.coalesce(F.col("_fan"), F.lit(1))
    salted_left = (
        left.join(F.broadcast(hot), told, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), fan).cast("int"))
        .drop("_fan")
    )
    salted_right = (
        right.join(F.broadcast(hot), told, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - F.lit(1))))
        .drop("_fan")
    )
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def block_offsets(
    df: DataFrame, keys: Sequence[str], block: str, measures: dict[str, Column], combine
) -> DataFrame:
    """For each (keys, block): ``combine`` of every measure over all earlier blocks of the keys.

    The rows are aggregated to one per block first, so the window over a key sees its blocks, not its rows.
    """
    totals = df.groupBy(*keys, block).agg(*[m.alias(name) for name, m in measures.items()])
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, block, *[combine(F.col(m)).over(earlier).alias(m) for m in measures])
