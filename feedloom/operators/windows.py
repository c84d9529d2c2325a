"""Tumbling counts, running collections and the monotonic filter in batch form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import int_div
from .skew import block_offsets


def tumbling_count(df: DataFrame, time: Column, keys: Sequence[str], width: str = "5 seconds") -> DataFrame:
    """Rows per key and time window"""
    return (
        df.groupBy(F.window(time, width).alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.unix_millis("_w.start").alias("window_start_ms"), *keys, "n")
    )


def keyed_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count per key; partial counts are merged after the shuffle"""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def running_collect(df: DataFrame, batch: Column, order: Sequence[str], value: str, name: str) -> DataFrame:
    """The values seen so far in a writer batch, on each row.

    The output of a batch grows with the square of its rows, so ``batch`` has to number batches of a
    fixed size, as the writer does that flushes after so many rows.
    """
    w = (
        Window.partitionBy("_batch")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn("_batch", batch).withColumn(name, F.collect_list(value).over(w)).drop("_batch")


def monotonic_filter(
    df: DataFrame, key: str, time: str, seq: str, block_rows: int = 100_000, emit_first: bool = True,
    start: str | None = None,
) -> DataFrame:
    """Keep a row when its time is greater than every earlier time of its key (by ``seq``).

    The start value is 0, so the first row of a key is kept when its time is positive; with
    ``emit_first=False`` it only sets the state. Each key is cut into blocks of ``seq``; a block's start
    value is the greatest time of the blocks before it. ``start`` names a column with the key's time before all rows,
    null for none.
    """
    rows = df.withColumn("_block", int_div(F.col(seq), block_rows))
    offsets = block_offsets(rows, [key], "_block", {"_before": F.max(time)}, F.max)
    inside = (
        Window.partitionBy(key, "_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    )
    state = F.greatest("_seen", "_before", *([start] if start else []))  # greatest skips nulls
    if emit_first:
        keep = F.col(time) > F.greatest(state, F.lit(0))
    else:
        keep = F.col(time) > state
    return (
        rows.withColumn("_seen", F.max(time).over(inside))
        .join(offsets, [key, "_block"])
        .filter(keep)
        .select(*df.columns)
    )
