"""Running totals over a whole table in a total order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def running_totals(df: DataFrame, order: Sequence[Column], measures: dict[str, Column]) -> DataFrame:
    """``df`` with, for every measure, its sum over all earlier rows in ``order`` (0 for the first row).

    The rows are laid out in ranges of the order and written once, so that a row keeps its range. Ranges are summed
    to one row each (as many rows as shuffle partitions), and a row adds what its range has before it. ``order`` has
    to tell all rows apart, or equal rows get their places in any order.
    """
    block, names = "_block", list(measures)
    laid = df.withColumns({f"_m_{k}": v for k, v in measures.items()}).repartitionByRange(*order)
    placed = materialize(laid.withColumn(block, F.spark_partition_id()), "ranges")
    totals = placed.groupBy(block).agg(*[F.sum(f"_m_{k}").alias(f"_s_{k}") for k in names])
    earlier = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(block, *[F.sum(f"_s_{k}").over(earlier).alias(f"_o_{k}") for k in names])
    inside = Window.partitionBy(block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    out = placed.join(F.broadcast(offsets), block).withColumns(
        {k: F.coalesce(F.sum(f"_m_{k}").over(inside), zero) + F.coalesce(f"_o_{k}", zero) for k in names}
    )
    return out.drop(block, *[f"_m_{k}" for k in names], *[f"_o_{k}" for k in names])
