"""Column statistics from a text spec."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the five aggregate names
AGGREGATES = {"MAX": F.max, "MIN": F.min, "AVG": F.avg, "SUM": F.sum, "COUNT": F.count}


def parse_spec(spec: str) -> list[tuple[str, str]]:
    """'col:MAX,col:MIN' -> [(col, MAX), ...]"""
    out = []
    for part in spec.split(","):
        column, _, kind = part.strip().rpartition(":")
        if not column or kind.upper() not in AGGREGATES:
            raise ValueError(f"bad statistic {part!r}")
        out.append((column, kind.upper()))
    return out


def column_stats(df: DataFrame, spec: str) -> DataFrame:
    """One row with ``<column>_<aggregate>`` per entry, nulls ignored, and the number of rows"""
    aggs = [AGGREGATES[kind](column).alias(f"{column}_{kind.lower()}") for column, kind in parse_spec(spec)]
    return df.agg(*aggs, F.count(F.lit(1)).alias("row_count"))
