"""Compare a Spark result with the rows of its SQL twin, without regard to order."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

# fixed values: printed type names of the two engines that mean the same
SAME_TYPE = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def compare(got: DataFrame, expected) -> str:
    """'' when both have the same columns, types and rows"""
    columns = sorted(got.columns)
    if columns != sorted(expected.columns):
        return f"columns {columns} != {sorted(expected.columns)}"
    types = {c: SAME_TYPE.get(str(t), str(t)) for c, t in zip(expected.columns, expected.types)}
    spark_types = dict(got.dtypes)
    wrong = [f"{c}: {spark_types[c]} != {types[c]}" for c in columns if spark_types[c] != types[c]]
    order = [expected.columns.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in expected.fetchall())
    have = Counter(tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect())
    if wrong:
        return f"types {wrong}"
    if have != want:
        extra, missing = have - want, want - have
        return (
            f"{sum(have.values())} rows, {sum(want.values())} expected; columns {columns}; "
            f"extra {[str(x)[:300] for x in list(extra)[:2]]}; missing {[str(x)[:300] for x in list(missing)[:2]]}"
        )
    return "" if want else "no rows"
