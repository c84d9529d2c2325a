"""Small helpers of the operators in this folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
STRIP = " \t\n\x0b\x0c\r"

HOT_SHARE = 1024
HOT_LEAST = 1000
SALTS = 64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sql_strip(text: str) -> str:
    """DuckDB expression that strips the contract's white space at both ends"""
    return f"trim({text}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], weight: str, spread: Sequence[str | Column], how: str = "inner"
) -> DataFrame:
    """Join rows to a table with one row per key, spreading the rows of hot keys over ``SALTS`` tasks.

    ``weight`` is a column of ``small``: how many rows of ``big`` have the key. A key is hot from 1/HOT_SHARE of all
    rows on, so there are at most HOT_SHARE of them, whatever the data; that list of key columns of fixed width is
    all that is broadcast. ``spread`` tells the rows of ``big`` apart; the salt is a hash of it, so a repeated task
    deals a row to the same place. ``small`` should be a written table, for its weights are summed first.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    least = max(HOT_LEAST, total / HOT_SHARE)
    hot = small.filter(F.col(weight) >= least).select(*keys, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
    dealt = big.join(F.broadcast(hot), list(keys), "left").withColumn("_salt", salt).drop("_hot")
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    copies = F.when(F.col(weight) >= least, salts).otherwise(F.slice(salts, 1, 1))
    repeated = small.withColumn("_salt", F.explode(copies))
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``size`` bytes of text, so that memory does not follow row counts"""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with a column put last, instead of one of the same name"""
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [values], names=[*names, name])


def schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """Schema of ``with_column`` results"""
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])
