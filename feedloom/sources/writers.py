"""Sinks: time-bucketed files, csv, training tables, partition overwrite, external writers."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Protocol

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import format_ms

MERGE = "spark.sql.adaptive.coalescePartitions.enabled"


def minute_bucket(ms: Column, zone: str = "Asia/Shanghai") -> Column:
    """The bucket folder of a time: yyyy-MM-dd_HH_mm in ``zone``"""
    return format_ms(ms, "yyyy-MM-dd_HH_mm", zone)


@contextmanager
def unmerged(spark: SparkSession) -> Iterator[None]:
    """Tasks after a shuffle are not merged by their bytes"""
    conf, before = spark.conf, spark.conf.get(MERGE, None)
    conf.set(MERGE, "false")
    try:
        yield
    finally:
        if before is None:
            conf.unset(MERGE)
        else:
            conf.set(MERGE, before)


def write_buckets(df: DataFrame, path: str, bucket: str = "bucket", rows_per_file: int = 1_000_000) -> None:
    """One folder per bucket, files of bounded length.

    The rebalance hint groups a bucket's rows, so that not every task writes into every folder, and splits
    a bucket that is too large for one task. Tasks are not merged by their bytes: many small buckets are few bytes, but a
    file each, and one task would write them all.
    """
    with unmerged(df.sparkSession):
        (
            df.hint("rebalance", bucket)
            .write.mode("overwrite")
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy(bucket)
            .parquet(path)
        )


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def write_csv_once(df: DataFrame, path: str, delimiter: str = ",", single_file: bool = False) -> None:
    """CSV that refuses to overwrite.

    ``single_file`` is the one-file form for small exports; it sends all rows through one task, so it is
    not the default.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("errorifexists").option("sep", delimiter).csv(path)


def write_training(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """The training table, replaced as a whole; any installed format.

    Tasks are not merged by their bytes: before padding a row is small, and padding and writing it is most of the work.
    """
    with unmerged(df.sparkSession):
        df.write.mode("overwrite").format(fmt).options(**options).save(path)


def overwrite_partition(df: DataFrame, table: str, **partition: str) -> None:
    """INSERT OVERWRITE of one static partition"""
    spark = df.sparkSession
    view = f"_overwrite_{abs(hash((table, *partition.items())))}"
    df.createOrReplaceTempView(view)
    spec = ", ".join(f"{k}='{v}'" for k, v in partition.items())
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT {columns} FROM {view}")
    spark.catalog.dropTempView(view)


class RowWriter(Protocol):
    def write(self, row: Row) -> None: ...

    def close(self, ok: bool) -> None: ...


def foreach_partition_write(df: DataFrame, open_writer: Callable[[int], RowWriter]) -> None:
    """One writer per task for all of its rows, closed whatever happens.

    A task can run again after a lost executor, so the writer has to be idempotent per partition number.
    """

    def run(rows: Iterator[Row]) -> None:
        writer = open_writer(TaskContext.get().partitionId())
        ok = False
        try:
            for row in rows:
                writer.write(row)
            ok = True
        finally:
            writer.close(ok)

    df.foreachPartition(run)


class JsonLinesWriter:
    """Rows as JSON lines in a mounted shared folder, published by one rename when the task is done."""

    def __init__(self, folder: str, partition: int):
        os.makedirs(folder, exist_ok=True)
        self._final = os.path.join(folder, f"part-{partition:05d}.json")
        self._draft = os.path.join(folder, f".part-{partition:05d}-{TaskContext.get().taskAttemptId()}")
        self._file = open(self._draft, "w", encoding="utf-8")

    def write(self, row: Row) -> None:
        self._file.write(json.dumps(row.asDict(), ensure_ascii=False) + "\n")

    def close(self, ok: bool) -> None:
        self._file.close()
        if ok:
            os.replace(self._draft, self._final)


def setex_write(df: DataFrame, open_writer: Callable[[int], RowWriter], partitions: int = 50) -> None:
    """Key-value rows to an external store through a fixed number of connections"""
    foreach_partition_write(df.repartition(partitions), open_writer)


def with_bucket(df: DataFrame, ms: str, zone: str = "Asia/Shanghai") -> DataFrame:
    return df.withColumn("bucket", minute_bucket(F.col(ms), zone))
