"""Streaming jobs: counts, set-if-absent, CDC landing, SQL views."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc, windows
from ..sources.writers import with_bucket
from . import levels


def drain(query: StreamingQuery) -> None:
    """Wait until a query with ``availableNow`` has taken everything in; its error is raised here"""
    query.awaitTermination()


def to_files(df: DataFrame, out: str, checkpoint: str, partition: Sequence[str] = (), fmt: str = "parquet",
             mode: str = "append", interval: str | None = None) -> StreamingQuery:
    """Exactly-once file sink. ``interval`` keeps the query running at that pace, else it drains and stops."""
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).option("path", out)
    if partition:
        writer = writer.partitionBy(*partition)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


@contextmanager
def without_idle_batches(spark: SparkSession) -> Iterator[None]:
    """For draining a query with processing-time timeouts.

    Such a query would start batch after batch to look for timeouts and never end. The setting is read
    when the query starts, so it is put back right after.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def to_console(df: DataFrame, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("console").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def to_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
               interval: str | None = None) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


# ---------------------------------------------------------------- windows


def tumbling_count(
    df: DataFrame, keys: Sequence[str], time: Column | None = None, width: str = "5 seconds", late: str = "0 seconds"
) -> DataFrame:
    """Rows per key and window; closed windows are emitted once the watermark has passed them.

    ``time=None`` counts by processing time.
    """
    clock = F.current_timestamp() if time is None else time
    return (
        df.withColumn("_t", clock)
        .withWatermark("_t", late)
        .groupBy(F.window("_t", width).alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.unix_millis("_w.start").alias("window_start_ms"), *keys, "n")
    )


def count_deltas_sink(
    table: str, keys: Sequence[str], time: Column, width: str = "5 seconds"
) -> Callable[[DataFrame, int], None]:
    """Counts of each batch by window and key; ``read_count_deltas`` adds them up.

    No watermark: a row counts in its window however late it comes, and no state is kept.
    """
    return lambda df, batch_id: write_batch(windows.tumbling_count(df, time, keys, width), table, batch_id)


def read_count_deltas(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    return spark.read.parquet(table).groupBy("window_start_ms", *keys).agg(F.sum("n").alias("n"))


def counts_sink(table: str) -> Callable[[DataFrame, int], None]:
    """Changed counts of each batch (update mode); ``read_counts`` takes the last of each window and key"""
    return lambda df, batch_id: write_batch(df, table, batch_id)


def read_counts(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Counts only grow, so the greatest is the last"""
    return spark.read.parquet(table).groupBy("window_start_ms", *keys).agg(F.max("n").alias("n"))


#: the clock of a job: the greatest event time of the batches so far
CLOCK = levels.Keyed(("name",), ("top_ms",))


def late_aware_sink(
    counts: str, late: str, clock: str, keys: Sequence[str], time: Column, width_ms: int = 5000, delay_ms: int = 0
) -> Callable[[DataFrame, int], None]:
    """Counts by window and key with late rows apart, in place of a watermark that lets them vanish.

    A row is late when its window had ended ``delay_ms`` before the greatest event time of all earlier batches, or when
    it has no time. Late rows are written as they came to ``late``, the others are counted into ``counts``; both have a
    folder for each batch, and every row is in exactly one of them, however the input is cut into batches. The clock is
    kept as a keyed table; a repeated batch reads it as it stood before that batch and replaces its folders.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        levels.compact(spark, clock, CLOCK, before=batch_id)
        folders = levels.paths(spark, clock, before=batch_id)
        top = levels.rows_of(spark, folders, CLOCK).agg(F.max("top_ms")).first()[0] if folders else None
        stamped = df.withColumn("_t", F.unix_millis(time))
        rows = stamped.withColumn("_start", F.col("_t") - F.pmod(F.col("_t"), F.lit(width_ms))).persist()
        over = F.lit(False) if top is None else F.col("_start") + F.lit(width_ms) <= F.lit(top - delay_ms)
        is_late = F.col("_t").isNull() | over
        write_batch(rows.filter(is_late).select(*df.columns), late, batch_id)
        counted = rows.filter(~is_late).groupBy(F.col("_start").alias("window_start_ms"), *keys)
        write_batch(counted.agg(F.count(F.lit(1)).alias("n")), counts, batch_id)
        now = rows.agg(F.greatest(F.max("_t"), F.lit(top).cast("bigint")).alias("top_ms"))
        mark = F.lit(batch_id).cast("bigint").alias("_seq_top_ms")
        write_batch(now.select(F.lit("clock").alias("name"), "top_ms", mark), clock, batch_id)
        rows.unpersist()

    return handle


def read_late(spark: SparkSession, late: str) -> DataFrame:
    """The late rows of all batches"""
    return spark.read.parquet(*[levels.batch_path(late, b) for b in levels.later_batches(spark, late, -1)])


# ---------------------------------------------------------------- keyed tables


def write_batch(df: DataFrame, table: str, batch_id: int) -> None:
    """A batch's rows in a folder of its own; a repeated batch replaces its folder, so it counts once"""
    df.write.mode("overwrite").parquet(levels.batch_path(table, batch_id))


def keyed_sink(
    table: str, keyed: levels.Keyed, seq: str, time: str | None = None, fan: int = levels.FAN
) -> Callable[[DataFrame, int], None]:
    """Write each batch reduced to one row per key; fold folders as they add up (``levels.compact``).

    Only the batch's own keys are written. Rewriting the whole keyed table per micro-batch would cost the size of the
    table, not that of the batch. A batch that is repeated after it was folded is not written again.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if batch_id > levels.manifest(spark, table)["last"]:
            write_batch(keyed.reduced(df, seq, time), table, batch_id)
        levels.compact(spark, table, keyed, fan)

    return handle


def upsert_sink(
    table: str, key: str, cells: Sequence[str], seq: str, fan: int = levels.FAN
) -> Callable[[DataFrame, int], None]:
    """Last write of every cell wins, by ``seq``; ``read_upserts`` gives the table"""
    return keyed_sink(table, levels.Keyed((key,), tuple(cells)), seq, fan=fan)


def read_upserts(spark: SparkSession, table: str, key: str, cells: Sequence[str]) -> DataFrame:
    """The keyed table: the last write of every cell over all batches"""
    return levels.read(spark, table, levels.Keyed((key,), tuple(cells)))


def compact_upserts(spark: SparkSession, table: str, key: str, cells: Sequence[str], target: str) -> None:
    """One merged copy of a keyed table with its sequence numbers, for readers that do not merge"""
    keyed = levels.Keyed((key,), tuple(cells))
    rows = levels.rows_of(spark, levels.paths(spark, table), keyed)
    keyed.merged(rows).write.mode("overwrite").parquet(target)


# ---------------------------------------------------------------- CDC


def cdc_rows(values: DataFrame, action: str, database: str, table: str, primary_key: str,
             zone: str = "UTC") -> DataFrame:
    """CDC messages of one action on one table as rows of seven strings"""
    return cdc.cdc_flatten(cdc.cdc_filter(values, action, database, table), primary_key, zone)


def cdc_file_rows(values: DataFrame, action: str, database: str, table: str, primary_key: str,
                  zone: str = "Asia/Shanghai") -> DataFrame:
    """The same as tab-joined lines with the minute bucket of the message time"""
    rows = cdc_rows(values, action, database, table, primary_key)
    lined = cdc.cdc_lines(rows).withColumn("_ms", F.col("event_time").try_cast("bigint"))
    return with_bucket(lined, "_ms", zone).select("line", "bucket")


# ---------------------------------------------------------------- set if absent


def first_writes(actions: DataFrame, name: str, field: str) -> DataFrame:
    """The first action per (name, field) over the whole stream"""
    return actions.dropDuplicates([name, field])


def first_write_sink(
    table: str, name: str, field: str, value: str, seq: str, fan: int = levels.FAN
) -> Callable[[DataFrame, int], None]:
    """Set-if-absent with the arrival order given by ``seq``; a null is no write"""
    return keyed_sink(table, levels.Keyed((name, field), (value,), first=True), seq, fan=fan)


def read_first_writes(spark: SparkSession, table: str, name: str, field: str, value: str) -> DataFrame:
    return levels.read(spark, table, levels.Keyed((name, field), (value,), first=True))


# ---------------------------------------------------------------- SQL


def sql_over_stream(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Name a stream as a table and query it with SQL; the result is a stream again"""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
