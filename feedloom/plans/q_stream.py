"""Streaming queries: run until the given tables are taken in, then read what the sinks hold."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cdc
from ..session import run_dir
from ..sources import readers
from ..streaming import jobs, state
from .q_history import MONOTONIC_SQL, parsed_wordtime
from .q_keyed import CELLS, FIRST_SQL, action_rows
from .registry import query
from .views import Views, action_json, cdc_json, cdc_turn_json, wordtime_text

c = F.col


def event_stream(v: Views) -> DataFrame:
    return v.event_rows(v.stream("events"))


def landed(v: Views, df: DataFrame, name: str, **options) -> DataFrame:
    """Drain a stream into files and read them back"""
    out = run_dir(v.spark, name)
    jobs.drain(jobs.to_files(df, out, run_dir(v.spark, f"{name}-checkpoint"), **options))
    return v.spark.read.schema(df.schema).parquet(out)


@query("stream_source_files", "SELECT event_id, user_id, event_type, value FROM events")
def _(v: Views) -> DataFrame:
    return landed(v, v.stream("events").select("event_id", "user_id", "event_type", "value"), "files")


@query("stream_text_lines", "SELECT CAST(user_id AS VARCHAR) AS word, t FROM v_wordtime")
def _(v: Views) -> DataFrame:
    lines = run_dir(v.spark, "lines")
    v.wordtime.select("value").write.text(lines)
    parts = F.split("value", ",")
    rows = readers.stream_text(v.spark, path=lines).select(
        parts[0].alias("word"), parts[1].cast("bigint").alias("t")
    )
    return landed(v, rows, "words")


def _increasing(v: Views, ttl_ms: int) -> DataFrame:
    rows = parsed_wordtime(event_stream(v).select("seq", wordtime_text().alias("value")))
    out = run_dir(v.spark, "increasing")
    sink = state.increasing_sink(out, run_dir(v.spark, "tops"), "user_id", "t", "seq", ttl_ms=ttl_ms)
    jobs.drain(jobs.to_batches(rows, sink, run_dir(v.spark, "increasing-checkpoint")))
    return state.read_kept(v.spark, out, rows.schema)


@query("stream_monotonic_filter", MONOTONIC_SQL)
def _(v: Views) -> DataFrame:
    return _increasing(v, state.STATE_TTL_MS)


@query(
    "stream_state_ttl",
    """SELECT seq, user_id, t FROM (SELECT *, max(t) OVER (PARTITION BY user_id, seq % 2 ORDER BY seq
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM v_wordtime) WHERE t > greatest(coalesce(top, 0), 0)""",
)
def _(v: Views) -> DataFrame:
    """Even arrivals, a pause longer than the expiry, odd arrivals: these start without state"""
    spark, source = v.spark, run_dir(v.spark, "ttl-source")
    out, tops, checkpoint = (run_dir(spark, name) for name in ("ttl", "ttl-tops", "ttl-checkpoint"))
    rows = v.event.select("seq", wordtime_text().alias("value"))

    def take_in() -> None:
        parsed = parsed_wordtime(readers.stream_files(spark, source, rows.schema))
        sink = state.increasing_sink(out, tops, "user_id", "t", "seq", ttl_ms=500)
        jobs.drain(jobs.to_batches(parsed, sink, checkpoint))

    rows.filter(c("seq") % 2 == 0).write.parquet(source)
    take_in()
    time.sleep(1)
    rows.filter(c("seq") % 2 == 1).write.mode("append").parquet(source)
    take_in()
    return state.read_kept(spark, out, "seq bigint, user_id bigint, t bigint")


HALVES = """SELECT user_id, event_type, seq % 2 AS half, max(struct_pack(t_us := t_us, seq := seq)) AS x
  FROM v_event GROUP BY ALL"""


def _latest(v: Views, ttl_ms: int, pause: float) -> DataFrame:
    """Even arrivals, a pause, odd arrivals, over one map state; the last output of each half"""
    spark, source = v.spark, run_dir(v.spark, "map-source")
    out, checkpoint = run_dir(spark, "map"), run_dir(spark, "map-checkpoint")
    rows = v.event.select("user_id", "event_type", "t_us", "seq")

    def take_in() -> None:
        stream = readers.stream_files(spark, source, rows.schema)
        latest = state.latest_per_field(stream, "user_id", "event_type", "t_us", "seq", ttl_ms=ttl_ms)
        with state.map_state_store(spark), jobs.without_idle_batches(spark):
            jobs.drain(jobs.to_files(latest, out, checkpoint))

    rows.filter(c("seq") % 2 == 0).write.parquet(source)
    take_in()
    time.sleep(pause)
    rows.filter(c("seq") % 2 == 1).write.mode("append").parquet(source)
    take_in()
    found = spark.read.schema(rows.select("user_id", "event_type", "t_us", "seq").schema).parquet(out)
    last = found.groupBy("user_id", "event_type", (c("seq") % 2).alias("half")).agg(F.max(F.struct("t_us", "seq")).alias("x"))
    return last.select("user_id", "event_type", "half", "x.t_us", "x.seq")


@query(
    "stream_map_state",
    f"""WITH h AS ({HALVES}) SELECT b.user_id, b.event_type, b.half, b.x.t_us AS t_us, b.x.seq AS seq
        FROM h b LEFT JOIN h a ON a.half = 0 AND b.half = 1 AND a.user_id = b.user_id AND a.event_type = b.event_type
        WHERE a.x IS NULL OR b.x > a.x""",
)
def _(v: Views) -> DataFrame:
    """The odd half shows only what rose: the even half's entries are still there"""
    return _latest(v, 3_600_000, 0)


@query(
    "stream_map_state_ttl",
    f"WITH h AS ({HALVES}) SELECT user_id, event_type, half, x.t_us AS t_us, x.seq AS seq FROM h",
)
def _(v: Views) -> DataFrame:
    """The pause is longer than the expiry, so the odd half starts anew"""
    return _latest(v, 500, 1)


@query(
    "stream_tumbling_count",
    "SELECT t_ms // 5000 * 5000 AS window_start_ms, user_id, count(*) AS n FROM v_event GROUP BY 1, 2",
)
def _(v: Views) -> DataFrame:
    table = run_dir(v.spark, "counts")
    sink = jobs.count_deltas_sink(table, ["user_id"], F.timestamp_millis("t_ms"))
    jobs.drain(jobs.to_batches(event_stream(v), sink, run_dir(v.spark, "counts-checkpoint")))
    return jobs.read_count_deltas(v.spark, table, ["user_id"])


@query(
    "stream_watermark_late",
    """SELECT t_ms // 5000 * 5000 AS window_start_ms, event_type, count(*) AS n FROM v_event
       WHERE t_ms // 5000 * 5000 + 5000 <= (SELECT max(t_ms) - 5 FROM v_event) GROUP BY 1, 2""",
)
def _(v: Views) -> DataFrame:
    spark, source = v.spark, run_dir(v.spark, "late-source")
    out, checkpoint = run_dir(spark, "late"), run_dir(spark, "late-checkpoint")
    rows = v.event.select("event_type", "t_ms")

    def take_in() -> None:
        stream = readers.stream_files(spark, source, rows.schema)
        counts = jobs.tumbling_count(
            stream, ["event_type"], F.timestamp_millis("t_ms"), late="5 milliseconds"
        )
        jobs.drain(jobs.to_files(counts, out, checkpoint))

    rows.write.parquet(source)
    take_in()
    # the same events a second time, forty days older: all behind the watermark by now
    rows.withColumn("t_ms", c("t_ms") - 40 * 86_400_000).write.mode("append").parquet(source)
    take_in()
    return spark.read.schema("window_start_ms bigint, event_type string, n bigint").parquet(out)


@query(
    "stream_late_rows",
    """WITH e AS (SELECT event_type, t_ms FROM v_event UNION ALL SELECT event_type, t_ms - 3456000000 FROM v_event)
       SELECT t_ms // 5000 * 5000 AS window_start_ms, event_type, count(*) AS n,
         t_ms // 5000 * 5000 < (SELECT min(t_ms) FROM v_event) - 86400000 AS before FROM e GROUP BY ALL""",
)
def _(v: Views) -> DataFrame:
    """Events in four batches of any order, then the same ones forty days older: counted and late rows together"""
    spark, source = v.spark, run_dir(v.spark, "late-rows-source")
    counts, late, clock, checkpoint = (run_dir(spark, f"late-rows-{n}") for n in ("counts", "late", "clock", "checkpoint"))
    rows = v.event.select("event_type", "t_ms")
    first = rows.agg(F.min("t_ms")).first()[0]

    def take_in() -> None:
        stream = readers.stream_files(spark, source, rows.schema, files_per_trigger=1)
        sink = jobs.late_aware_sink(counts, late, clock, ["event_type"], F.timestamp_millis("t_ms"), delay_ms=5)
        jobs.drain(jobs.to_batches(stream, sink, checkpoint))

    rows.repartition(4).write.parquet(source)
    take_in()
    rows.withColumn("t_ms", c("t_ms") - 40 * 86_400_000).repartition(2).write.mode("append").parquet(source)
    take_in()
    start = (c("t_ms") - F.pmod(c("t_ms"), F.lit(5000))).alias("window_start_ms")
    apart = jobs.read_late(spark, late).groupBy(start, "event_type").agg(F.count(F.lit(1)).alias("n"))
    both = jobs.read_count_deltas(spark, counts, ["event_type"]).unionByName(apart)
    summed = both.groupBy("window_start_ms", "event_type").agg(F.sum("n").alias("n"))
    return summed.withColumn("before", c("window_start_ms") < F.lit(first - 86_400_000))


@query("stream_restart_exactly_once", "SELECT seq, user_id, t FROM v_wordtime")
def _(v: Views) -> DataFrame:
    spark, source = v.spark, run_dir(v.spark, "restart-source")
    out, checkpoint = run_dir(spark, "restart"), run_dir(spark, "restart-checkpoint")
    rows = v.event.select("seq", "event_type", wordtime_text().alias("value"))

    def take_in() -> None:
        stream = readers.stream_files(spark, source, rows.schema, files_per_trigger=1)
        jobs.drain(jobs.to_files(parsed_wordtime(stream), out, checkpoint))

    first = c("event_type").isin("view", "click")
    rows.filter(first).write.parquet(source)
    take_in()
    rows.filter(~first).write.mode("append").parquet(source)
    take_in()  # from the checkpoint: only what is new
    take_in()  # nothing new
    return spark.read.schema("seq bigint, user_id bigint, t bigint").parquet(out)


UPSERT_SQL = f"""SELECT event_time, {', '.join(f'max_by({x}, seq) AS {x}' for x in CELLS)} FROM v_cdc_rows
  WHERE action_type = 'INSERT' GROUP BY event_time"""


@query("stream_cdc_upsert", UPSERT_SQL)
def _(v: Views) -> DataFrame:
    values = v.stream("orders").select(c("o_orderkey").alias("seq"), cdc_json().alias("value"))
    rows = cdc.cdc_flatten(cdc.cdc_filter(values, "INSERT", "shop", "orders"), "id", keep=("seq",))
    table = run_dir(v.spark, "upserts")
    sink = jobs.upsert_sink(table, "event_time", CELLS, "seq")
    jobs.drain(jobs.to_batches(rows, sink, run_dir(v.spark, "upserts-checkpoint")))
    return jobs.read_upserts(v.spark, table, "event_time", CELLS)


@query("stream_upsert_levels", UPSERT_SQL)
def _(v: Views) -> DataFrame:
    """Six batches in any order of arrival, folded two at a time into runs of up to two levels"""
    spark, source, table = v.spark, run_dir(v.spark, "levels-source"), run_dir(v.spark, "levels")
    values = v.table("orders").select(c("o_orderkey").alias("seq"), cdc_json().alias("value"))
    values.repartition(6, "seq").write.parquet(source)
    stream = readers.stream_files(spark, source, values.schema, files_per_trigger=1)
    rows = cdc.cdc_flatten(cdc.cdc_filter(stream, "INSERT", "shop", "orders"), "id", keep=("seq",))
    sink = jobs.upsert_sink(table, "event_time", CELLS, "seq", fan=2)
    jobs.drain(jobs.to_batches(rows, sink, run_dir(spark, "levels-checkpoint")))
    return jobs.read_upserts(spark, table, "event_time", CELLS)


@query(
    "stream_cdc_files",
    """SELECT concat_ws(chr(9), CAST(req AS VARCHAR), strftime(make_timestamp(req * 1000), '%Y-%m-%d %H:%M:%S'), 'chat',
         'turns', rowkey || '-' || turn, '{"id":"' || rowkey || '-' || turn || '","role":"user"}', 'INSERT') AS line,
       strftime(make_timestamp(req * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d_%H_%M') AS bucket
       FROM v_turn WHERE role = 'user'""",
)
def _(v: Views) -> DataFrame:
    values = v.turn_rows(v.stream("conversations")).select(cdc_turn_json().alias("value"))
    lines = jobs.cdc_file_rows(values, "INSERT", "chat", "turns", "id")
    return landed(v, lines, "cdc-files", partition=["bucket"])


@query(
    "stream_sql_view",
    "SELECT user_id, event_type, value * 2 AS doubled FROM events WHERE event_type = 'purchase'",
)
def _(v: Views) -> DataFrame:
    sql = "SELECT user_id, event_type, value * 2 AS doubled FROM ods_events WHERE event_type = 'purchase'"
    return landed(v, jobs.sql_over_stream(v.stream("events"), "ods_events", sql), "sql-view")


@query("stream_hsetnx", FIRST_SQL)
def _(v: Views) -> DataFrame:
    rows = action_rows(event_stream(v).select("seq", "t_ms", action_json().alias("value")))
    table = run_dir(v.spark, "first")
    sink = jobs.first_write_sink(table, "name", "news_id", "click", "seq")
    jobs.drain(jobs.to_batches(rows, sink, run_dir(v.spark, "first-checkpoint")))
    return jobs.read_first_writes(v.spark, table, "name", "news_id", "click")
