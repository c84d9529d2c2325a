"""Queries over sources and sinks: what was written is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import cdc
from ..session import run_dir
from ..sources import readers, writers
from .q_history import RECALL_SQL, recall_lists
from .registry import query
from .view_sql import java_hash_sql
from .views import Views

c = F.col
START, END = 1_704_412_800_000, 1_706_184_000_000  # 2024-01-05 00:00, 2024-01-25 12:00


@query(
    "scan_time_range",
    """SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00'
       AND ts < TIMESTAMP '2024-01-25 12:00:00' AND ts > TIMESTAMP '2024-01-26 00:00:00' - INTERVAL 3 DAY""",
)
def _(v: Views) -> DataFrame:
    now = 1_706_227_200_000  # 2024-01-26 00:00
    rows = readers.scan_time_range(v.table("events"), "ts", START, END, now_ms=now)
    return rows.select("event_id", "user_id", "event_type")


@query(
    "rowkey_build",
    f"""SELECT seq, lpad(CAST(abs({java_hash_sql("CAST(user_id AS VARCHAR)")}) % 1000 AS VARCHAR), 3, '0')
        || lpad(CAST((t_ms % 259200000) // 1000 AS VARCHAR), 10, '0')
        || lpad(substr(CAST(user_id AS VARCHAR), 1, 9), 9, '0') AS rowkey FROM v_event""",
)
def _(v: Views) -> DataFrame:
    return v.event.select("seq", readers.rowkey(c("user_id"), c("t_ms")).alias("rowkey"))


def _hourly(v: Views) -> str:
    path = run_dir(v.spark, "history")
    at = scalars.ms_to_ntz(c("t_ms"))
    rows = v.event.select(
        "seq", "user_id", F.date_format(at, "yyyy-MM-dd").alias("day"), F.date_format(at, "HH").alias("hour")
    )
    writers.write_partitioned(rows, path, "day", "hour")
    return path


@query(
    "scan_day_hour",
    """SELECT event_id AS seq, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00'
       AND ts < TIMESTAMP '2024-01-25 12:00:00'""",
)
def _(v: Views) -> DataFrame:
    return readers.read_history(v.spark, "HDFS", _hourly(v), START, END).select("seq", "user_id")


@query(
    "latest_partition",
    """SELECT strftime(max(ts), '%Y-%m-%d') AS day, strftime(max(ts), '%H') AS hour FROM events""",
)
def _(v: Views) -> DataFrame:
    return readers.latest_partition(v.spark.read.parquet(_hourly(v)))


@query("catalog_project", "SELECT event_time, primary_key, action_type FROM v_cdc_rows")
def _(v: Views) -> DataFrame:
    spark, path = v.spark, run_dir(v.spark, "catalog")
    rows = cdc.cdc_flatten(cdc.parse_envelope(v.cdc), "id")
    rows.write.parquet(path)
    table = f"cdc_table_{uuid.uuid4().hex}"
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS landed LOCATION '{run_dir(spark, 'landed')}'")
    spark.sql(f"CREATE TABLE landed.{table} USING parquet LOCATION '{path}'")
    try:
        return readers.catalog_project(spark, "landed", table, ["event_time", "primary_key", "action_type"])
    finally:
        spark.catalog.setCurrentDatabase(before)


def _manifest_lines(v: Views) -> DataFrame:
    """A manifest of one feature per brand, with comments and broken lines in between"""
    part = v.table("part")
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    kind = F.when(brand % 3 == 0, "int").when(brand % 3 == 1, "double").otherwise("string")
    line = F.concat(F.lit("feature_"), brand.cast("string"), F.lit("\t "), kind)
    comments = part.select(F.concat(F.lit("# "), "p_name").alias("value")).distinct()
    single = part.select("p_type").distinct()
    return part.select(line.alias("value")).distinct().union(comments).union(single)


@query(
    "text_lines_no_comment",
    """SELECT CASE WHEN p_size % 3 = 0 THEN p_name || '#' ELSE p_type || ' ' || p_name END AS value FROM part
       WHERE p_size % 4 <> 0""",
)
def _(v: Views) -> DataFrame:
    path = run_dir(v.spark, "lines")
    text = F.when(c("p_size") % 3 == 0, F.concat("p_name", F.lit("#"))).otherwise(F.concat_ws(" ", "p_type", "p_name"))
    line = F.concat(F.when(c("p_size") % 4 == 0, "#").otherwise(""), text)
    v.table("part").select(line.alias("value")).write.text(path)
    return readers.text_lines(v.spark, path)


@query(
    "manifest_schema",
    """SELECT DISTINCT 'feature_' || b AS name, 'array<' || CASE b % 3 WHEN 0 THEN 'int' WHEN 1 THEN 'double'
         ELSE 'string' END || '>' AS type FROM
       (SELECT CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b FROM part)""",
)
def _(v: Views) -> DataFrame:
    path = run_dir(v.spark, "manifest")
    _manifest_lines(v).write.text(path)
    return readers.manifest_columns(readers.manifest(readers.text_lines(v.spark, path)))


@query(
    "ddl_csv_roundtrip",
    "SELECT CAST(o_orderkey AS INTEGER) AS a, o_custkey AS b, o_orderpriority AS c FROM orders",
)
def _(v: Views) -> DataFrame:
    spark, path = v.spark, run_dir(v.spark, "tbl1")
    rows = v.table("orders").select(c("o_orderkey").cast("int"), "o_custkey", "o_orderpriority")
    writers.write_csv_once(rows, path)
    one, two = (f"tbl{n}_{uuid.uuid4().hex}" for n in (1, 2))
    readers.csv_table(spark, one, "a INT, b BIGINT, c STRING", path)
    readers.csv_table(spark, two, "a INT, b BIGINT, c STRING", run_dir(spark, "tbl2"))
    spark.sql(f"INSERT INTO {two} SELECT a, b, c FROM {one}")
    return spark.table(two)


@query("csv_sink_roundtrip", "SELECT rowkey, name, segment, bal FROM v_kv")
def _(v: Views) -> DataFrame:
    path = run_dir(v.spark, "csv")
    writers.write_csv_once(v.kv, path)
    return v.spark.read.schema(v.kv.schema).csv(path)


@query(
    "minute_bucket_sink",
    """SELECT strftime(make_timestamp(req * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d_%H_%M') AS bucket, rowkey, turn
       FROM v_turn""",
)
def _(v: Views) -> DataFrame:
    path = run_dir(v.spark, "buckets")
    writers.write_buckets(writers.with_bucket(v.turn, "req").select("bucket", "rowkey", "turn"), path)
    return v.spark.read.schema("rowkey string, turn bigint, bucket string").parquet(path)


@query("insert_overwrite_partition", f"SELECT user_id, articletype, ids, '2024-01-30' AS day, '07' AS hour FROM ({RECALL_SQL})")
def _(v: Views) -> DataFrame:
    spark = v.spark
    table = f"recall_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} (user_id BIGINT, articletype STRING, ids STRING, day STRING, hour STRING) "
        f"USING parquet PARTITIONED BY (day, hour) LOCATION '{run_dir(spark, 'recall')}'"
    )
    rows = recall_lists(v)
    # what an earlier run left in the partition has to be gone afterwards
    stale = v.click.select("user_id", F.lit("stale").alias("articletype"), F.lit("0").alias("ids"))
    writers.overwrite_partition(stale, table, day="2024-01-30", hour="07")
    writers.overwrite_partition(rows, table, day="2024-01-30", hour="07")
    return spark.table(table)


@query("foreach_partition_write", "SELECT rowkey, name, segment, bal FROM v_kv")
def _(v: Views) -> DataFrame:
    path = run_dir(v.spark, "external")
    folder = path.removeprefix("file://").removeprefix("file:")
    writers.foreach_partition_write(v.kv, lambda n: writers.JsonLinesWriter(folder, n))
    return v.spark.read.schema(v.kv.schema).json(path)
