"""Scans: time ranges, day/hour folders, catalog tables, text lines, streams."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import bucket_mod_of_abs, java_hash
from ..functions.scalars import int_div

KEYED_TTL_MS = 259_200_000


def ntz_literal(ms: int) -> Column:
    """Epoch ms -> zone-less timestamp literal, which the parquet reader can push down"""
    at = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=ms)
    return F.expr(f"TIMESTAMP_NTZ'{at:%Y-%m-%d %H:%M:%S}.{at.microsecond:06d}'")


def scan_time_range(df: DataFrame, time: str, start_ms: int, end_ms: int, now_ms: int | None = None,
                    ttl_ms: int = KEYED_TTL_MS) -> DataFrame:
    """Rows with time in [start, end); with ``now_ms`` also not older than the table's lifetime"""
    out = df.filter((F.col(time) >= ntz_literal(start_ms)) & (F.col(time) < ntz_literal(end_ms)))
    if now_ms is not None:
        out = out.filter(F.col(time) > ntz_literal(now_ms - ttl_ms))
    return out


def rowkey(user: Column, ms: Column, ttl_ms: int = KEYED_TTL_MS, buckets: int = 1000) -> Column:
    """3-digit bucket, 10-digit second within the lifetime, 9 characters of the user id

    The bucket is a hash of the user id, so that writes of one second spread over all buckets.
    """
    user = user.cast("string")
    bucket = F.lpad(bucket_mod_of_abs(java_hash(user), buckets).cast("string"), 3, "0")
    second = F.lpad(int_div(F.pmod(ms, F.lit(ttl_ms)), 1000).cast("string"), 10, "0")
    return F.concat(bucket, second, F.lpad(F.substring(user, 1, 9), 9, "0"))


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input with fewer splits than cores over all cores, for work that is heavy per row.

    An input of any size has enough splits and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def resolve_source(kind: str) -> str:
    """'hbase' (keyed table) or 'hdfs' (day/hour folders), letter case ignored"""
    kind = kind.lower()
    if kind not in ("hbase", "hdfs"):
        raise ValueError(f"unknown source {kind!r}; use 'hbase' or 'hdfs'")
    return kind


def read_history(spark: SparkSession, kind: str, path: str, start_ms: int, end_ms: int, time: str = "ts") -> DataFrame:
    """The source switch: a time-range scan of the keyed table or the day/hour folders of the same range"""
    if resolve_source(kind) == "hbase":
        return scan_time_range(spark.read.parquet(path), time, start_ms, end_ms)
    return scan_day_hour(spark.read.parquet(path), start_ms, end_ms)


def scan_day_hour(df: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Rows of the ``day=yyyy-MM-dd/hour=HH`` folders from the start's hour up to the end's (excluded).

    The filter names partition columns only, so other folders are never listed as splits.
    """

    def parts(ms: int) -> tuple[str, str]:
        at = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=ms)
        return f"{at:%Y-%m-%d}", f"{at:%H}"

    (d0, h0), (d1, h1) = parts(start_ms), parts(end_ms)
    day, hour = F.col("day").cast("string"), F.lpad(F.col("hour").cast("string"), 2, "0")
    after = (day > d0) | ((day == d0) & (hour >= h0))
    before = (day < d1) | ((day == d1) & (hour < h1))
    return df.filter(after & before)


def latest_partition(df: DataFrame) -> DataFrame:
    """The greatest (day, hour) pair as text; an aggregate over partition columns only.

    Reading folders may have turned '09' into 9, so the hour gets its two digits back before comparing.
    """
    day, hour = F.col("day").cast("string"), F.lpad(F.col("hour").cast("string"), 2, "0")
    top = F.max(F.struct(day.alias("day"), hour.alias("hour")))
    return df.agg(top.alias("p")).select("p.day", "p.hour")


def catalog_project(spark: SparkSession, database: str, table: str, columns: list[str]) -> DataFrame:
    """Switch the database, then project a table's columns"""
    spark.catalog.setCurrentDatabase(database)
    return spark.table(table).select(*columns)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines not starting with '#'; a path that cannot be read gives no lines"""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], "value string")
    return lines.filter(~F.col("value").startswith("#"))


def manifest(lines: DataFrame) -> DataFrame:
    """'name<blank>type' lines -> (name, type); lines with one part are skipped"""
    parts = F.split(F.col("value"), r"\s+", 2)
    return lines.select(parts.alias("p")).filter(F.size("p") == 2).select(
        F.col("p")[0].alias("name"), F.trim(F.col("p")[1]).alias("type")
    )


# fixed values: manifest type name -> element type of the array column
ELEMENT_TYPES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def manifest_columns(entries: DataFrame) -> DataFrame:
    """(name, type) rows -> the columns that a table over them has, as distinct (name, type) rows in Spark's type names.

    For manifests of any length; a type without an element type is an error of the row's task.
    """
    known = F.create_map(*[F.lit(x) for name, kind in ELEMENT_TYPES.items() for x in (name, kind.simpleString())])
    element = known[F.col("type")]
    problem = F.concat(F.lit("manifest type unknown: "), F.col("type"))
    checked = F.when(element.isNotNull(), element).otherwise(F.raise_error(problem).cast("string"))
    return entries.select("name", F.concat(F.lit("array<"), checked, F.lit(">")).alias("type")).distinct()


def manifest_schema(entries: DataFrame, max_fields: int = 20_000) -> T.StructType:
    """(name, type) rows -> a schema of array columns, in name order.

    A schema lives on the driver by nature; a manifest beyond ``max_fields`` is refused, not cut.
    """
    rows = entries.orderBy("name").limit(max_fields + 1).collect()
    if len(rows) > max_fields:
        raise ValueError(f"manifest has more than {max_fields} fields")
    return T.StructType([T.StructField(r["name"], T.ArrayType(ELEMENT_TYPES[r["type"]])) for r in rows])


def csv_table(spark: SparkSession, name: str, ddl: str, path: str, delimiter: str = ",") -> None:
    """Declare a table over csv files"""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING csv OPTIONS (path '{path}', sep '{delimiter}')")


# ---------------------------------------------------------------- streams


def stream_files(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet",
                 files_per_trigger: int = 1000) -> DataFrame:
    """A file stream; ``files_per_trigger`` bounds what one micro-batch takes in"""
    return (
        spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", str(files_per_trigger)).load(path)
    )


def stream_text(spark: SparkSession, source: str = "files", path: str | None = None, host: str | None = None,
                port: int | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of text lines (``value``) from files or, by option, from a socket that someone else serves"""
    if source == "files":
        return spark.readStream.option("maxFilesPerTrigger", str(files_per_trigger)).text(path)
    if source == "socket":
        return spark.readStream.format("socket").option("host", host).option("port", port).load()
    raise ValueError(f"unknown text stream {source!r}")


def stream_kafka(spark: SparkSession, servers: str, topic: str, group: str,
                 max_per_trigger: int = 10_000_000) -> DataFrame:
    """String values of a topic from the earliest offset; offsets live in the query's checkpoint, not at the
    broker. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.group.id", group)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_per_trigger))
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )
