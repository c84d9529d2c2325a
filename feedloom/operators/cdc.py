"""Change-data-capture envelopes: filter and flatten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import format_ms

ENVELOPE = (
    "type string, `database` string, `table` string, ts bigint, es bigint, id int, isDdl boolean, "
    "mysqlType string, old array<string>, pkNames array<string>, sql string, sqlType string, data array<string>"
)

# fixed values: the seven columns of a flattened row
ROW_COLUMNS = ("event_time", "date_time", "db_name", "table_name", "primary_key", "params", "action_type")


def parse_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    return df.select("*", F.from_json(value, ENVELOPE).alias("m"))


def cdc_filter(df: DataFrame, action: str, database: str, table: str, value: str = "value") -> DataFrame:
    """Messages of one action on one table; the message stays as it is, parsed as ``m``"""
    return parse_envelope(df, value).filter(
        (F.col("m.type") == action) & (F.col("m.database") == database) & (F.col("m.table") == table)
    )


def cdc_flatten(messages: DataFrame, primary_key: str, zone: str = "UTC", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row of seven strings per element of ``data``"""
    rows = messages.select(*keep, "m", F.explode("m.data").alias("row"))
    return rows.select(
        *keep,
        F.col("m.ts").cast("string").alias("event_time"),
        format_ms(F.col("m.ts"), zone=zone).alias("date_time"),
        F.col("m.database").alias("db_name"),
        F.col("m.table").alias("table_name"),
        F.get_json_object("row", f"$.{primary_key}").alias("primary_key"),
        F.col("row").alias("params"),
        F.col("m.type").alias("action_type"),
    )


def cdc_lines(rows: DataFrame, name: str = "line") -> DataFrame:
    """The seven columns as one tab-joined line"""
    return rows.withColumn(name, F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in ROW_COLUMNS]))
