"""Scalar feature functions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .binding import let
from .hashing import bucket_mod_of_abs, java_hash

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


# ---------------------------------------------------------------- time


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts)


def epoch_ms(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH), ts)


def int_div(a: Column, b: int) -> Column:
    """Integer division, without a detour over doubles"""
    return F.call_function("div", a, F.lit(b))


def ms_to_ntz(ms: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> wall-clock time in ``zone``, independent of the session zone."""
    utc = F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def format_ms(ms: Column, pattern: str = "yyyy-MM-dd HH:mm:ss", zone: str = "UTC") -> Column:
    return F.date_format(ms_to_ntz(ms, zone), pattern)


def hour_of(ms: Column, zone: str = "UTC") -> Column:
    return F.hour(ms_to_ntz(ms, zone))


def weekday_of(ms: Column, zone: str = "UTC") -> Column:
    """1 = Monday ... 7 = Sunday"""
    return F.weekday(ms_to_ntz(ms, zone)) + F.lit(1)


def parse_minute(text: Column) -> Column:
    """'yyyy-MM-dd HH mm' -> epoch ms, read as UTC; null when the text does not parse."""
    return epoch_ms(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH mm")).cast("timestamp_ntz"))


def day_part(text: Column) -> Column:
    return F.split(text, " ")[0]


def hour_part(text: Column) -> Column:
    return F.split(text, " ")[1]


def date_offset(as_of: Column, days: int) -> Column:
    """``days`` before ``as_of`` as yyyy-MM-dd"""
    return F.date_format(F.date_sub(as_of, days), "yyyy-MM-dd")


def token_ms(token: Column) -> Column:
    """The first 13 characters of a request token are its epoch ms."""
    return F.substring(token, 1, 13).try_cast("bigint")


# ---------------------------------------------------------------- numbers


def safe_int(text: Column) -> Column:
    """null or '' -> 0"""
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("int"), F.lit(0))


def lenient_int(text: Column) -> Column:
    return F.coalesce(text.try_cast("double").try_cast("int"), F.lit(0))


def lenient_long(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def lenient_double(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def guarded_double(text: Column, default: float = 0.0) -> Column:
    """Missing, an empty-codec marker, NaN or infinite -> default"""
    x = text.try_cast("double")
    bad = x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return F.when(bad, F.lit(default)).otherwise(x)


def seconds2(ms: Column) -> Column:
    """milliseconds -> seconds with two decimals"""
    return F.round(ms / F.lit(1000.0), 2)


def duration_seconds(text: Column) -> Column:
    """A duration in ms given as a plain number or as JSON ``{duration}`` -> seconds, two decimals"""
    number = F.when(text.contains("{"), F.get_json_object(text, "$.duration")).otherwise(text)
    return seconds2(number.try_cast("double"))


def ctr(show: Column, click: Column) -> Column:
    return F.when(show > 0, click.cast("double") / show).otherwise(F.lit(0.0))


def device_age_months(event_ms: Column, sale_ms: Column, cap: int = 60) -> Column:
    """Whole 30-day units since the sale, at most ``cap``"""
    gap = event_ms - sale_ms
    units = F.when(gap >= 0, F.floor(gap / F.lit(30 * DAY_MS))).otherwise(F.ceil(gap / F.lit(30 * DAY_MS)))
    return F.least(units, F.lit(cap)).cast("double")


def item_age_hours(event_ms: Column, publish_ms: Column, limit: int = 15 * 24) -> Column:
    """Whole hours since publication; outside (0, limit) -> 0"""
    hours = F.floor((event_ms - publish_ms) / F.lit(HOUR_MS))
    return F.when((hours > 0) & (hours < limit), hours).otherwise(F.lit(0)).cast("double")


def clean_read_seconds(read_ms: Column) -> Column:
    return F.when(read_ms > 0, read_ms / F.lit(1000.0)).otherwise(F.lit(0.0))


def clean_video(video: Column) -> Column:
    return F.when(video > 0, video.cast("double")).otherwise(F.lit(0.0))


def completion_rate(read_ms: Column, video: Column) -> Column:
    """Read share of a video, at most 1; 0 without a video"""
    share = clean_read_seconds(read_ms) / F.nullif(video.cast("double"), F.lit(0.0))
    return F.when(video > 0, F.least(F.lit(1.0), share)).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- text


def string_to_array(text: Column, delimiter: str) -> Column:
    """Split by a regex and drop empty pieces; null -> empty array"""
    return F.coalesce(F.filter(F.split(text, delimiter), lambda x: x != ""), F.array().cast("array<string>"))


def register_sql_functions(spark: SparkSession) -> None:
    """``string_to_array(text, regex)`` for SQL users, as a SQL function, not Python."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION string_to_array(s STRING, d STRING) RETURNS ARRAY<STRING> "
        "RETURN coalesce(filter(split(s, d), x -> x <> ''), cast(array() AS ARRAY<STRING>))"
    )


def dedupe_csv(ids: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.split(ids, ","))), ",")


def first_pieces(text: Column) -> Column:
    """'k:v,k:v' -> array of [k, v] pairs as split text; null or blank -> empty array"""
    pairs = F.filter(F.split(text, ","), lambda p: F.contains(p, F.lit(":")))
    blank = text.isNull() | (F.trim(text) == "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(pairs)


def coding_map(text: Column, rule: str = "int", buckets: int = 1_000_000) -> Column:
    """'k:v,k:v' -> map<int,double>; keys are ints or, with ``rule='hash'``, hash buckets.

    A repeated key keeps its last value. Keys that need a dictionary go through ``lookups.dict_encode``.
    """
    entries = F.transform(
        first_pieces(text),
        lambda p: F.struct(
            (
                bucket_mod_of_abs(java_hash(F.split(p, ":")[0]), buckets)
                if rule == "hash"
                else F.split(p, ":")[0].try_cast("int")
            ).alias("key"),
            F.split(p, ":")[1].try_cast("double").alias("value"),
        ),
    )
    entries = F.filter(entries, lambda e: e["key"].isNotNull())
    return last_wins(entries)


def last_wins(entries: Column) -> Column:
    """Entries to a map; of equal keys the last entry stays.

    Sorted by (key, position), an entry is the last of its key when its right neighbour has another key.
    """
    placed = F.array_sort(
        F.transform(
            entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value"))
        )
    )

    def keep(s: Column) -> Column:
        paired = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        last = F.filter(paired, lambda p: p["b"].isNull() | (p["b"]["key"] != p["a"]["key"]))
        return F.transform(last, lambda p: F.struct(p["a"]["key"].alias("key"), p["a"]["value"].alias("value")))

    return F.map_from_entries(let(placed, keep))


# ---------------------------------------------------------------- JSON objects


def json_text_map(text: Column) -> Column:
    """JSON object -> map<string,string>; null when it is not an object"""
    return F.from_json(text, "map<string,string>")


def json_string_map(text: Column) -> Column:
    """JSON object -> map<string,double>; missing or broken -> {'': 0.0}"""
    m = json_text_map(text)
    typed = F.transform_values(m, lambda _, v: v.try_cast("double"))
    broken = m.isNull() | F.exists(F.map_values(typed), lambda v: v.isNull())
    return F.when(broken, F.create_map(F.lit(""), F.lit(0.0))).otherwise(typed)


def json_int_map(text: Column) -> Column:
    """JSON object with integer keys -> map<int,double>; missing -> {0: 0.0}"""
    m = json_text_map(text)
    entries = F.filter(
        F.transform(
            F.map_entries(m),
            lambda e: F.struct(e["key"].try_cast("int").alias("key"), e["value"].try_cast("double").alias("value")),
        ),
        lambda e: e["key"].isNotNull(),
    )
    return F.when(m.isNull(), F.create_map(F.lit(0), F.lit(0.0))).otherwise(F.map_from_entries(entries))


def overlay(base: Column, other: Column, keys: Column, need_text: bool = False) -> Column:
    """Values of ``other`` under the allowed ``keys`` replace those of ``base`` when they are not null
    (with ``need_text`` also not empty)."""

    def take(k: Column, v: Column) -> Column:
        ok = F.array_contains(keys, k) & v.isNotNull()
        return ok & (F.length(v) > 0) if need_text else ok

    empty = F.create_map().cast("map<string,string>")
    new = F.coalesce(F.map_filter(other, take), empty)
    return let(new, lambda n: F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(n, k)), n))
