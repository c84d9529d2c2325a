"""Dictionary, calendar and membership lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import first_pieces
from ..functions.sequences import pad
from ..session import materialize
from .skew import block_offsets, lookup_join


def build_dictionary(texts: DataFrame) -> DataFrame:
    """Distinct (feature, text) -> (feature, text, code), codes from 1 in text order per feature.

    The texts are laid out in ranges of (feature, text) and written once, so that a text keeps its range. A code is the
    rank within the range plus the feature's texts in earlier ranges, so a large vocabulary, whatever its first letters,
    is numbered by as many tasks as it has ranges.
    """
    known = texts.select("feature", "text").filter(F.col("text").isNotNull())
    distinct = text_ranges(known.distinct())
    offsets = block_offsets(distinct, ["feature"], "_block", {"_before": F.count(F.lit(1))}, F.sum)
    rank = F.row_number().over(Window.partitionBy("feature", "_block").orderBy("text"))
    code = (F.col("_rank") + F.coalesce("_before", F.lit(0))).cast("int").alias("code")
    return (
        distinct.withColumn("_rank", rank)
        .join(offsets, ["feature", "_block"])
        .select("feature", "text", code)
    )


def text_ranges(distinct: DataFrame) -> DataFrame:
    """The rows in ranges of (feature, text), written, with the range's number as ``_block``"""
    laid = distinct.repartitionByRange("feature", "text")
    return materialize(laid.withColumn("_block", F.spark_partition_id()), "texts")


def dict_encode(df: DataFrame, dictionary: DataFrame, feature: str, text: str, name: str) -> DataFrame:
    """The code of ``text`` in the dictionary of ``feature``, 0 when it is unknown or null"""
    codes = dictionary.filter(F.col("feature") == feature).select(F.col("text").alias(text), F.col("code").alias(name))
    return lookup_join(df, codes, text, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def multi_encode(
    df: DataFrame, dictionary: DataFrame, feature: str, text: str, row_id: str, name: str, limit: int = 500
) -> DataFrame:
    """Split ``text`` at '|', encode every piece (unknown -> 0) and keep codes below ``limit``, in order"""
    pieces = df.select(row_id, F.posexplode(F.split(F.coalesce(text, F.lit("")), r"\|")).alias("pos", "piece"))
    coded = dict_encode(pieces, dictionary, feature, "piece", "code")
    kept = F.when(F.col("code") < limit, F.struct("pos", "code"))
    return coded.groupBy(row_id).agg(
        F.transform(F.array_sort(F.collect_list(kept)), lambda e: e["code"]).alias(name)
    )


def coding_map_by_dictionary(
    df: DataFrame, dictionary: DataFrame, feature: str, row_id: str, text: str, name: str
) -> DataFrame:
    """(row_id, name): 'k:v,k:v' -> map<int,double> whose keys are the dictionary's codes (0 when unknown).

    Of several pieces with one code the last counts; a null or blank text gives an empty map. A row's map is as long as
    its text has pieces.
    """
    pieces = df.select(row_id, F.posexplode_outer(first_pieces(F.col(text))).alias("pos", "piece"))
    split = F.split("piece", ":")
    coded = dict_encode(
        pieces.select(row_id, "pos", split[0].alias("key"), split[1].try_cast("double").alias("value")),
        dictionary, feature, "key", "code",
    )
    last = coded.groupBy(row_id, "code").agg(
        F.max("pos").alias("pos"), F.max_by("value", "pos").alias("value")
    )
    entry = F.when(F.col("pos").isNotNull(), F.struct(F.col("code").cast("int").alias("key"), "value"))
    return last.groupBy(row_id).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name))


def encode_sequence(
    df: DataFrame, dictionary: DataFrame, row_id: str, keys: str, feature: str, take: int, name: str, fill: int = 0,
    duration: bool = False,
) -> DataFrame:
    """Code the keys of ``sequences.behavior_keys`` by a dictionary: array<struct<t,v>> per row.

    With ``duration`` they are those of ``sequences.duration_keys``, and each entry's duration is put last as ``d``. The
    keys are taken out to rows, so that the dictionary may be of any size, and put back in place. A row whose list
    is empty or null gets an empty array.
    """
    entries = df.select(row_id, F.posexplode_outer(keys).alias("pos", "e"))
    carried = ["t", "d"] if duration else ["t"]
    long = entries.select(
        row_id, "pos", *[F.col(f"e.{x}").alias(x) for x in carried], F.posexplode_outer("e.keys").alias("rank", "key")
    )
    coded = dict_encode(long, dictionary, feature, "key", "code")
    tokens = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("rank", "code")))),
        lambda e: e["code"].cast("string"),
    )
    per_entry = coded.groupBy(row_id, "pos", *carried).agg(
        F.array_join(pad(tokens, take, F.lit(str(fill))), "#").alias("v")
    )
    real = F.when(F.col("pos").isNotNull(), F.struct("pos", "t", "v", *carried[1:]))
    per_row = per_entry.groupBy(row_id).agg(F.array_sort(F.collect_list(real)).alias("_all"))
    fields = ["t", "v", *carried[1:]]
    return per_row.select(
        row_id, F.transform("_all", lambda e: F.struct(*[e[x].alias(x) for x in fields])).alias(name)
    )


def calendar_flags(calendar: DataFrame) -> DataFrame:
    """(d, is_holiday) -> per day the flags of the day, the day before and the day after.

    The small side is widened once, so that the facts need one lookup instead of three.
    """
    spread = calendar.select(
        "is_holiday",
        F.explode(F.array(*[F.struct(F.date_add("d", n).alias("d"), F.lit(n).alias("n")) for n in (-1, 0, 1)])).alias(
            "e"
        ),
    )

    def at(n: int) -> Column:
        return F.max(F.when(F.col("e.n") == n, F.col("is_holiday")))

    return spread.groupBy(F.col("e.d").alias("d")).agg(
        at(0).alias("is_holiday"), at(1).alias("yesterday_is_holiday"), at(-1).alias("tomorrow_is_holiday")
    )


FLAGS = ("is_holiday", "yesterday_is_holiday", "tomorrow_is_holiday")


def holiday_lookup(df: DataFrame, calendar: DataFrame, day: str) -> DataFrame:
    """Holiday flags of a date column, its day before and after; unknown days count as 0"""
    flags = calendar_flags(calendar).withColumnRenamed("d", day)
    out = lookup_join(df, flags, day, "left")
    return out.withColumns({f: F.coalesce(f, F.lit(0)) for f in FLAGS})


def membership_flag(df: DataFrame, members: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """1 when the row's key is among ``members``, else 0"""
    ids = members.select(*on).distinct().withColumn(name, F.lit(1))
    return lookup_join(df, ids, on, "left").withColumn(name, F.coalesce(name, F.lit(0)))
