"""Training samples from wide request rows: decode, label, gate, fan out, pack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import int_div, overlay, token_ms

# fixed values: the feedback kinds, in label order
FEEDBACK = ("negative", "like", "comment", "collect", "share")


def cell(cells: Column, name: str) -> Column:
    return F.try_element_at(cells, F.lit(name))


def item_cell(cells: Column, prefix: str, item: Column) -> Column:
    return F.try_element_at(cells, F.concat(F.lit(prefix), item))


def qualifier_ids(cells: Column, prefix: str, separator: str = "_") -> Column:
    """What follows the first separator in the qualifiers that start with ``prefix``"""
    names = F.filter(F.map_keys(cells), lambda q: q.startswith(prefix))
    return F.transform(names, lambda q: F.substring(q, F.instr(q, separator) + F.lit(1), F.length(q)))


def decode_request(df: DataFrame, cells: str = "cells") -> DataFrame:
    """Request-level cells with their types; missing numbers of the continuous counters are 0.0"""
    c = F.col(cells)
    token, event_time = cell(c, "token"), cell(c, "req_timestamp").try_cast("bigint")
    return df.withColumns(
        {
            "token": token,
            "user_imei": cell(c, "imei"),
            "event_id": cell(c, "event_id"),
            "event_time": event_time,
            "time_gap": event_time - token_ms(token),
            "continuous_clicked": F.coalesce(cell(c, "continuous_clicked").try_cast("double"), F.lit(0.0)),
            "continuous_request": F.coalesce(cell(c, "continuous_request").try_cast("double"), F.lit(0.0)),
        }
    )


def overlay_user(base: Column, reflux: Column, *key_lists: Sequence[str]) -> Column:
    """Fresh user features over the stored ones for the keys of the allow-lists, nulls left out"""
    keys = F.concat(*[F.array(*[F.lit(k) for k in keys]) for keys in key_lists])
    return overlay(base, reflux, keys)


def overlay_item(base: Column, reflux: Column, keys: Sequence[str]) -> Column:
    """The same for items, where an empty text is left out too"""
    return overlay(base, reflux, F.array(*[F.lit(k) for k in keys]), need_text=True)


def feedback_flag(cells: Column, kind: str, item: Column) -> Column:
    return F.map_contains_key(cells, F.concat(F.lit(f"feedback_{kind}:"), item)).cast("int")


def items_of(cells: Column, allow: Sequence[str]) -> Column:
    """Every item of a request as a struct of its features and labels; items that do not parse are dropped"""

    def one(item: Column) -> Column:
        stored = F.from_json(item_cell(cells, "itemFeature_", item), "map<string,string>")
        fresh = F.from_json(item_cell(cells, "reflux_itemFeature_", item), "map<string,string>")
        result = item_cell(cells, "recommend_result_", item)
        pctr = F.get_json_object(result, "$.pctr").try_cast("double")
        clicked = item_cell(cells, "clk_", item)
        # a result without a usable pctr, or a click that is no number, breaks the item
        broken = (result.isNotNull() & pctr.isNull()) | (clicked.isNotNull() & clicked.try_cast("double").isNull())
        return F.when(
            stored.isNotNull() & ~broken,
            F.struct(
                item.alias("news_id"),
                overlay_item(stored, fresh, allow).alias("features"),
                F.coalesce(clicked.try_cast("double"), F.lit(0.0)).alias("clicked"),
                item_cell(cells, "duration_", item).try_cast("int").alias("duration"),
                F.coalesce(pctr, F.lit(0.0)).alias("pctr"),
                F.when(result.isNull(), "").otherwise(F.get_json_object(result, "$.recall_type")).alias(
                    "recall_type"
                ),
                *[feedback_flag(cells, k, item).alias(f"feedback_{k}_flag") for k in FEEDBACK],
            ),
        )

    return F.filter(F.transform(qualifier_ids(cells, "itemFeature"), one), lambda s: s.isNotNull())


def biz_type(cells: Column) -> Column:
    """The business type of the request's recommend results, '' when there is none.

    Results of one request share it; of several the one of the smallest qualifier is taken.
    """
    names = F.array_sort(F.filter(F.map_keys(cells), lambda q: q.startswith("recommend_result_")))
    return F.coalesce(F.get_json_object(F.try_element_at(cells, F.get(names, F.lit(0))), "$.bizType"), F.lit(""))


def biztype_gate(df: DataFrame, parts: Sequence[str], cells: str = "cells", wanted: str = "RECOMMEND") -> DataFrame:
    """Requests of one business type with all ``parts`` present"""
    ok = biz_type(F.col(cells)) == wanted
    for p in parts:
        ok = ok & F.col(p).isNotNull()
    return df.filter(ok)


def explode_items(df: DataFrame, items: str = "items") -> DataFrame:
    """One row per (user, item); an item without features is none"""
    out = df.select("*", F.explode(items).alias("item")).drop(items)
    return out.filter(F.size("item.features") > 0)


def latency_gate(df: DataFrame, token: str, event_time: str, limit_ms: int = 3_600_000) -> DataFrame:
    """0 < event time - token time < limit, both strict"""
    gap = F.col(event_time) - token_ms(F.col(token))
    return df.filter((gap > 0) & (gap < limit_ms))


def freshness_gate(df: DataFrame, collect_start: str, start_ms: int, news_id: str, recall_type: str) -> DataFrame:
    """Collected after ``start_ms``; pinned items (V06) and hot-topic recalls (25) left out.

    A row without item id or recall type is dropped.
    """
    return df.filter(
        (F.col(collect_start) > start_ms)
        & ~F.col(news_id).startswith("V06")
        & ~F.col(recall_type).startswith("25")
    )


def head_sample(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    return df.orderBy(*order).limit(n)


def fraction_sample(df: DataFrame, fraction: float, key: str) -> DataFrame:
    """A repeatable sample: the rows whose key hashes below the fraction"""
    return df.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(fraction * 1_000_000))


def output_partitions(rows: int, per_partition: int = 100_000) -> int:
    return max(1, -(-rows // per_partition))


def prebatch_pack(
    df: DataFrame, seq: str, n: int, features: Sequence[str], partition_rows: int = 10_000
) -> DataFrame:
    """Consecutive groups of exactly ``n`` rows per partition, every feature gathered into an array.

    A partition is a run of ``partition_rows`` values of the unique ``seq``, so its rows are bounded and the
    groups come out the same on every run; its incomplete tail is dropped, as that of every partition is.
    Array features are concatenated.
    """
    w = Window.partitionBy("part").orderBy(seq)
    placed = df.withColumn("part", int_div(F.col(seq), partition_rows)).withColumn(
        "grp", int_div(F.row_number().over(w) - F.lit(1), n)
    )
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    # both aggregates are on the window's partitioning, so nothing is shuffled again
    packed = placed.groupBy("part", "grp").agg(
        F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list(F.struct(F.col(seq).alias("_seq"), *features))).alias("_rows")
    )

    def gathered(name: str) -> Column:
        column = F.transform("_rows", lambda r: r[name])
        return (F.flatten(column) if name in arrays else column).alias(name)

    return packed.filter(F.col("_n") == n).select("part", "grp", *[gathered(f) for f in features])
