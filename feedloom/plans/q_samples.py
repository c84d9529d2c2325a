"""Queries from wide request rows to packed training samples, and CDC flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import cdc, lookups, samples
from .registry import query
from .views import Views

c = F.col
FLAGS = [f"feedback_{k}_flag" for k in samples.FEEDBACK]
# fixed values of the stand-in requests: features the fresh values may replace
USER_KEYS = (["sex"], ["city"], ["rt"])
ITEM_KEYS = ["len", "role"]


def json_cell(name: str) -> Column:
    return F.from_json(samples.cell(c("cells"), name), "map<string,string>")


@query(
    "wide_row_decode",
    """SELECT rowkey, (req - 1000 * (conv_id % 10)) || '' || conv_id AS token, 'u' || conv_id AS user_imei,
       'e' || rowkey AS event_id, req AS event_time, 1000 * (conv_id % 10) AS time_gap,
       CASE WHEN conv_id % 2 = 0 THEN CAST(conv_id % 5 AS DOUBLE) ELSE 0.0::DOUBLE END AS continuous_clicked,
       0.0::DOUBLE AS continuous_request FROM v_request""",
)
def _(v: Views) -> DataFrame:
    return samples.decode_request(v.wide).drop("cells")


@query(
    "wide_row_ids",
    """SELECT rowkey, string_agg(news_id, ',' ORDER BY news_id) AS ids FROM v_turn GROUP BY rowkey""",
)
def _(v: Views) -> DataFrame:
    ids = F.array_sort(samples.qualifier_ids(c("cells"), "itemFeature"))
    return v.wide.select("rowkey", F.array_join(ids, ",").alias("ids"))


@query(
    "feedback_flags",
    """SELECT rowkey, news_id, CAST(x % 5 = 0 AS INTEGER) AS feedback_negative_flag,
       CAST(turn % 3 = 0 AS INTEGER) AS feedback_like_flag, CAST(x % 7 = 0 AS INTEGER) AS feedback_comment_flag,
       CAST(x % 4 = 0 AS INTEGER) AS feedback_collect_flag, CAST(x % 6 = 0 AS INTEGER) AS feedback_share_flag
       FROM v_turn""",
)
def _(v: Views) -> DataFrame:
    sets = v.wide.select(
        "rowkey",
        samples.qualifier_ids(c("cells"), "itemFeature").alias("ids"),
        *[samples.qualifier_ids(c("cells"), f"feedback_{k}", ":").alias(k) for k in samples.FEEDBACK],
    )
    items = sets.withColumn("news_id", F.explode("ids"))
    return items.select(
        "rowkey",
        "news_id",
        *[F.array_contains(k, c("news_id")).cast("int").alias(f"feedback_{k}_flag") for k in samples.FEEDBACK],
    )


@query(
    "json_overlay_user",
    """SELECT rowkey, 'sex' AS key, CASE WHEN conv_id % 3 <> 0 THEN '2' ELSE '1' END AS value FROM v_request
       UNION ALL SELECT rowkey, 'city', CAST(conv_id % 50 AS VARCHAR) FROM v_request
       UNION ALL SELECT rowkey, 'age', '30' FROM v_request
       UNION ALL SELECT rowkey, 'rt', 'x' FROM v_request WHERE conv_id % 3 <> 0""",
)
def _(v: Views) -> DataFrame:
    merged = samples.overlay_user(json_cell("userFeature"), json_cell("reluxFeature"), *USER_KEYS)
    return v.wide.select("rowkey", F.explode(merged))


@query(
    "json_overlay_item",
    """SELECT rowkey, news_id, 'len' AS key, len AS value FROM v_label
       UNION ALL SELECT rowkey, news_id, 'role', role FROM v_label
       UNION ALL SELECT rowkey, news_id, 'title', 't' || turn FROM v_label""",
)
def _(v: Views) -> DataFrame:
    return _items(v).select("rowkey", "item.news_id", F.explode("item.features"))


def _items(v: Views) -> DataFrame:
    rows = samples.decode_request(v.wide).withColumn("items", samples.items_of(c("cells"), ITEM_KEYS))
    return samples.explode_items(rows)


@query(
    "request_context",
    """SELECT r.rowkey, r.req AS event_time, 1000 * (conv_id % 10) AS time_gap,
       CAST(hour(make_timestamp(req * 1000)) AS INTEGER) AS hour_scope,
       CAST(isodow(make_timestamp(req * 1000)) AS INTEGER) AS week_of_day,
       coalesce(a.is_holiday, 0) AS is_holiday, coalesce(b.is_holiday, 0) AS yesterday_is_holiday,
       coalesce(n.is_holiday, 0) AS tomorrow_is_holiday FROM v_request r
       LEFT JOIN v_calendar a ON a.d = CAST(make_timestamp(req * 1000) AS DATE)
       LEFT JOIN v_calendar b ON b.d = CAST(make_timestamp(req * 1000) AS DATE) - 1
       LEFT JOIN v_calendar n ON n.d = CAST(make_timestamp(req * 1000) AS DATE) + 1""",
)
def _(v: Views) -> DataFrame:
    rows = samples.decode_request(v.wide).drop("cells")
    rows = rows.withColumns(
        {
            "hour_scope": scalars.hour_of(c("event_time")),
            "week_of_day": scalars.weekday_of(c("event_time")),
            "day": scalars.ms_to_ntz(c("event_time")).cast("date"),
        }
    )
    out = lookups.holiday_lookup(rows, v.calendar, "day")
    return out.select("rowkey", "event_time", "time_gap", "hour_scope", "week_of_day", *lookups.FLAGS)


LABELS = ["news_id", "clicked", "duration", "pctr", "recall_type", *FLAGS]


@query("label_assembly", f"SELECT rowkey, {', '.join(LABELS)}, len FROM v_label")
def _(v: Views) -> DataFrame:
    return _items(v).select("rowkey", *[f"item.{n}" for n in LABELS], c("item.features")["len"].alias("len"))


@query(
    "lookup_recommend_left",
    """SELECT rowkey, news_id, CASE WHEN x % 3 <> 0 THEN CAST('0.' || (x % 10) AS DOUBLE) ELSE 0.0::DOUBLE END AS pctr,
       CASE WHEN x % 3 <> 0 THEN (20 + x % 10) || '|3' ELSE '' END AS recall_type FROM v_turn""",
)
def _(v: Views) -> DataFrame:
    # an item's result is a cell of the same row
    with_result = F.transform(
        samples.qualifier_ids(c("cells"), "itemFeature"),
        lambda i: F.struct(i.alias("id"), samples.item_cell(c("cells"), "recommend_result_", i).alias("text")),
    )
    items = v.wide.select("rowkey", F.explode(with_result).alias("i"))
    return items.select(
        "rowkey",
        c("i.id").alias("news_id"),
        F.coalesce(F.get_json_object("i.text", "$.pctr").try_cast("double"), F.lit(0.0)).alias("pctr"),
        F.coalesce(F.get_json_object("i.text", "$.recall_type"), F.lit("")).alias("recall_type"),
    )


GATED = """v_request r WHERE r.conv_id % 4 <> 0
  AND EXISTS (SELECT 1 FROM v_turn t WHERE t.rowkey = r.rowkey AND t.x % 3 <> 0)"""


def _gated(v: Views) -> DataFrame:
    rows = samples.decode_request(v.wide).withColumns(
        {"user": json_cell("userFeature"), "items": samples.items_of(c("cells"), ITEM_KEYS)}
    )
    return samples.biztype_gate(rows, ["token", "user_imei", "event_time", "user", "items"])


@query("biztype_gate", f"SELECT rowkey FROM {GATED}")
def _(v: Views) -> DataFrame:
    return _gated(v).select("rowkey")


@query(
    "sample_explode",
    f"""SELECT l.rowkey, 'u' || l.conv_id AS user_imei, l.news_id, l.clicked, l.pctr, l.recall_type FROM v_label l
        WHERE l.rowkey IN (SELECT rowkey FROM {GATED})""",
)
def _(v: Views) -> DataFrame:
    return samples.explode_items(_gated(v)).select(
        "rowkey", "user_imei", "item.news_id", "item.clicked", "item.pctr", "item.recall_type"
    )


@query(
    "sample_gates",
    """SELECT sample_id, news_id, recall_type FROM v_sample
       WHERE sample_id % 7200 > 0 AND (sample_id % 7200) * 1000 < 3600000
       AND collect_start > epoch_ms(TIMESTAMP '2024-01-03') AND news_id NOT LIKE 'V06%' AND recall_type NOT LIKE '25%'""",
)
def _(v: Views) -> DataFrame:
    start_ms = 1_704_240_000_000
    rows = samples.latency_gate(v.sample, "token", "event_time")
    rows = samples.freshness_gate(rows, "collect_start", start_ms, "news_id", "recall_type")
    return rows.select("sample_id", "news_id", "recall_type")


@query(
    "head_sample",
    "SELECT sample_id, token, news_id FROM v_sample ORDER BY event_time, sample_id LIMIT 100",
)
def _(v: Views) -> DataFrame:
    return samples.head_sample(v.sample, ["event_time", "sample_id"]).select("sample_id", "token", "news_id")


@query(
    "prebatch_pack",
    """WITH p AS (SELECT *, sample_id // 1000 AS part, (row_number() OVER (PARTITION BY sample_id // 1000
         ORDER BY sample_id) - 1) // 7 AS grp FROM v_sample)
       SELECT part, grp, string_agg(news_id, ',' ORDER BY sample_id) AS news_ids,
       string_agg(array_to_string(tokens, ','), ',' ORDER BY sample_id) AS tokens FROM p
       GROUP BY part, grp HAVING count(*) = 7""",
)
def _(v: Views) -> DataFrame:
    out = samples.prebatch_pack(v.sample, "sample_id", 7, ["news_id", "tokens"], partition_rows=1000)
    return out.select(
        "part",
        c("grp").cast("bigint").alias("grp"),
        F.array_join("news_id", ",").alias("news_ids"),
        F.array_join(c("tokens").cast("array<string>"), ",").alias("tokens"),
    )


# ---------------------------------------------------------------- CDC

INSERTS = ("INSERT", "shop", "orders")


@query("cdc_filter", "SELECT seq, ts FROM v_cdc WHERE type = 'INSERT'")
def _(v: Views) -> DataFrame:
    return cdc.cdc_filter(v.cdc, *INSERTS).select("seq", "m.ts")


@query("cdc_flatten", f"SELECT seq, {', '.join(cdc.ROW_COLUMNS)} FROM v_cdc_rows")
def _(v: Views) -> DataFrame:
    return cdc.cdc_flatten(cdc.parse_envelope(v.cdc), "id", keep=("seq",))


@query(
    "cdc_tab_lines",
    f"SELECT seq, concat_ws(chr(9), {', '.join(cdc.ROW_COLUMNS)}) AS line FROM v_cdc_rows WHERE action_type = 'INSERT'",
)
def _(v: Views) -> DataFrame:
    rows = cdc.cdc_flatten(cdc.cdc_filter(v.cdc, *INSERTS), "id", keep=("seq",))
    return cdc.cdc_lines(rows).select("seq", "line")
