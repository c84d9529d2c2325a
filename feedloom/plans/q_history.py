"""Queries over behaviour histories: recall, windows, count vectors, frequency control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars, sequences
from ..functions.hashing import bucket_abs_of_mod, java_hash
from ..operators import history, lookups, recall, stats, windows
from .registry import query
from .view_sql import java_hash_sql
from .views import Views

HORIZONS = history.HORIZONS


def latest_order() -> list:
    return [F.desc("t_ms"), F.desc("seq")]


# ---------------------------------------------------------------- recall


def recall_lists(v: Views) -> DataFrame:
    clicks = v.click.select("user_id", F.col("item_id").cast("bigint").alias("news_id"), "t_ms", "seq")
    return recall.recall_by_neighbors(clicks, v.neighbors, "user_id", latest_order())


RECALL_SQL = """SELECT a.user_id, b.articletype, string_agg(DISTINCT b.recalled, ',' ORDER BY b.recalled) AS ids
  FROM (SELECT user_id, item_id AS news_id, row_number() OVER (PARTITION BY user_id ORDER BY t_ms DESC, seq DESC)
        AS flag FROM v_click) a
  JOIN v_neighbors b ON a.news_id = b.news_id WHERE a.flag <= 20 GROUP BY a.user_id, b.articletype"""


@query("recall_by_neighbors", RECALL_SQL)
def _(v: Views) -> DataFrame:
    return recall_lists(v)


@query(
    "topn_recent_clicks",
    """SELECT user_id, news_id, flag FROM (SELECT user_id, item_id AS news_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY t_ms DESC, seq DESC) AS INTEGER) AS flag
       FROM v_click WHERE t_ms >= epoch_ms(TIMESTAMP '2024-01-08')) WHERE flag <= 20""",
)
def _(v: Views) -> DataFrame:
    start_ms = 1_704_672_000_000  # 2024-01-08
    return recall.latest_n(v.click_since(start_ms), "user_id", latest_order(), 20).select(
        "user_id", F.col("item_id").alias("news_id"), "flag"
    )


@query(
    "dedupe_csv_ids",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(text, ','))), ',') AS ids
       FROM documents""",
)
def _(v: Views) -> DataFrame:
    return v.spread_table("documents").select("doc_id", scalars.dedupe_csv(F.col("text")).alias("ids"))


# ---------------------------------------------------------------- windows


@query(
    "tumbling_count",
    """SELECT t_ms // 5000 * 5000 AS window_start_ms, user_id, count(*) AS n FROM v_event GROUP BY 1, 2""",
)
def _(v: Views) -> DataFrame:
    return windows.tumbling_count(v.event, F.timestamp_millis("t_ms"), ["user_id"])


@query("window_count", "SELECT user_id, event_type, count(*) AS n FROM v_event GROUP BY ALL")
def _(v: Views) -> DataFrame:
    return windows.keyed_count(v.event, ["user_id", "event_type"])


@query(
    "running_collect",
    """SELECT seq, user_id || '|' || t_ms AS rowkey, array_to_string(list(k) OVER (PARTITION BY seq // 64
         ORDER BY seq ROWS UNBOUNDED PRECEDING), ',') AS seen FROM v_event""",
)
def _(v: Views) -> DataFrame:
    rows = v.event.select("seq", "k", F.concat_ws("|", "user_id", "t_ms").alias("rowkey"))
    out = windows.running_collect(rows, scalars.int_div(F.col("seq"), 64), ["seq"], "k", "seen")
    return out.select("seq", "rowkey", F.array_join(F.col("seen").cast("array<string>"), ",").alias("seen"))


MONOTONIC_SQL = """SELECT seq, user_id, t FROM (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM v_wordtime) WHERE t > greatest(coalesce(top, 0), 0)"""


def parsed_wordtime(rows: DataFrame) -> DataFrame:
    parts = F.split("value", ",")
    return rows.select("seq", parts[0].cast("bigint").alias("user_id"), parts[1].cast("bigint").alias("t"))


@query("parse_word_time", "SELECT seq, user_id, t FROM v_wordtime")
def _(v: Views) -> DataFrame:
    return parsed_wordtime(v.wordtime)


@query("monotonic_filter_batch", MONOTONIC_SQL)
def _(v: Views) -> DataFrame:
    return windows.monotonic_filter(parsed_wordtime(v.wordtime), "user_id", "t", "seq")


# ---------------------------------------------------------------- vectors per user


@query(
    "history_vector",
    """WITH c AS (SELECT user_id, sub AS i, count(*) AS v FROM v_show GROUP BY 1, 2),
       p AS (SELECT user_id, list(i ORDER BY i) FILTER (i <> 0 AND i < 15) AS ix,
         list(v ORDER BY i) FILTER (i <> 0 AND i < 15) AS vs FROM c GROUP BY 1)
       SELECT user_id, coalesce(array_to_string(ix, ','), '0') AS indices,
         coalesce(array_to_string(vs, ','), '0') AS vals FROM p""",
)
def _(v: Views) -> DataFrame:
    out = history.history_vector(v.show, "user_id", "sub", 15, drop_value=0)
    return out.select("user_id", _ints("indices"), _ints("values", "vals"))


def _ints(column: str, name: str | None = None):
    return F.array_join(F.col(column).cast("array<bigint>").cast("array<string>"), ",").alias(name or column)


@query(
    "duration_history_vector",
    """WITH t AS (SELECT user_id, duration_ms, unnest([cat, 5 + sub]) AS i FROM v_read),
       c AS (SELECT user_id, i, CAST(sum(duration_ms) AS BIGINT) AS v FROM t WHERE i <> 2 GROUP BY 1, 2),
       p AS (SELECT user_id, list(i ORDER BY i) AS ix, list(v ORDER BY i) AS vs FROM c WHERE i < 20 AND v > 0
         GROUP BY 1)
       SELECT u.user_id, coalesce(array_to_string(ix, ','), '0') AS indices,
         coalesce(array_to_string(vs, ','), '0') AS vals
       FROM (SELECT DISTINCT user_id FROM v_read) u LEFT JOIN p USING (user_id)""",
)
def _(v: Views) -> DataFrame:
    rows = v.read.withColumn("tokens", F.concat_ws("#", "cat", (F.col("sub") + 5).cast("string")))
    out = history.duration_history_vector(rows, "user_id", "tokens", "duration_ms", 20, drop_value=2)
    return out.select("user_id", _ints("indices"), _ints("values", "vals"))


@query(
    "tag_hash_sum",
    f"""WITH b AS (SELECT doc_id, abs({java_hash_sql('tag')} % 1000000) AS i, CAST(sum(w) AS BIGINT) AS v
         FROM v_tags GROUP BY ALL)
       SELECT doc_id, string_agg(i, ',' ORDER BY i) AS indices, string_agg(v, ',' ORDER BY i) AS vals
       FROM b GROUP BY doc_id""",
)
def _(v: Views) -> DataFrame:
    out = history.tag_hash_sum_rows(v.tokens, "doc_id", bucket_abs_of_mod(java_hash(F.col("tag")), 1_000_000), "w")
    return out.select("doc_id", _ints("indices"), _ints("values", "vals"))


# ---------------------------------------------------------------- horizons


def _horizon_sql(history_sql: str, keys: list[str], measures: dict[str, str]) -> str:
    """Brute force: every sample meets the history rows of its key."""
    on = " AND ".join(f"h.{k} = s.{k}" for k in keys)
    widest = max(HORIZONS.values())
    cols = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN h.t_ms > s.event_time - {ms} THEN {expr} END), 0) AS BIGINT) AS \"{h}_{m}\""
        for m, expr in measures.items()
        for h, ms in HORIZONS.items()
    )
    return f"""SELECT s.sample_id, {cols} FROM v_sample s LEFT JOIN ({history_sql}) h
      ON {on} AND h.t_ms < s.event_time AND h.t_ms > s.event_time - {widest} GROUP BY s.sample_id"""


SHOW_CLICK = (
    "SELECT user_id, cat, t_ms, 1 AS s, 0 AS c FROM v_show UNION ALL SELECT user_id, cat, t_ms, 0, 1 FROM v_click"
)


@query("freq_control_show_click", _horizon_sql(SHOW_CLICK, ["user_id", "cat"], {"s": "h.s", "c": "h.c"}))
def _(v: Views) -> DataFrame:
    asked = v.sample.select("sample_id", "user_id", "cat", "event_time")
    out = history.frequency_control(asked, v.show, v.click, ["user_id", "cat"], "event_time", "t_ms")
    return out.drop("user_id", "cat", "event_time")


@query(
    "freq_control_duration",
    _horizon_sql("SELECT user_id, cat, t_ms, duration_ms FROM v_read", ["user_id", "cat"], {"d": "h.duration_ms"}),
)
def _(v: Views) -> DataFrame:
    reads = v.read.select("user_id", "cat", "t_ms", F.col("duration_ms").alias("d"))
    asked = v.sample.select("sample_id", "user_id", "cat", "event_time")
    out = history.horizon_sums(asked, reads, ["user_id", "cat"], "event_time", "t_ms", ["d"])
    return out.drop("user_id", "cat", "event_time")


@query(
    "read_time_horizons",
    f"""SELECT sample_id, {", ".join(f'round("{h}_d" / 1000.0::DOUBLE, 2) AS read_{h}' for h in HORIZONS)}
        FROM ({_horizon_sql("SELECT user_id, t_ms, duration_ms FROM v_read", ["user_id"], {"d": "h.duration_ms"})})""",
)
def _(v: Views) -> DataFrame:
    asked = v.sample.select("sample_id", "user_id", "event_time")
    out = history.read_time_horizons(asked, v.read, "user_id", "event_time", "t_ms", "duration_ms")
    return out.drop("user_id", "event_time")


def _token_sql(history_sql: str, measures: dict[str, str], size: int) -> str:
    sums = ", ".join(
        f"sum(CASE WHEN h.t_ms > s.event_time - {ms} THEN {expr} END) AS \"{h}_{m}\""
        for m, expr in measures.items()
        for h, ms in HORIZONS.items()
    )
    names = [f"{h}_{m}" for m in measures for h in HORIZONS]
    lists = ", ".join(
        f"coalesce(string_agg(token, ',' ORDER BY token) FILTER (token < {size} AND \"{n}\" > 0), '0') AS \"{n}_indices\", "
        f"coalesce(string_agg(CAST(\"{n}\" AS BIGINT), ',' ORDER BY token) FILTER (token < {size} AND \"{n}\" > 0), '0') "
        f"AS \"{n}_values\""
        for n in names
    )
    return f"""WITH st AS (SELECT sample_id, user_id, event_time, unnest(tokens) AS token FROM v_sample),
      ht AS ({history_sql}),
      c AS (SELECT s.sample_id, s.token, {sums} FROM st s LEFT JOIN ht h ON h.user_id = s.user_id
        AND h.token = s.token AND h.t_ms < s.event_time AND h.t_ms > s.event_time - {max(HORIZONS.values())}
        GROUP BY s.sample_id, s.token)
      SELECT sample_id, {lists} FROM c GROUP BY sample_id"""


TOKEN_SIZE = 110


def _token_query(v: Views, rows: DataFrame, measures: list[str]) -> DataFrame:
    out = history.frequency_control_tokens(
        v.sample, rows, "user_id", "sample_id", "tokens", "event_time", "t_ms", measures, TOKEN_SIZE
    )
    return out.select("sample_id", *[_ints(c) for c in out.columns[1:]])


@query(
    "freq_control_multi",
    _token_sql(
        "SELECT user_id, t_ms, unnest(tokens) AS token, 1 AS s, 0 AS c FROM v_show UNION ALL "
        "SELECT user_id, t_ms, unnest(tokens), 0, 1 FROM v_click",
        {"s": "h.s", "c": "h.c"},
        TOKEN_SIZE,
    ),
)
def _(v: Views) -> DataFrame:
    rows = v.show.select("user_id", "t_ms", "tokens", F.lit(1).alias("s"), F.lit(0).alias("c")).unionByName(
        v.click.select("user_id", "t_ms", "tokens", F.lit(0).alias("s"), F.lit(1).alias("c"))
    )
    return _token_query(v, rows, ["s", "c"])


@query(
    "freq_control_multi_duration",
    _token_sql("SELECT user_id, t_ms, unnest(tokens) AS token, duration_ms AS d FROM v_read", {"d": "h.d"}, TOKEN_SIZE),
)
def _(v: Views) -> DataFrame:
    return _token_query(v, v.read.select("user_id", "t_ms", "tokens", F.col("duration_ms").alias("d")), ["d"])


@query(
    "ctr_ratio",
    """SELECT user_id, CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS shows,
       CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks,
       CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN count(*) FILTER (event_type = 'click')
         / CAST(count(*) FILTER (event_type = 'view') AS DOUBLE) ELSE 0.0::DOUBLE END AS ctr
       FROM v_event GROUP BY user_id""",
)
def _(v: Views) -> DataFrame:
    counts = v.event.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("shows"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    )
    return counts.withColumn("ctr", scalars.ctr(F.col("shows"), F.col("clicks")))


@query(
    "column_stats_spec",
    """SELECT max(l_quantity) AS l_quantity_max, min(l_quantity) AS l_quantity_min,
       round(avg(l_extendedprice), 4) AS l_extendedprice_avg, round(sum(l_quantity), 2) AS l_quantity_sum,
       count(l_discount) AS l_discount_count, max(l_extendedprice) AS l_extendedprice_max,
       count(*) AS row_count FROM lineitem""",
)
def _(v: Views) -> DataFrame:
    spec = (
        "l_quantity:MAX,l_quantity:MIN,l_extendedprice:AVG,l_quantity:SUM,l_discount:COUNT,l_extendedprice:MAX"
    )
    out = stats.column_stats(v.table("lineitem"), spec)
    return out.withColumns(
        {"l_extendedprice_avg": F.round("l_extendedprice_avg", 4), "l_quantity_sum": F.round("l_quantity_sum", 2)}
    )


# ---------------------------------------------------------------- lookups


@query(
    "click_in_show",
    """WITH l AS (SELECT seq // 100 AS list_id, seq, k, event_type FROM v_event),
       c AS (SELECT DISTINCT list_id, k FROM l WHERE event_type = 'click')
       SELECT l.list_id, string_agg(l.k, ',' ORDER BY l.seq) AS shown,
         string_agg(CASE WHEN c.k IS NULL THEN 0 ELSE 1 END, ',' ORDER BY l.seq) AS flags
       FROM l LEFT JOIN c ON c.list_id = l.list_id AND c.k = l.k WHERE l.event_type = 'view' GROUP BY l.list_id""",
)
def _(v: Views) -> DataFrame:
    lists = v.lists_of(F.struct("event_type", F.col("k").cast("string").alias("id")))

    def ids(kind: str):
        return F.transform(F.filter("entries", lambda e: e["event_type"] == kind), lambda e: e["id"])

    named = lists.select("list_id", ids("view").alias("show"), ids("click").alias("click"))
    flags = sequences.click_in_show(F.col("show"), F.col("click"))
    return named.filter(F.size("show") > 0).select(
        "list_id", F.array_join("show", ",").alias("shown"), F.array_join(flags.cast("array<string>"), ",").alias("flags")
    )


@query(
    "broadcast_lookup",
    """SELECT o.o_orderkey, n.n_name, r.r_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
       JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey""",
)
def _(v: Views) -> DataFrame:
    places = v.table("nation").join(
        v.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    customers = v.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = v.table("orders").select("o_orderkey", "o_custkey")
    named = lookups.lookup_join(customers, places, "c_nationkey", "inner")
    return lookups.lookup_join(orders, named, "o_custkey", "inner", spread=["o_orderkey"]).select(
        "o_orderkey", "n_name", "r_name"
    )


@query(
    "dict_encode",
    """SELECT p.p_partkey, coalesce(d.code, 0) AS code FROM part p
       LEFT JOIN v_dict d ON d.feature = 'brand' AND d.text = p.p_brand AND p.p_size % 9 <> 0""",
)
def _(v: Views) -> DataFrame:
    # a size divisible by nine stands for a text the dictionary does not know
    brand = F.when(F.col("p_size") % 9 == 0, F.concat(F.lit("?"), "p_brand")).otherwise(F.col("p_brand"))
    parts = v.table("part").select("p_partkey", brand.alias("text"))
    return lookups.dict_encode(parts, v.dictionary, "brand", "text", "code").select("p_partkey", "code")


@query(
    "recall_type_encode",
    """WITH p AS (SELECT sample_id, unnest(string_split(recall_type, '|')) AS piece,
         unnest(range(len(string_split(recall_type, '|')))) AS pos FROM v_sample)
       SELECT p.sample_id, coalesce(string_agg(coalesce(d.code, 0), ',' ORDER BY pos)
         FILTER (coalesce(d.code, 0) < 7), '') AS codes
       FROM p LEFT JOIN v_dict d ON d.feature = 'recall' AND d.text = p.piece GROUP BY p.sample_id""",
)
def _(v: Views) -> DataFrame:
    out = lookups.multi_encode(v.sample, v.dictionary, "recall", "recall_type", "sample_id", "codes", limit=7)
    return out.select("sample_id", F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"))


@query(
    "holiday_lookup",
    """SELECT e.event_id, coalesce(a.is_holiday, 0) AS is_holiday, coalesce(b.is_holiday, 0) AS yesterday_is_holiday,
       coalesce(c.is_holiday, 0) AS tomorrow_is_holiday FROM events e
       LEFT JOIN v_calendar a ON a.d = CAST(e.ts AS DATE) LEFT JOIN v_calendar b ON b.d = CAST(e.ts AS DATE) - 1
       LEFT JOIN v_calendar c ON c.d = CAST(e.ts AS DATE) + 1""",
)
def _(v: Views) -> DataFrame:
    rows = v.table("events").select("event_id", F.col("ts").cast("date").alias("day"))
    return lookups.holiday_lookup(rows, v.calendar, "day").select("event_id", *lookups.FLAGS)
