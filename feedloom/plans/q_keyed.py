"""Queries over keyed tables: key scans, upserts, deletes, set-if-absent, expiry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cdc, keyed
from .q_history import RECALL_SQL, recall_lists
from .registry import query
from .views import Views

c = F.col
CELLS = [x for x in cdc.ROW_COLUMNS if x != "event_time"]


@query(
    "key_range_scan",
    """SELECT rowkey, name FROM v_kv WHERE rowkey >= '0000000010' AND rowkey < '0000001200'""",
)
def _(v: Views) -> DataFrame:
    return keyed.key_range(v.kv, "rowkey", "0000000010", "0000001200").select("rowkey", "name")


@query("key_filter_lte", "SELECT rowkey, segment FROM v_kv WHERE rowkey <= '0000000777'")
def _(v: Views) -> DataFrame:
    return keyed.key_at_most(v.kv, "rowkey", "0000000777").select("rowkey", "segment")


@query("key_filter_regex", "SELECT rowkey, name FROM v_kv WHERE regexp_matches(rowkey, '.*7$')")
def _(v: Views) -> DataFrame:
    return keyed.key_matches(v.kv, "rowkey", ".*7$").select("rowkey", "name")


@query("key_filter_substr", "SELECT rowkey, name FROM v_kv WHERE contains(lower(name), 'r#00000010')")
def _(v: Views) -> DataFrame:
    return keyed.key_contains(v.kv, "name", "R#00000010").select("rowkey", "name")


@query(
    "upsert_latest",
    f"""SELECT event_time, {', '.join(f'max_by({x}, seq) AS {x}' for x in CELLS)} FROM v_cdc_rows GROUP BY event_time""",
)
def _(v: Views) -> DataFrame:
    rows = cdc.cdc_flatten(cdc.parse_envelope(v.cdc), "id", keep=("seq",))
    return keyed.upsert_latest(rows, "event_time", CELLS, ["seq"]).select("event_time", *CELLS)


@query(
    "ttl_view",
    """SELECT seq, t_ms + 604800000 AS expire_at FROM v_event WHERE t_ms + 604800000 > 1705708800000""",
)
def _(v: Views) -> DataFrame:
    rows = keyed.with_expiry(v.event.select("seq", "t_ms"), c("t_ms"), 7 * 86_400_000)
    return keyed.alive(rows, F.lit(1_705_708_800_000)).select("seq", "expire_at")


@query(
    "delete_cell",
    """WITH d AS (SELECT rowkey, CASE WHEN segment <> 'MACHINERY' AND bal >= -500 THEN name END AS name,
         CASE WHEN bal >= 0 THEN segment END AS segment, CASE WHEN bal >= -500 THEN bal END AS bal FROM v_kv)
       SELECT * FROM d WHERE coalesce(name, segment, CAST(bal AS VARCHAR)) IS NOT NULL""",
)
def _(v: Views) -> DataFrame:
    poor = c("bal") < -500
    wanted = F.filter(
        F.array(
            F.when((c("segment") == "MACHINERY") | poor, "name"),
            F.when(c("bal") < 0, "segment"),
            F.when(poor, "bal"),
        ),
        lambda x: x.isNotNull(),
    )
    deletes = v.kv.select("rowkey", F.explode(wanted).alias("cell"))
    return keyed.delete_cells(v.kv, deletes, "rowkey", ["name", "segment", "bal"])


@query(
    "check_and_delete",
    """WITH t AS (SELECT rowkey, name, nullif(segment, 'FURNITURE') AS segment, bal FROM v_kv),
       r AS (SELECT rowkey, CASE WHEN bal >= 1000 THEN 'BUILDING' END AS expected FROM v_kv WHERE bal < 5000)
       SELECT t.rowkey, segment, CASE WHEN r.rowkey IS NOT NULL AND segment IS NOT DISTINCT FROM expected
         THEN NULL ELSE name END AS name,
       CASE WHEN r.rowkey IS NOT NULL THEN CAST(segment IS NOT DISTINCT FROM expected AS INTEGER) END AS applied
       FROM t LEFT JOIN r USING (rowkey)""",
)
def _(v: Views) -> DataFrame:
    table = v.kv.withColumn("segment", F.nullif("segment", F.lit("FURNITURE")))
    requests = v.kv.filter(c("bal") < 5000).select("rowkey", F.when(c("bal") >= 1000, "BUILDING").alias("expected"))
    out = keyed.check_and_delete(table, requests, "rowkey", "segment", "name")
    return out.select("rowkey", "segment", "name", c("applied").cast("int").alias("applied"))


@query(
    "check_and_delete_in_order",
    """WITH o AS (SELECT rowkey, name, segment, bal, CAST(rowkey AS BIGINT) % 2 = 1 AS odd FROM v_kv),
       a AS (SELECT *, segment = 'BUILDING' AS a_ok FROM o),
       b AS (SELECT *, odd AND a_ok AS b_ok FROM a),
       f AS (SELECT rowkey, odd, a_ok, b_ok, CASE WHEN NOT a_ok THEN name END AS name,
         CASE WHEN NOT b_ok THEN bal END AS bal, CASE WHEN NOT b_ok THEN segment END AS segment FROM b)
       SELECT rowkey, CAST(unnest([1, 2, 3]) AS BIGINT) AS turn,
         CAST(unnest(CASE WHEN odd THEN [a_ok, b_ok, b_ok] ELSE [false, false, a_ok] END) AS INTEGER) AS applied,
         name, segment, bal FROM f""",
)
def _(v: Views) -> DataFrame:
    """Three requests a key that hang together: they follow each other for odd keys and come in reverse for even ones"""
    table = v.kv.select("rowkey", "name", "segment", "bal")
    odd = c("rowkey").cast("bigint") % 2 == 1
    chain = [("segment", "BUILDING", "name"), ("name", None, "bal"), ("bal", None, "segment")]
    steps = F.array(
        *[
            F.struct(
                F.when(odd, n + 1).otherwise(3 - n).cast("bigint").alias("turn"),
                F.lit(check).alias("check"),
                F.lit(expected).cast("string").alias("expected"),
                F.lit(target).alias("target"),
            )
            for n, (check, expected, target) in enumerate(chain)
        ]
    )
    requests = table.select("rowkey", F.inline(steps))
    final, judged = keyed.delete_in_order(table, requests, "rowkey", ["name", "segment", "bal"], "turn")
    return judged.select("rowkey", "turn", c("applied").cast("int").alias("applied")).join(final, "rowkey")


ACTION_ROWS = """(SELECT seq, t_ms, CAST(user_id AS VARCHAR) AS name, CAST(k AS VARCHAR) AS news_id,
  CASE WHEN event_type = 'click' THEN '1' ELSE '0' END AS click FROM v_event)"""
FIRST_SQL = f"SELECT name, news_id, min_by(click, seq) AS click FROM {ACTION_ROWS} GROUP BY name, news_id"


def action_rows(rows: DataFrame) -> DataFrame:
    from .q_functions import ACTION

    return rows.select("*", F.from_json("value", ACTION).alias("a")).select("seq", "t_ms", "a.*")


@query("hsetnx_first_wins", FIRST_SQL)
def _(v: Views) -> DataFrame:
    return keyed.set_if_absent(action_rows(v.action), "name", "news_id", "click", "seq")


@query(
    "hsetnx_flag_expire",
    f"""SELECT f.name, f.news_id, f.flag, e.expire_at FROM
        (SELECT name, news_id, min_by(click, seq) AS flag FROM {ACTION_ROWS} GROUP BY ALL) f
        JOIN (SELECT name, max(t_ms) + 180000 AS expire_at FROM {ACTION_ROWS} GROUP BY name) e USING (name)""",
)
def _(v: Views) -> DataFrame:
    return keyed.set_flag_with_expiry(action_rows(v.action), "name", "news_id", "click", "seq", "t_ms")


@query(
    "setex_keys",
    f"""SELECT '{{' || user_id || '}}' || articletype || ':bert' AS key, ids AS value,
        1706745600000 + 86400000 AS expire_at FROM ({RECALL_SQL}) WHERE user_id IN (1, 2, 3, 5, 8)""",
)
def _(v: Views) -> DataFrame:
    rows = recall_lists(v).withColumn("user_id", c("user_id").cast("string"))
    allow = ["1", "2", "3", "5", "8"]
    return keyed.setex_rows(rows, "user_id", "articletype", "ids", allow, F.lit(1_706_745_600_000))
