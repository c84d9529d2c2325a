"""The stand-in inputs of ``views`` as SQL, for the comparison queries."""

from __future__ import annotations

import re


def java_hash_sql(text: str) -> str:
    units = (
        f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) > 65535 "
        "THEN [55296 + ((unicode(c) - 65536) >> 10), 56320 + ((unicode(c) - 65536) & 1023)] "
        "ELSE [unicode(c)] END))"
    )
    folded = f"list_reduce({units}, lambda a, u: (a * 31 + u) & 4294967295, 0::BIGINT)"
    return f"(CASE WHEN {text} = '' THEN 0 ELSE ({folded} + 2147483648) % 4294967296 - 2147483648 END)"


def history_sql(kind: str) -> str:
    return f"""SELECT seq, user_id, k AS item_id, k % 5 AS cat, k % 20 AS sub,
      [k % 5, 5 + k % 20, 25 + k % 100] AS tokens, t_ms, CAST(round(value * 1000) AS BIGINT) AS duration_ms
      FROM v_event WHERE event_type = '{kind}'"""


def nearest_list_sql(centroids: str) -> str:
    """Every item with all lists, by the nearness of their centroids"""
    return f"""SELECT item_id, i.u AS u, list, row_number() OVER (PARTITION BY item_id ORDER BY
      list_dot_product(i.u, c.u) / CASE WHEN list_dot_product(c.u, c.u) > 0 THEN sqrt(list_dot_product(c.u, c.u)) ELSE 1 END
      DESC, list) AS place FROM v_unit i, {centroids} c"""


NEWS_ID = "(CASE WHEN k % 11 = 0 THEN 'V06' ELSE 'V00' END) || k"

VIEWS = {
    "v_event": """SELECT event_id AS seq, user_id, event_type,
      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
      epoch_us(ts) // 1000 AS t_ms, epoch_us(ts) AS t_us, value FROM events""",
    "v_show": history_sql("view"),
    "v_click": history_sql("click"),
    "v_read": history_sql("purchase"),
    "v_sample": f"""SELECT seq AS sample_id,
      lpad(CAST(t_ms - (seq % 7200) * 1000 AS VARCHAR), 13, '0') || user_id AS token,
      user_id, k AS item_id, k % 5 AS cat, k % 20 AS sub, [k % 5, 5 + k % 20, 25 + k % 100] AS tokens,
      t_ms AS event_time, t_ms - 86400000 * (seq % 3) AS collect_start, {NEWS_ID} AS news_id,
      (20 + k % 10) || '|' || (k % 7) AS recall_type FROM v_event""",
    "v_wordtime": """SELECT seq, user_id, t_us - (CASE WHEN seq % 7 = 0 THEN 36000000000 ELSE 0 END) AS t
      FROM v_event""",
    "v_item": """SELECT vec_id AS item_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS embedding
      FROM embeddings""",
    "v_unit": """SELECT item_id, list_transform(embedding, lambda x: CAST(floor(
      x / sqrt(list_dot_product(embedding, embedding)) * 10000) AS DOUBLE)) AS u FROM v_item""",
    "v_seeds": """SELECT row_number() OVER (ORDER BY item_id) - 1 AS list, u FROM v_unit
      WHERE CAST('0x' || substr(md5(CAST(item_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE
        < floor(sqrt((SELECT count(*) FROM v_unit))) / (SELECT count(*) FROM v_unit)::DOUBLE""",
    "v_first_lists": nearest_list_sql("v_seeds"),
    "v_means": """SELECT list, list(m ORDER BY d) AS u FROM (
        SELECT list, d, floor(sum(x) / count(*)) AS m FROM
          (SELECT list, unnest(u) AS x, unnest(range(len(u))) AS d FROM v_first_lists WHERE place = 1)
        GROUP BY list, d) GROUP BY list
      UNION ALL SELECT list, u FROM v_seeds
        WHERE list NOT IN (SELECT list FROM v_first_lists WHERE place = 1)""",
    "v_lists": nearest_list_sql("v_means"),
    "v_near": """SELECT q.item_id, x.item_id AS neighbor FROM v_lists q JOIN v_lists x
        ON x.list = q.list AND x.place = 1 AND x.item_id <> q.item_id
      WHERE q.place <= ceil((SELECT count(*) FROM v_seeds) * (2.0::DOUBLE / 3))
      QUALIFY row_number() OVER (PARTITION BY q.item_id ORDER BY list_dot_product(q.u, x.u) DESC, x.item_id) <= 5""",
    "v_neighbors": """SELECT item_id AS news_id, CAST(neighbor AS VARCHAR) AS recalled,
      CAST(label AS VARCHAR) AS articletype FROM v_near JOIN v_item USING (item_id)""",
    "v_tags": """SELECT doc_id, tag, CAST(count(*) AS DOUBLE) AS w FROM
      (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS tag FROM documents)
      WHERE tag <> '' GROUP BY doc_id, tag""",
    "v_dict": """SELECT feature, text, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY text) AS INTEGER) AS code
      FROM (SELECT DISTINCT 'source' AS feature, source AS text FROM documents
        UNION SELECT DISTINCT 'lang', lang FROM documents
        UNION SELECT DISTINCT 'brand', p_brand FROM part
        UNION SELECT DISTINCT 'recall', '2' || (k % 8) FROM v_event
        UNION SELECT DISTINCT 'category', 'c' || (k % 10) FROM v_event) WHERE text IS NOT NULL""",
    "v_calendar": """SELECT d, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_holiday FROM
      (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(ts AS DATE) FROM events)""",
    "v_turn": """SELECT conv_id, turn, role, length(text) AS n, conv_id * 7 + turn AS x,
      lpad(CAST(conv_id AS VARCHAR), 10, '0') || '_' || lpad(CAST(turn // 10 AS VARCHAR), 4, '0') AS rowkey,
      'V00' || turn AS news_id, 1700000000000 + conv_id * 60000 + (turn // 10) * 1000 AS req FROM conversations""",
    "v_request": "SELECT DISTINCT rowkey, conv_id, req FROM v_turn",
    "v_label": """SELECT rowkey, req, conv_id, turn, news_id, n, role, x,
      CASE WHEN role = 'user' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS clicked,
      CASE WHEN x % 4 = 1 THEN CAST(n * 10 AS INTEGER) END AS duration,
      CASE WHEN x % 3 <> 0 THEN CAST('0.' || (x % 10) AS DOUBLE) ELSE 0.0::DOUBLE END AS pctr,
      CASE WHEN x % 3 <> 0 THEN (20 + x % 10) || '|3' ELSE '' END AS recall_type,
      CAST(x % 5 = 0 AS INTEGER) AS feedback_negative_flag, CAST(turn % 3 = 0 AS INTEGER) AS feedback_like_flag,
      CAST(x % 7 = 0 AS INTEGER) AS feedback_comment_flag, CAST(x % 4 = 0 AS INTEGER) AS feedback_collect_flag,
      CAST(x % 6 = 0 AS INTEGER) AS feedback_share_flag,
      CASE WHEN x % 2 = 0 THEN CAST(n + 1 AS VARCHAR) ELSE CAST(n AS VARCHAR) END AS len
      FROM v_turn WHERE x % 17 <> 0""",
    "v_cdc": """SELECT o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'INSERT' WHEN 'O' THEN 'UPDATE'
      ELSE 'DELETE' END AS type, epoch_ms(o_orderdate) AS ts,
      '{"id":"' || o_orderkey || '","cust":"' || o_custkey || '","priority":"' || o_orderpriority || '"}' AS params
      FROM orders""",
    "v_cdc_rows": """SELECT seq, CAST(ts AS VARCHAR) AS event_time,
      strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S') AS date_time, 'shop' AS db_name,
      'orders' AS table_name, CAST(seq AS VARCHAR) AS primary_key, params, type AS action_type FROM v_cdc""",
    "v_kv": """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS rowkey, c_name AS name,
      c_mktsegment AS segment, c_acctbal AS bal FROM customer""",
}


def with_views(sql: str) -> str:
    """Put the views a query names, and those they name, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_[a-z_]+\b", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = sql.strip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {head},\n{body[4:].lstrip()}"
    return f"WITH {head}\n{body}"
