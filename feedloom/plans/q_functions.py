"""Queries over the scalar, sequence and vector functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, scalars, sequences, vectors
from ..operators import lookups, recall
from ..session import materialize
from .registry import query
from .view_sql import NEWS_ID, java_hash_sql
from .views import Views, behavior_json, news_id

c = F.col


def csv(a: Column) -> Column:
    return F.array_join(a.cast("array<string>"), ",")


# ---------------------------------------------------------------- text and hashes


@query(
    "string_to_array",
    """SELECT doc_id, len(a) AS pieces, array_to_string(a, '|') AS joined FROM
       (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\n]+'), lambda x: x <> '') AS a FROM documents)""",
)
def _(v: Views) -> DataFrame:
    scalars.register_sql_functions(v.spark)
    a = v.spread_table("documents").select("doc_id", F.call_function("string_to_array", c("text"), F.lit(r"[ \n]+")).alias("a"))
    return a.select("doc_id", F.size("a").cast("bigint").alias("pieces"), F.array_join("a", "|").alias("joined"))


@query(
    "java_hash",
    f"SELECT doc_id, CAST({java_hash_sql('text')} AS INTEGER) AS h FROM documents",
)
def _(v: Views) -> DataFrame:
    return v.spread_table("documents").select("doc_id", hashing.java_hash(c("text")).alias("h"))


@query(
    "hash_buckets",
    f"""SELECT seq, CAST(abs(h % 1000000) AS INTEGER) AS abs_of_mod, CAST(abs(h) % 10000000 AS INTEGER) AS mod_of_abs,
        CAST(h % 1000000 AS INTEGER) AS signed_mod
        FROM (SELECT seq, {java_hash_sql("(user_id || '-' || t_us)")} AS h FROM v_event)""",
)
def _(v: Views) -> DataFrame:
    h = hashing.java_hash(F.concat_ws("-", "user_id", "t_us"))
    return v.event.select("seq", h.alias("h")).select(
        "seq",
        hashing.bucket_abs_of_mod(c("h"), 1_000_000).alias("abs_of_mod"),
        hashing.bucket_mod_of_abs(c("h"), 10_000_000).alias("mod_of_abs"),
        hashing.bucket_signed(c("h"), 1_000_000).alias("signed_mod"),
    )


def _murmur_sql(text: str) -> str:
    """MurmurHash3 x86 32-bit as nested subqueries: words, body, tail, three mixing steps."""
    m = "4294967295"

    def mul(x: str, k: int) -> str:
        return f"(CAST((CAST({x} AS HUGEINT) * {k}) % 4294967296 AS BIGINT))"

    def rotl(x: str, r: int) -> str:
        return f"((({x} << {r}) & {m}) | ({x} >> {32 - r}))"

    def word(k: str) -> str:
        return mul(rotl(mul(k, 0xCC9E2D51), 15), 0x1B873593)

    step = rotl(f"xor(a, {word('k')})", 13)
    return f"""WITH b AS (SELECT user_id, {text} AS s, octet_length(encode({text})) AS n FROM (SELECT DISTINCT user_id FROM events)),
      w AS (SELECT user_id, n, n // 4 AS nw, list_transform(range(n // 4 + 1), lambda i:
        list_sum(list_transform(range(4), lambda j: CASE WHEN i * 4 + j < n
          THEN CAST(unicode(s[i * 4 + j + 1]) AS BIGINT) << (8 * j) ELSE 0 END))::BIGINT) AS words FROM b),
      h AS (SELECT user_id, n, words[nw + 1] AS k, list_reduce(words[1:nw],
        lambda a, k: ({step} * 5 + 3864292196) & {m}, 0::BIGINT) AS a FROM w),
      f AS (SELECT user_id, xor(xor(a, CASE WHEN n % 4 > 0 THEN {word('k')} ELSE 0 END), n) AS a FROM h),
      f1 AS (SELECT user_id, {mul('xor(a, a >> 16)', 0x85EBCA6B)} AS a FROM f),
      f2 AS (SELECT user_id, {mul('xor(a, a >> 13)', 0xC2B2AE35)} AS a FROM f1),
      f3 AS (SELECT user_id, (xor(a, a >> 16) + 2147483648) % 4294967296 - 2147483648 AS a FROM f2)
      SELECT user_id, abs(a) AS h FROM f3"""


@query(
    "experiment_bucket",
    f"""SELECT s.user_id, CAST(s.h % 100 AS INTEGER) AS layer, CAST(p.h % 10000 AS INTEGER) AS grp
        FROM ({_murmur_sql("('imei' || user_id || 'salt-1')")}) s
        JOIN ({_murmur_sql("('imei' || user_id)")}) p USING (user_id)""",
)
def _(v: Views) -> DataFrame:
    users = v.event.select("user_id").distinct()
    imei = F.concat(F.lit("imei"), c("user_id").cast("string"))
    return users.select(
        "user_id",
        hashing.experiment_bucket(imei, 100, "salt-1").alias("layer"),
        hashing.experiment_bucket(imei, 10_000).alias("grp"),
    )


@query(
    "coding_map",
    f"""WITH l AS (SELECT seq // 100 AS list_id, seq, k, {NEWS_ID} AS tag, seq % 1000 AS w FROM v_event),
        i AS (SELECT list_id, 'int' AS rule, k AS key, max_by(w, seq) AS value FROM l GROUP BY ALL),
        h AS (SELECT list_id, 'hash' AS rule, CAST(abs({java_hash_sql('tag')}) % 1000000 AS INTEGER) AS key, w, seq
          FROM l)
        SELECT list_id, rule, key, CAST(value AS DOUBLE) AS value FROM i
        UNION ALL SELECT list_id, rule, key, CAST(max_by(w, seq) AS DOUBLE) FROM h GROUP BY ALL""",
)
def _(v: Views) -> DataFrame:
    def rows(rule: str, key: Column) -> DataFrame:
        pair = F.concat(key, F.lit(":"), (c("seq") % 1000).cast("string"))
        lists = v.lists_of(pair).select("list_id", F.array_join("entries", ",").alias("text"))
        return lists.select("list_id", F.lit(rule).alias("rule"), F.explode(scalars.coding_map(c("text"), rule)))

    return rows("int", c("k").cast("string")).unionByName(rows("hash", news_id(c("k"))))


@query(
    "coding_map_dictionary",
    """WITH l AS (SELECT seq // 100 AS list_id, seq, 'c' || (k % 13) AS tag, seq % 1000 AS w FROM v_event),
       e AS (SELECT l.*, coalesce(d.code, 0) AS key FROM l
         LEFT JOIN (SELECT * FROM v_dict WHERE feature = 'category') d ON d.text = l.tag)
       SELECT list_id, CAST(key AS INTEGER) AS key, CAST(max_by(w, seq) AS DOUBLE) AS value FROM e GROUP BY ALL""",
)
def _(v: Views) -> DataFrame:
    """Three of the thirteen tags are unknown to the dictionary"""
    pair = F.concat(F.lit("c"), (c("k") % 13).cast("string"), F.lit(":"), (c("seq") % 1000).cast("string"))
    lists = v.lists_of(pair).select("list_id", F.array_join("entries", ",").alias("text"))
    maps = lookups.coding_map_by_dictionary(lists, v.dictionary, "category", "list_id", "text", "m")
    return maps.select("list_id", F.explode("m"))


# ---------------------------------------------------------------- JSON


@query(
    "guarded_double",
    """SELECT seq, CASE WHEN k % 5 = 4 THEN value ELSE 0.0::DOUBLE END AS ctr FROM v_event""",
)
def _(v: Views) -> DataFrame:
    k = c("k") % 5
    text = (
        F.when(k == 0, "{}")
        .when(k == 1, '{"ctr":{"compress":false}}')
        .when(k == 2, '{"ctr":"NaN"}')
        .when(k == 3, '{"ctr":"-Infinity"}')
        .otherwise(F.concat(F.lit('{"ctr":"'), c("value").cast("string"), F.lit('"}')))
    )
    return v.event.select("seq", scalars.guarded_double(F.get_json_object(text, "$.ctr")).alias("ctr"))


def _json_pairs(broken: Column) -> Column:
    first = F.concat(F.lit('{"'), c("k").cast("string"), F.lit('":'), c("value").cast("string"))
    second = F.concat(F.lit(',"'), (c("k") + 100).cast("string"), F.lit('":"2.5"}'))
    return F.when(c("k") % 9 == 0, None).when(broken, F.concat(first, F.lit(',"x":"y"}'))).otherwise(
        F.concat(first, second)
    )


@query(
    "json_int_map",
    """SELECT seq, k AS key, value FROM v_event WHERE k % 9 <> 0
       UNION ALL SELECT seq, k + 100, 2.5::DOUBLE FROM v_event WHERE k % 9 <> 0
       UNION ALL SELECT seq, 0, 0.0::DOUBLE FROM v_event WHERE k % 9 = 0""",
)
def _(v: Views) -> DataFrame:
    return v.event.select("seq", F.explode(scalars.json_int_map(_json_pairs(F.lit(False)))))


@query(
    "json_string_map",
    """SELECT seq, CAST(k AS VARCHAR) AS key, value FROM v_event WHERE k % 9 <> 0 AND k % 10 <> 0
       UNION ALL SELECT seq, CAST(k + 100 AS VARCHAR), 2.5::DOUBLE FROM v_event WHERE k % 9 <> 0 AND k % 10 <> 0
       UNION ALL SELECT seq, '', 0.0::DOUBLE FROM v_event WHERE k % 9 = 0 OR k % 10 = 0""",
)
def _(v: Views) -> DataFrame:
    return v.event.select("seq", F.explode(scalars.json_string_map(_json_pairs(c("k") % 10 == 0))))


@query(
    "parse_action_json",
    """SELECT seq, CAST(user_id AS VARCHAR) AS name, CAST(k AS VARCHAR) AS news_id,
       CAST(CAST(event_type = 'click' AS INTEGER) AS VARCHAR) AS click,
       CAST(CAST(event_type = 'view' AS INTEGER) AS VARCHAR) AS show FROM v_event""",
)
def _(v: Views) -> DataFrame:
    return v.action.select("seq", F.from_json("value", ACTION).alias("a")).select("seq", "a.*")


ACTION = "name string, news_id string, click string, show string"


# ---------------------------------------------------------------- sequences


@query(
    "json_tuple_sequence",
    f"""SELECT seq // 100 AS list_id, CAST(row_number() OVER (PARTITION BY seq // 100 ORDER BY seq) - 1 AS INTEGER)
        AS pos, t_ms AS t, {NEWS_ID} AS v FROM v_event""",
)
def _(v: Views) -> DataFrame:
    lists = v.lists_of(F.struct(c("t_ms").alias("t"), news_id(c("k")).alias("v")))
    text = F.to_json(
        F.struct(
            F.transform("entries", lambda e: e["t"]).alias("t1"), F.transform("entries", lambda e: e["v"]).alias("t2")
        )
    )
    seq = sequences.tuple_sequence(text)
    return lists.select("list_id", F.posexplode(seq).alias("pos", "e")).select("list_id", "pos", "e.t", "e.v")


def _weighted_sql(prefix: str, code: str, take: int) -> str:
    """The heaviest keys of an event's weighted map, coded, filled up and joined"""
    keys = [f"'{prefix}' || (k % 7)", f"'{prefix}' || (7 + k % 5)", f"'{prefix}' || (12 + k % 3)"]
    weights = ["(k % 4)::DOUBLE", "(k % 3) + 0.5::DOUBLE", "1::DOUBLE"]
    entries = ", ".join(f"{{'w': -({w}), 'k': {key}}}" for w, key in zip(weights, keys))
    codes = f"list_transform(list_sort([{entries}]), lambda e: CAST({code.format(key='e.k')} AS VARCHAR))"
    return f"array_to_string(list_resize({codes}, {take}, '0'), '#')"


POS = "CAST(row_number() OVER (PARTITION BY list_id ORDER BY seq) - 1 AS INTEGER) AS pos"
HASH_CODE = "(abs(" + java_hash_sql("{key}") + " % 1000000))"
# a list's entries that are not empty
LISTED = "(SELECT *, seq // 100 AS list_id FROM v_event WHERE k % 19 <> 0)"


CODED = f"""FROM (SELECT l.*, d.category FROM {LISTED} l
        JOIN (SELECT p.seq, array_to_string(list_resize(list(CAST(coalesce(code, 0) AS VARCHAR) ORDER BY rank), 1, '0'),
          '#') AS category FROM (SELECT seq, unnest(keys) AS key, unnest(range(1, 4)) AS rank FROM
            (SELECT seq, list_transform(list_sort([{{'w': -((k % 4)::DOUBLE), 'k': 'c' || (k % 7)}},
              {{'w': -((k % 3) + 0.5::DOUBLE), 'k': 'c' || (7 + k % 5)}}, {{'w': -1::DOUBLE, 'k': 'c' || (12 + k % 3)}}]),
              lambda e: e.k) AS keys FROM v_event)) p
          LEFT JOIN v_dict d ON d.feature = 'category' AND d.text = p.key GROUP BY p.seq) d ON d.seq = l.seq)"""
SEQ_FIELDS = f"""{_weighted_sql("", "CAST({key} AS INTEGER)", 5)} AS topics, {_weighted_sql("tag", HASH_CODE, 2)} AS tags,
  category"""


def parsed_lists(v: Views) -> DataFrame:
    """The behaviour lists as maps, parsed once for all fields"""
    return materialize(v.sequence.select("list_id", sequences.behavior_entries(c("entries")).alias("parsed")), "parsed")


@query("parse_behavior_seq", f"SELECT list_id, {POS}, t_ms AS t, {NEWS_ID} AS news_id, {SEQ_FIELDS} {CODED}")
def _(v: Views) -> DataFrame:
    lists, parsed = parsed_lists(v), c("parsed")
    keyed = lists.select("list_id", sequences.behavior_keys(parsed, "news_category_v3", 1).alias("keys"))
    coded = lookups.encode_sequence(keyed, v.dictionary, "list_id", "keys", "category", 1, "category")
    read = lists.select(
        "list_id",
        sequences.behavior_seq(parsed, "news_id").alias("ids"),
        sequences.behavior_seq(parsed, "news_topic_vec_v2", 5).alias("topics"),
        sequences.behavior_seq(parsed, "news_content_tag_vec_v2", 2).alias("tags"),
    ).join(coded, "list_id")
    zipped = F.arrays_zip("ids", "topics", "tags", "category")
    return read.select("list_id", F.posexplode(zipped).alias("pos", "e")).select(
        "list_id",
        "pos",
        c("e.ids.t").alias("t"),
        c("e.ids.v").alias("news_id"),
        c("e.topics.v").alias("topics"),
        c("e.tags.v").alias("tags"),
        c("e.category.v").alias("category"),
    )


DURATION_SQL = "CASE WHEN k % 6 = 0 THEN 0.0::DOUBLE ELSE k * 100.0::DOUBLE END AS d"


@query("parse_duration_seq", f"SELECT list_id, {POS}, t_ms AS t, {NEWS_ID} AS v, {DURATION_SQL} FROM {LISTED}")
def _(v: Views) -> DataFrame:
    seq = sequences.parse_duration_seq(c("entries"), "news_id")
    return v.sequence.select("list_id", F.posexplode(seq).alias("pos", "e")).select("list_id", "pos", "e.*")


@query("parse_duration_seq_coded", f"SELECT list_id, {POS}, t_ms AS t, {SEQ_FIELDS}, {DURATION_SQL} {CODED}")
def _(v: Views) -> DataFrame:
    """Weighted fields with durations: keys that are codes, hashed keys and keys of the dictionary"""
    lists, parsed = parsed_lists(v), c("parsed")
    keyed = lists.select("list_id", sequences.duration_keys(parsed, "news_category_v3", 1).alias("keys"))
    coded = lookups.encode_sequence(keyed, v.dictionary, "list_id", "keys", "category", 1, "category", duration=True)
    read = lists.select(
        "list_id",
        sequences.duration_seq(parsed, "news_topic_vec_v2", 5).alias("topics"),
        sequences.duration_seq(parsed, "news_content_tag_vec_v2", 2).alias("tags"),
    ).join(coded, "list_id")
    zipped = F.arrays_zip("topics", "tags", "category")
    return read.select("list_id", F.posexplode(zipped).alias("pos", "e")).select(
        "list_id",
        "pos",
        c("e.category.t").alias("t"),
        c("e.topics.v").alias("topics"),
        c("e.tags.v").alias("tags"),
        c("e.category.v").alias("category"),
        F.when(c("e.topics.d") == c("e.category.d"), c("e.category.d")).alias("d"),
    )


@query(
    "pad_sequence",
    """SELECT list_id, len(a) AS real_length, array_to_string(list_resize(a, 121, 0), ',') AS padded,
       array_to_string(list_resize(a, 50, 2000), ',') AS cut FROM
       (SELECT seq // 100 AS list_id, list(k ORDER BY seq) AS a FROM v_event GROUP BY 1)""",
)
def _(v: Views) -> DataFrame:
    lists = v.lists_of(c("k"))
    return lists.select(
        "list_id",
        F.size("entries").cast("bigint").alias("real_length"),
        csv(sequences.pad(c("entries"), 121, F.lit(0))).alias("padded"),
        csv(sequences.pad(c("entries"), 50, F.lit(2000))).alias("cut"),
    )


@query(
    "flatten_tokens",
    """SELECT seq // 100 AS list_id, array_to_string(flatten(list([k % 5, 5 + k % 20, 25 + k] ORDER BY seq))[1:250], ',')
       AS tokens FROM v_event GROUP BY 1""",
)
def _(v: Views) -> DataFrame:
    k = c("k")
    lists = v.lists_of(F.concat_ws("#", *[x.cast("string") for x in (k % 5, 5 + k % 20, 25 + k)]))
    return lists.select("list_id", csv(sequences.flatten_tokens(c("entries"), 250)).alias("tokens"))


@query(
    "topn_map_tokens",
    f"""WITH r AS (SELECT doc_id, tag, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, tag) AS rn FROM v_tags),
        t AS (SELECT doc_id, list(CAST(abs({java_hash_sql('tag')} % 1000000) AS VARCHAR) ORDER BY rn) AS a FROM r
          WHERE rn <= 5 GROUP BY doc_id)
        SELECT doc_id, array_to_string(list_resize(a, 5, '0'), '#') AS top5, a[1] AS top1 FROM t""",
)
def _(v: Views) -> DataFrame:
    top = recall.topn_codes(v.tags, "doc_id", "tag", "w", 5, sequences.hash_code)
    return top.select("doc_id", sequences.filled(c("codes"), 5).alias("top5"), c("codes")[0].alias("top1"))


# ---------------------------------------------------------------- numbers and time


@query(
    "duration_seconds",
    "SELECT seq, (k * 137 + 5) // 10 / 100.0::DOUBLE AS seconds FROM v_event",
)
def _(v: Views) -> DataFrame:
    number = (c("k") * 137).cast("string")
    text = F.when(c("k") % 2 == 0, number).otherwise(F.concat(F.lit('{"duration":"'), number, F.lit('"}')))
    return v.event.select("seq", scalars.duration_seconds(text).alias("seconds"))


@query(
    "scene_time",
    """SELECT event_id AS seq, CAST(hour(ts) AS INTEGER) AS hour_utc, CAST(isodow(ts) AS INTEGER) AS weekday_utc,
       CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS hour_local,
       CAST(isodow(ts + INTERVAL 8 HOUR) AS INTEGER) AS weekday_local FROM events""",
)
def _(v: Views) -> DataFrame:
    t = c("t_ms")
    return v.event.select(
        "seq",
        scalars.hour_of(t).alias("hour_utc"),
        scalars.weekday_of(t).alias("weekday_utc"),
        scalars.hour_of(t, "Asia/Shanghai").alias("hour_local"),
        scalars.weekday_of(t, "Asia/Shanghai").alias("weekday_local"),
    )


@query(
    "device_age_months",
    """SELECT seq, CAST(least((k * 2592000000 + (seq % 3) * 1000 - 1000) // 2592000000, 60) AS DOUBLE) AS months FROM v_event""",
)
def _(v: Views) -> DataFrame:
    sale = c("t_ms") - (c("k") * F.lit(30 * scalars.DAY_MS) + (c("seq") % 3) * 1000 - 1000)
    return v.event.select("seq", scalars.device_age_months(c("t_ms"), sale).alias("months"))


@query(
    "item_age_hours",
    """SELECT seq, CASE WHEN h > 0 AND h < 360 THEN CAST(h AS DOUBLE) ELSE 0.0::DOUBLE END AS hours FROM
       (SELECT seq, CAST(floor((k * 5 - 20) + (seq % 4) / 4.0) AS BIGINT) AS h FROM v_event)""",
)
def _(v: Views) -> DataFrame:
    age = (c("k") * 5 - 20) * F.lit(scalars.HOUR_MS) + (c("seq") % 4) * F.lit(scalars.HOUR_MS // 4)
    return v.event.select("seq", scalars.item_age_hours(c("t_ms"), c("t_ms") - age).alias("hours"))


@query(
    "read_completion",
    """WITH r AS (SELECT seq, CAST(round(value * 100) AS BIGINT) - 500 AS read_ms, k - 20 AS video FROM v_event)
       SELECT seq, CASE WHEN read_ms > 0 THEN read_ms / 1000.0::DOUBLE ELSE 0.0::DOUBLE END AS read_s,
       CASE WHEN video > 0 THEN CAST(video AS DOUBLE) ELSE 0.0::DOUBLE END AS video_s,
       CASE WHEN video > 0 THEN least(1.0::DOUBLE,
         (CASE WHEN read_ms > 0 THEN read_ms / 1000.0::DOUBLE ELSE 0.0::DOUBLE END) / video)
         ELSE 0.0::DOUBLE END AS rate FROM r""",
)
def _(v: Views) -> DataFrame:
    read, video = F.round(c("value") * 100).cast("bigint") - 500, c("k") - 20
    return v.event.select(
        "seq",
        scalars.clean_read_seconds(read).alias("read_s"),
        scalars.clean_video(video).alias("video_s"),
        scalars.completion_rate(read, video).alias("rate"),
    )


@query(
    "safe_int",
    "SELECT seq, CASE WHEN k % 3 < 2 THEN 0 ELSE k END AS n FROM v_event",
)
def _(v: Views) -> DataFrame:
    text = F.when(c("k") % 3 == 0, "").when(c("k") % 3 == 1, None).otherwise(c("k").cast("string"))
    return v.event.select("seq", scalars.safe_int(text).alias("n"))


@query(
    "parse_minute",
    """SELECT seq, t_ms // 60000 * 60000 AS minute_ms, strftime(make_timestamp(t_us), '%Y-%m-%d') AS day,
       strftime(make_timestamp(t_us), '%H') AS hour FROM v_event""",
)
def _(v: Views) -> DataFrame:
    text = scalars.format_ms(c("t_ms"), "yyyy-MM-dd HH mm")
    return v.event.select("seq", text.alias("x")).select(
        "seq",
        scalars.parse_minute(c("x")).alias("minute_ms"),
        scalars.day_part(c("x")).alias("day"),
        scalars.hour_part(c("x")).alias("hour"),
    )


@query(
    "date_offset",
    """SELECT seq, strftime(make_timestamp(t_us) - INTERVAL 7 DAY, '%Y-%m-%d') AS week_ago,
       strftime(make_timestamp(t_us), '%H') AS current_hour FROM v_event""",
)
def _(v: Views) -> DataFrame:
    at = scalars.ms_to_ntz(c("t_ms"))
    return v.event.select(
        "seq", scalars.date_offset(at, 7).alias("week_ago"), F.date_format(at, "HH").alias("current_hour")
    )


# ---------------------------------------------------------------- vectors


def _cells(df: DataFrame, pairs: Column) -> DataFrame:
    """One row per cell, in place"""
    return df.select("item_id", F.posexplode(pairs).alias("pos", "e")).select("item_id", "pos", "e.i", "e.v")


CELLS = """SELECT item_id, unnest(embedding) AS x, unnest(range(64)) AS n FROM v_item"""


@query(
    "sparse_export",
    f"""WITH cells AS (SELECT item_id, CAST(n AS INTEGER) AS i, x AS v FROM ({CELLS}) WHERE x > 0.2),
        d AS (SELECT item_id, i, v FROM cells UNION ALL SELECT item_id, 2000, 0.0::DOUBLE FROM v_item
          WHERE item_id NOT IN (SELECT item_id FROM cells))
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY i) - 1 AS INTEGER) AS pos, i, v FROM d""",
)
def _(v: Views) -> DataFrame:
    kept = F.transform("embedding", lambda x: F.when(x > 0.2, x).otherwise(0.0))
    indices = F.sequence(F.lit(0), F.lit(63))
    items = v.item.select("item_id", indices.alias("ix"), kept.alias("vs"))
    return _cells(items, vectors.sparse_export(c("ix"), c("vs"), vectors.TOPIC_DEFAULT))


@query(
    "map_to_sparse",
    f"""WITH cells AS (SELECT item_id, CAST(n * 3 AS INTEGER) AS i, x AS v FROM ({CELLS}) WHERE x > 0 AND n * 3 < 100)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY i) - 1 AS INTEGER) AS pos, i, v
        FROM cells""",
)
def _(v: Views) -> DataFrame:
    keys = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda n: (F.lit(63) - n) * 3)
    items = v.item.select("item_id", F.map_from_arrays(keys, F.reverse("embedding")).alias("m"))
    return _cells(items, vectors.map_to_sparse(c("m"), 100))


@query(
    "sparse_to_dense",
    f"""SELECT item_id, CAST(n AS INTEGER) AS pos, CASE WHEN x > 0.1 THEN x ELSE 0.0::DOUBLE END AS v FROM ({CELLS})
        UNION ALL SELECT item_id, 64, 0.0::DOUBLE FROM v_item""",
)
def _(v: Views) -> DataFrame:
    cells = F.filter(
        F.transform("embedding", lambda x, n: F.struct(n.alias("i"), x.alias("v"))), lambda e: e["v"] > 0.1
    )
    items = v.item.select("item_id", cells.alias("p"))
    dense = vectors.sparse_to_dense(vectors.indices_of(c("p")), vectors.values_of(c("p")), 65)
    return items.select("item_id", F.posexplode(dense).alias("pos", "v"))


@query(
    "vector_repair",
    f"""SELECT item_id, CAST(n AS INTEGER) AS pos, CAST(n + CASE WHEN label % 3 = 2 THEN 1 ELSE 0 END AS INTEGER) AS i,
          x AS v FROM (SELECT item_id, label, unnest(embedding) AS x, unnest(range(64)) AS n FROM v_item)
          WHERE label % 3 <> 0
        UNION ALL SELECT item_id, 0, 0, 0.0::DOUBLE FROM v_item WHERE label % 3 = 0""",
)
def _(v: Views) -> DataFrame:
    kind = c("label") % 3
    own = F.sequence(F.lit(1), F.lit(64))
    indices = F.when(kind == 1, F.array().cast("array<int>")).when(kind == 2, own)
    items = v.item.select("item_id", indices.alias("ix"), c("embedding").alias("vs"))
    return _cells(items, vectors.vector_repair(c("ix"), c("vs")))


@query(
    "argmax_category",
    """SELECT item_id, CAST((list_position(embedding, list_max(embedding)) - 1) * 2 AS INTEGER) AS category
       FROM v_item""",
)
def _(v: Views) -> DataFrame:
    indices = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda n: n * 2)
    return v.item.select("item_id", vectors.argmax_index(indices, c("embedding")).alias("category"))


@query(
    "cosine_user_item",
    f"""WITH cells AS (SELECT item_id, label, unnest(embedding) AS x, unnest(range(64)) AS n FROM v_item),
        u AS (SELECT label, n, avg(x) AS y FROM cells GROUP BY label, n)
        SELECT item_id, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS cos_dense,
        round(sum(CASE WHEN x > 0 THEN x * y ELSE 0 END) / (sqrt(sum(CASE WHEN x > 0 THEN x * x ELSE 0 END))
          * sqrt(sum(y * y))), 6) AS cos_sparse
        FROM cells JOIN u USING (label, n) GROUP BY item_id""",
)
def _(v: Views) -> DataFrame:
    # a label's mean vector stands for a user's long-term vector
    cells = v.item.select("label", F.posexplode("embedding").alias("n", "x"))
    means = cells.groupBy("label", "n").agg(F.avg("x").alias("y"))
    users = means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "y"))), lambda e: e["y"]).alias("u")
    )
    pairs = lookups.lookup_join(v.item, users, "label", "inner", spread=["item_id"])
    own = F.filter(F.transform("embedding", lambda x, n: F.struct(n.alias("i"), x.alias("v"))), lambda e: e["v"] > 0)
    pairs = pairs.withColumns({"p": own, "all": F.sequence(F.lit(0), F.size("u") - 1)})
    sparse = vectors.cosine_sparse(
        vectors.indices_of(c("p")), vectors.values_of(c("p")), c("all"), c("u")
    )
    return pairs.select(
        "item_id",
        F.round(vectors.cosine_dense(c("embedding"), c("u")), 6).alias("cos_dense"),
        F.round(sparse, 6).alias("cos_sparse"),
    )
