"""Stand-in inputs derived from the given tables, as lazy DataFrames.

``view_sql`` holds the same derivations as SQL. Every view reads its whole table. Dictionaries and the
calendar are lookup tables that a job finds ready, so they are written out once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import DAY_MS, epoch_ms, epoch_us, int_div
from ..operators import lookups, neighbors, recall
from ..operators.skew import lookup_join
from ..session import materialize
from ..sources import readers

# fixed values of the stand-ins: rows per behaviour list, items per request
SEQ_ROWS = 100
PAGE_TURNS = 10
# length of the behaviour sequences, and entries a user's cells keep per kind: the longest padded sequences
LIST_ROWS = 121
CELL_ROWS = 1000
# behaviour kind of an event type
KINDS = {"view": "show", "click": "click", "purchase": "duration"}


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def stream(self, name: str, files_per_trigger: int = 1000) -> DataFrame:
        """A given table as a file stream; the glob lets the table be one file or a folder of files"""
        path = self.path(name)
        return readers.stream_files(
            self.spark, f"{path[:-1]}[{path[-1]}]", self.table(name).schema, files_per_trigger=files_per_trigger
        )

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def spread_table(self, name: str) -> DataFrame:
        return readers.spread(self.table(name))

    # ------------------------------------------------------------ events

    @cached_property
    def event(self) -> DataFrame:
        return self.event_rows(self.table("events"))

    @cached_property
    def spread_event(self) -> DataFrame:
        """The same rows for work that is heavy per row"""
        return self.event_rows(self.spread_table("events"))

    @staticmethod
    def event_rows(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("event_id").alias("seq"),
            "user_id",
            "event_type",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            epoch_ms(F.col("ts")).alias("t_ms"),
            epoch_us(F.col("ts")).alias("t_us"),
            "value",
        )

    def _history(self, kind: str, event: DataFrame | None = None) -> DataFrame:
        return (self.event if event is None else event).filter(F.col("event_type") == kind).select(
            "seq",
            "user_id",
            F.col("k").alias("item_id"),
            (F.col("k") % 5).alias("cat"),
            (F.col("k") % 20).alias("sub"),
            item_tokens(F.col("k")).alias("tokens"),
            "t_ms",
            F.round(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
        )

    @cached_property
    def show(self) -> DataFrame:
        return self._history("view")

    @cached_property
    def click(self) -> DataFrame:
        return self._history("click")

    def click_since(self, start_ms: int) -> DataFrame:
        """The clicks from a time on; the bound is on the stored column, so it reaches the scan"""
        since = self.table("events").filter(F.col("ts") >= readers.ntz_literal(start_ms))
        return self._history("click", self.event_rows(since))

    @cached_property
    def read(self) -> DataFrame:
        return self._history("purchase")

    @cached_property
    def sample(self) -> DataFrame:
        k, seq, t = F.col("k"), F.col("seq"), F.col("t_ms")
        token_ms = (t - (seq % 7200) * 1000).cast("string")
        return self.event.select(
            seq.alias("sample_id"),
            F.concat(F.lpad(token_ms, 13, "0"), F.col("user_id").cast("string")).alias("token"),
            "user_id",
            k.alias("item_id"),
            (k % 5).alias("cat"),
            (k % 20).alias("sub"),
            item_tokens(k).alias("tokens"),
            t.alias("event_time"),
            (t - F.lit(DAY_MS) * (seq % 3)).alias("collect_start"),
            news_id(k).alias("news_id"),
            F.concat((20 + k % 10).cast("string"), F.lit("|"), (k % 7).cast("string")).alias("recall_type"),
        )

    @cached_property
    def action(self) -> DataFrame:
        """Action lines as JSON text, with their arrival number and time"""
        e = self.event
        return e.select("seq", "t_ms", action_json().alias("value"))

    @cached_property
    def wordtime(self) -> DataFrame:
        """'user,time' text; every seventh row is set back by ten hours, so that times are not ascending"""
        return self.event.select("seq", wordtime_text().alias("value"))

    @cached_property
    def sequence(self) -> DataFrame:
        """Behaviour lists: runs of SEQ_ROWS events as arrays of JSON strings, in arrival order"""
        return self._lists(behavior_json())

    def _lists(self, element: Column) -> DataFrame:
        rows = self.spread_event.select(int_div(F.col("seq"), SEQ_ROWS).alias("list_id"), "seq", element.alias("x"))
        return rows.groupBy("list_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("seq", "x"))), lambda e: e["x"]).alias("entries")
        )

    def lists_of(self, element: Column) -> DataFrame:
        return self._lists(element)

    # ------------------------------------------------------------ items, tags

    @cached_property
    def item(self) -> DataFrame:
        return self.spread_table("embeddings").select(
            F.col("vec_id").alias("item_id"),
            "label",
            F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
        )

    @cached_property
    def neighbors(self) -> DataFrame:
        """A neighbour table as recall reads it: the five nearest others found of every item, by whole vectors"""
        items = self.item.select("item_id", "embedding")
        found = materialize(neighbors.nearest(items, "item_id", "embedding"), "neighbors")
        kinds = self.item.select("item_id", F.col("label").cast("string").alias("articletype"))
        named = lookup_join(found, kinds, "item_id", "inner", spread=["neighbor"])
        return named.select(
            F.col("item_id").alias("news_id"), F.col("neighbor").cast("string").alias("recalled"), "articletype"
        )

    @cached_property
    def tokens(self) -> DataFrame:
        """Tokens of whole documents, one row each"""
        token = F.explode(F.split("text", "[ \t\n\r\f]+")).alias("tag")
        rows = self.spread_table("documents").select("doc_id", token).filter(F.col("tag") != "")
        return rows.withColumn("w", F.lit(1.0))

    @cached_property
    def tags(self) -> DataFrame:
        """Token counts of whole documents"""
        return self.tokens.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).cast("double").alias("w"))

    @cached_property
    def tag_maps(self) -> DataFrame:
        return self.tags.groupBy("doc_id").agg(
            F.map_from_entries(F.collect_list(F.struct("tag", "w"))).alias("m")
        )

    @cached_property
    def dict_texts(self) -> DataFrame:
        docs, part = self.table("documents"), self.table("part")
        return (
            docs.select(F.lit("source").alias("feature"), F.col("source").alias("text"))
            .unionByName(docs.select(F.lit("lang").alias("feature"), F.col("lang").alias("text")))
            .unionByName(part.select(F.lit("brand").alias("feature"), F.col("p_brand").alias("text")))
            .unionByName(
                self.event.select(
                    F.lit("recall").alias("feature"), F.concat(F.lit("2"), (F.col("k") % 8).cast("string")).alias("text")
                )
            )
            .unionByName(
                self.event.select(
                    F.lit("category").alias("feature"),
                    F.concat(F.lit("c"), (F.col("k") % 10).cast("string")).alias("text"),
                )
            )
        )

    @cached_property
    def dictionary(self) -> DataFrame:
        return materialize(lookups.build_dictionary(self.dict_texts), "dictionary")

    @cached_property
    def calendar(self) -> DataFrame:
        days = (
            self.table("orders")
            .select(F.col("o_orderdate").cast("date").alias("d"))
            .union(self.table("events").select(F.col("ts").cast("date")))
            .distinct()
        )
        return materialize(days.select("d", F.when(F.weekday("d") >= 5, 1).otherwise(0).alias("is_holiday")), "calendar")

    # ------------------------------------------------------------ requests

    @cached_property
    def turn(self) -> DataFrame:
        return self.turn_rows(self.table("conversations"))

    @staticmethod
    def turn_rows(conversations: DataFrame) -> DataFrame:
        c, t = F.col("conv_id"), F.col("turn")
        page = int_div(t, PAGE_TURNS)
        req = F.lit(1_700_000_000_000) + c * 60_000 + page * 1000
        return conversations.select(
            "conv_id",
            "turn",
            "role",
            F.length("text").alias("n"),
            (c * 7 + t).alias("x"),
            F.concat(F.lpad(c.cast("string"), 10, "0"), F.lit("_"), F.lpad(page.cast("string"), 4, "0")).alias(
                "rowkey"
            ),
            F.concat(F.lit("V00"), t.cast("string")).alias("news_id"),
            req.alias("req"),
        )

    @cached_property
    def wide(self) -> DataFrame:
        """Wide request rows: one per page of turns, each turn an item with its cells"""
        item, x = F.col("news_id"), F.col("x")

        def entry(prefix: str, value: Column, when: Column | None = None) -> Column:
            e = F.struct(F.concat(F.lit(prefix), item).alias("key"), value.alias("value"))
            return e if when is None else F.when(when, e)

        text = F.concat
        stored = text(
            F.lit('{"len":"'), F.col("n").cast("string"), F.lit('","role":"'), "role", F.lit('","title":"t'),
            F.col("turn").cast("string"), F.lit('"}'),
        )
        fresh = text(F.lit('{"len":"'), (F.col("n") + 1).cast("string"), F.lit('","role":"","extra":"e"}'))
        biz = F.when(F.col("conv_id") % 4 == 0, "OTHER").otherwise("RECOMMEND")
        result = text(
            F.lit('{"pctr":"0.'), (x % 10).cast("string"), F.lit('","recall_type":"'), (20 + x % 10).cast("string"),
            F.lit('|3","bizType":"'), biz, F.lit('"}'),
        )
        cells = F.array(
            entry("itemFeature_", F.when(x % 17 == 0, "broken").otherwise(stored)),
            entry("reflux_itemFeature_", fresh, x % 2 == 0),
            entry("recommend_result_", result, x % 3 != 0),
            entry("duration_", (F.col("n") * 10).cast("string"), x % 4 == 1),
            entry("clk_", F.lit("1.0"), F.col("role") == "user"),
            entry("feedback_negative:", F.lit("1"), x % 5 == 0),
            entry("feedback_like:", F.lit("1"), F.col("turn") % 3 == 0),
            entry("feedback_comment:", F.lit("1"), x % 7 == 0),
            entry("feedback_collect:", F.lit("1"), x % 4 == 0),
            entry("feedback_share:", F.lit("1"), x % 6 == 0),
        )
        present = F.filter(cells, lambda e: e.isNotNull())
        pages = self.turn.groupBy("rowkey", "conv_id", "req").agg(F.flatten(F.collect_list(present)).alias("e"))
        c, req = F.col("conv_id"), F.col("req")

        def fixed(name: str, value: Column, when: Column | None = None) -> Column:
            e = F.struct(F.lit(name).alias("key"), value.alias("value"))
            return e if when is None else F.when(when, e)

        user = text(F.lit('{"sex":"1","city":"'), (c % 50).cast("string"), F.lit('","age":"30"}'))
        own = F.array(
            fixed("token", text((req - 1000 * (c % 10)).cast("string"), c.cast("string"))),
            fixed("imei", text(F.lit("u"), c.cast("string"))),
            fixed("event_id", text(F.lit("e"), "rowkey")),
            fixed("req_timestamp", req.cast("string")),
            fixed("continuous_clicked", (c % 5).cast("string"), c % 2 == 0),
            fixed("userFeature", user),
            fixed("reluxFeature", F.lit('{"sex":"2","city":null,"rt":"x","other":"y"}'), c % 3 != 0),
        )
        own = F.filter(own, lambda e: e.isNotNull())
        return pages.select("rowkey", F.map_from_entries(F.concat("e", own)).alias("cells"))

    # ------------------------------------------------------------ training

    @cached_property
    def profile(self) -> DataFrame:
        """Per user: the latest CELL_ROWS events of each kind as lists, and the time of the last event"""
        rows = self.event.withColumn("x", behavior_json())
        latest = recall.latest_n(rows, ["user_id", "event_type"], [F.desc("t_ms"), F.desc("seq")], CELL_ROWS)

        def listed(kind: str, value: Column) -> Column:
            own = F.when(F.col("event_type") == kind, F.struct("seq", value.alias("x")))
            return F.transform(F.array_sort(F.collect_list(own)), lambda e: e["x"])

        k, t = F.col("k"), F.col("t_ms")
        timed = F.struct(t.alias("t"), news_id(k).alias("id"), (k % 5).cast("string").alias("cat"), read_text().alias("d"))
        return latest.groupBy("user_id").agg(
            F.max("t_ms").alias("last_ms"),
            *[listed(kind, F.col("x")).alias(f"b_{kind}") for kind in ("view", "click", "purchase")],
            *[listed(kind, timed).alias(f"l_{kind}") for kind in ("view", "click", "purchase")],
        )

    @cached_property
    def behaviours(self) -> DataFrame:
        """Whole histories, every event an entry of the behaviour cells that list it"""
        k, t = F.col("k"), F.col("t_ms")
        launcher = "user_smart_launcher_feed_news_{}_fc_{}"
        read = {
            "view": {"news_id": news_id(k), "news_top_category_v3": (k % 5).cast("string")},
            "click": {"news_id": news_id(k)},
            "purchase": {"read_duration": read_text()},
        }

        def entries(event_type: str, kind: str) -> Column:
            cells = [
                F.struct(F.lit(launcher.format(kind, part)).alias("cell"), t.alias("t"), value.alias("value"))
                for part, value in read[event_type].items()
            ]
            listed = F.struct(
                F.lit(f"user_sl_feed_news_{kind}_fc_v2").alias("cell"), t.alias("t"), behavior_json().alias("value")
            )
            return F.when(F.col("event_type") == event_type, F.array(listed, *cells))

        held = F.coalesce(*[entries(*names) for names in KINDS.items()])
        return self.spread_event.select(F.col("user_id").alias("request_id"), F.explode(held).alias("e")).select(
            "request_id", "e.*"
        )

    @cached_property
    def requests(self) -> DataFrame:
        """One request per user with the user's JSON cells"""
        u, token_ms = F.col("user_id"), F.col("last_ms") + 1000

        def timed(kind: str, part: str) -> Column:
            t1 = F.transform(f"l_{kind}", lambda e: e["t"])
            return F.to_json(F.struct(t1.alias("t1"), F.transform(f"l_{kind}", lambda e: e[part]).alias("t2")))

        cells = {
            "rowkey": F.concat(F.lit("r"), u),
            "event_id": F.concat(F.lit("e"), u),
            "token": F.concat(F.lpad(token_ms.cast("string"), 13, "0"), u),
            "user_imei": F.concat(F.lit("imei"), u),
            "event_time": (token_ms + 5000).cast("string"),
            "user_sex": F.when(u % 3 > 0, (u % 3).cast("string")),
            "user_sale_date": (token_ms - u * DAY_MS).cast("string"),
            "user_news_long_tag": F.concat(
                F.lit('{"'), u % 50, F.lit('":1.5,"'), u % 50 + 100, F.lit('":0.0,"7000":2}')
            ),
            "original_user_news_long_tag": F.concat(F.lit('{"tag'), u, F.lit('":0.5}')),
            "user_news_long_top_category_v3": F.concat(
                F.lit('{"size":24,"indices":['), u % 5, F.lit(",10],\"values\":[0.5,0.25]}")
            ),
            "user_sl_feed_news_show_fc_v2": F.to_json("b_view"),
            "user_sl_feed_news_click_fc_v2": F.to_json("b_click"),
            "user_sl_feed_news_duration_fc_v2": F.to_json("b_purchase"),
            "user_smart_launcher_feed_news_show_fc_news_id": timed("view", "id"),
            "user_smart_launcher_feed_news_click_fc_news_id": timed("click", "id"),
            "user_smart_launcher_feed_news_show_fc_news_top_category_v3": timed("view", "cat"),
            "user_smart_launcher_feed_news_duration_fc_read_duration": timed("purchase", "d"),
        }
        pairs = [x for name, value in cells.items() for x in (F.lit(name), value.cast("string"))]
        return self.profile.select(u.alias("request_id"), F.create_map(*pairs).alias("user"))

    @cached_property
    def request_items(self) -> DataFrame:
        """The shown items of each request with the item's JSON cells"""
        k = F.col("k")
        cells = {
            "newsId": news_id(k),
            "clicked": F.concat((k % 2).cast("string"), F.lit(".0")),
            "recall_type": F.concat(20 + k % 10, F.lit("|"), 20 + k % 7),
            "news_source": F.concat(F.lit("src"), k % 8),
            "duration": F.round(F.col("value") * 1000).cast("bigint"),
            "video_duration": k - 20,
            "news_publish_time": F.col("t_ms") - k * 1_800_000,
            "news_topcategory_v3": F.concat(
                F.lit('{"size":24,"indices":[10,'), k % 5, F.lit('],"values":[0.25,'), k % 2, F.lit("]}")
            ),
            "topic_vec_v2": F.concat(
                F.lit('{"size":2001,"indices":['), k % 7, F.lit(","), 12 + k % 3, F.lit('],"values":[0.5,0.5]}')
            ),
        }
        pairs = [x for name, value in cells.items() for x in (F.lit(name), value.cast("string"))]
        return self.spread_event.filter(F.col("event_type") == "view").select(
            F.col("seq").alias("sample_id"), F.col("user_id").alias("request_id"), F.create_map(*pairs).alias("item")
        )

    @cached_property
    def training_dictionary(self) -> DataFrame:
        k = F.col("k")
        texts = {
            "news_category_v3": F.concat(F.lit("c"), k % 15),
            "recall_type": F.concat(F.lit("2"), k % 8),
            "news_source": F.concat(F.lit("src"), k % 6),
        }
        entry = [F.struct(F.lit(f).alias("feature"), t.alias("text")) for f, t in texts.items()]
        rows = self.event.select(F.explode(F.array(*entry)).alias("e")).select("e.*")
        return materialize(lookups.build_dictionary(rows), "dictionary")

    # ------------------------------------------------------------ CDC, keyed

    @cached_property
    def cdc(self) -> DataFrame:
        return self.spread_table("orders").select(F.col("o_orderkey").alias("seq"), cdc_json().alias("value"))

    @cached_property
    def cdc_turn(self) -> DataFrame:
        """CDC messages of the request time, for sinks that bucket by time"""
        return self.turn.select(cdc_turn_json().alias("value"))

    @cached_property
    def kv(self) -> DataFrame:
        return self.table("customer").select(
            F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("rowkey"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("bal"),
        )


# ---------------------------------------------------------------- expressions shared with the streams


def news_id(k: Column) -> Column:
    return F.concat(F.when(k % 11 == 0, "V06").otherwise("V00"), k.cast("string"))


def item_tokens(k: Column) -> Column:
    """Three tokens of an item in separate ranges"""
    return F.array(k % 5, 5 + k % 20, 25 + k % 100)


def action_json() -> Column:
    click = F.when(F.col("event_type") == "click", "1").otherwise("0")
    show = F.when(F.col("event_type") == "view", "1").otherwise("0")
    return F.concat(
        F.lit('{"name":"'), F.col("user_id").cast("string"), F.lit('","news_id":"'), F.col("k").cast("string"),
        F.lit('","click":"'), click, F.lit('","show":"'), show, F.lit('"}'),
    )


def wordtime_text() -> Column:
    back = F.when(F.col("seq") % 7 == 0, 36_000_000_000).otherwise(0)
    return F.concat(F.col("user_id").cast("string"), F.lit(","), (F.col("t_us") - back).cast("string"))


def read_text() -> Column:
    """Read durations as bare numbers and as JSON"""
    ms = F.round(F.col("value") * 1000).cast("bigint").cast("string")
    return F.when(F.col("k") % 2 == 0, ms).otherwise(F.concat(F.lit('{"duration":"'), ms, F.lit('"}')))


def behavior_json() -> Column:
    k = F.col("k")

    def weights(prefix: str) -> Column:
        def one(key: Column, w: Column) -> Column:
            return F.concat(F.lit(f'"{prefix}'), key.cast("string"), F.lit('":'), w.cast("string"))

        return F.concat(
            F.lit("{"), one(k % 7, k % 4), F.lit(","), one(7 + k % 5, (k % 3) + F.lit(0.5)), F.lit(","),
            one(12 + k % 3, F.lit(1)), F.lit("}"),
        )

    read = F.when(k % 6 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"read_duration":"'), (k * 100).cast("string"), F.lit('"'))
    )
    full = F.concat(
        F.lit('{"event_time":"'), F.col("t_ms").cast("string"), F.lit('","news_id":"'), news_id(k), F.lit('"'), read,
        F.lit(',"news_topic_vec_v2":'), weights(""), F.lit(',"news_content_tag_vec_v2":'), weights("tag"),
        F.lit(',"news_category_v3":'), weights("c"), F.lit("}"),
    )
    return F.when(k % 19 == 0, F.lit("")).otherwise(full)


def cdc_json() -> Column:
    action = (
        F.when(F.col("o_orderstatus") == "F", "INSERT").when(F.col("o_orderstatus") == "O", "UPDATE").otherwise("DELETE")
    )
    ms = epoch_ms(F.col("o_orderdate")).cast("string")
    key = F.col("o_orderkey").cast("string")
    row = F.concat(
        F.lit('{"id":"'), key, F.lit('","cust":"'), F.col("o_custkey").cast("string"), F.lit('","priority":"'),
        "o_orderpriority", F.lit('"}'),
    )
    return F.concat(
        F.lit('{"type":"'), action, F.lit('","database":"shop","table":"orders","ts":'), ms, F.lit(',"es":'), ms,
        F.lit(',"id":'), key, F.lit(',"isDdl":false,"pkNames":["id"],"sql":"","data":['), row, F.lit("]}"),
    )


def cdc_turn_json() -> Column:
    action = F.when(F.col("role") == "user", "INSERT").otherwise("UPDATE")
    row = F.concat(
        F.lit('{"id":"'), F.col("rowkey"), F.lit("-"), F.col("turn").cast("string"), F.lit('","role":"'), "role",
        F.lit('"}'),
    )
    return F.concat(
        F.lit('{"type":"'), action, F.lit('","database":"chat","table":"turns","ts":'), F.col("req").cast("string"),
        F.lit(',"data":['), row, F.lit("]}"),
    )
