"""Whole training rows: every feature of a (user, item) sample as an array column.

Three stages, so that nothing is done twice and no stage carries more than it needs:

1. per request: the user's JSON is parsed once, behaviour lists included, and its dictionary keys are coded
   by one join for all lists;
2. per sample: the item's JSON;
3. per (request, item): features of both sides, from the compact arrays of the first two stages. Padding,
   which multiplies the size of a row, comes last; what is padded is ready after the first stage.

Features of one kind are computed by one expression over the array of their keys, and a column picks its
place in the result. So the plan has a few dozen expressions instead of 735, and a stage holds only the keys
that the asked columns need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, scalars, sequences, vectors
from ..functions.binding import let
from ..plans import catalog as k
from ..session import materialize
from . import lookups
from .history import HORIZONS, horizon_sums
from .skew import skew_join

VECTOR = "struct<size:int,indices:array<int>,values:array<float>>"
READ_DURATION = k.NO_LENGTH
# durations are summed as integers, in parts of a ms
PARTS = 1000
SUMS = "array<struct<place:int,x:string,v:array<double>>>"
COUNTS = "array<struct<place:int,i:int,v:double>>"


def _float(pairs: Column) -> Column:
    """Vector cells are single precision, whatever they are computed from"""
    return F.transform(pairs, lambda e: F.struct(e["i"].alias("i"), e["v"].cast("float").cast("double").alias("v")))


class Family:
    """Features of one kind: entries (tuples of literals) and what to compute from one of them"""

    def __init__(self, column: str, fields: Sequence[str], compute: Callable[[Column], Column]):
        self.column, self.fields, self.compute = column, fields, compute
        self.entries: dict[tuple, int] = {}

    def pick(self, *entry: object) -> Column:
        """The feature of ``entry``, which is asked for hereby"""
        return F.get(F.col(self.column), F.lit(self.entries.setdefault(entry, len(self.entries))))

    def build(self) -> Column:
        structs = [
            F.struct(*[F.lit(x).alias(f) for f, x in zip(self.fields, entry)]) for entry in self.entries
        ]
        return F.transform(F.array(*structs), self.compute).alias(self.column)


class Side:
    """The features that need one JSON map only"""

    def __init__(self, prefix: str, column: str):
        cells = F.col(column)

        def text(e: Column) -> Column:
            return F.try_element_at(cells, e["key"])

        def number(e: Column) -> Column:
            return text(e).try_cast("double")

        def vector(e: Column) -> Column:
            return let(
                F.from_json(text(e), VECTOR),
                lambda x: _float(vectors.sparse_export(x["indices"], x["values"], e["default"])),
            )

        def argmax(e: Column) -> Column:
            return let(F.from_json(text(e), VECTOR), lambda x: vectors.argmax_index(x["indices"], x["values"]))

        def dense(e: Column) -> Column:
            return F.coalesce(let(F.from_json(text(e), VECTOR), _dense_cells), F.array().cast("array<double>"))

        def int_tags(e: Column) -> Column:
            return _export(_float(vectors.tag_hash_sum(scalars.json_int_map(text(e)), lambda t: t)))

        def text_tags(e: Column) -> Column:
            tags = scalars.json_string_map(text(e))
            return _export(
                _float(
                    vectors.tag_hash_sum(tags, lambda t: hashing.bucket_abs_of_mod(hashing.java_hash(t), e["buckets"]))
                )
            )

        def rt_tags(e: Column) -> Column:
            return _float(vectors.map_to_sparse(scalars.json_int_map(text(e)), k.TAG_SIZE))

        kinds = {
            "text": (("key",), text),
            "int": (("key",), lambda e: scalars.lenient_int(text(e))),
            "nullable_int": (("key",), lambda e: number(e).try_cast("int")),
            "double": (("key",), lambda e: scalars.lenient_double(text(e))),
            "nullable_double": (("key",), number),
            "guarded": (("key",), lambda e: scalars.guarded_double(text(e))),
            "seconds": (("key",), lambda e: scalars.seconds2(number(e))),
            "vector": (("key", "default"), vector),
            "argmax": (("key",), argmax),
            "dense": (("key",), dense),
            "int_tags": (("key",), int_tags),
            "text_tags": (("key", "buckets"), text_tags),
            "rt_tags": (("key",), rt_tags),
            "launcher": (("key",), lambda e: sequences.tuple_sequence(text(e))),
        }
        self.families = {name: Family(f"{prefix}_{name}", *spec) for name, spec in kinds.items()}
        self.cell = lambda key: F.try_element_at(cells, F.lit(key))

    def __getattr__(self, name: str) -> Callable[..., Column]:
        if name in self.__dict__.get("families", {}):
            return self.families[name].pick
        raise AttributeError(name)

    def columns(self) -> list[Column]:
        return [f.build() for f in self.families.values() if f.entries]


def _dense_cells(x: Column) -> Column:
    given = F.transform(x["values"], lambda v: v.cast("double"))
    n = F.coalesce(x["size"], F.size(x["values"]))
    placed = let(
        F.map_from_arrays(x["indices"], given),
        lambda m: F.transform(
            F.sequence(F.lit(0), n - F.lit(1)), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0))
        ),
    )
    return F.when(F.coalesce(F.size(x["indices"]), F.lit(0)) == 0, given).otherwise(placed)


def _export(pairs: Column) -> Column:
    return let(pairs, lambda p: vectors.sparse_export(vectors.indices_of(p), vectors.values_of(p)))


# ---------------------------------------------------------------- behaviour lists


def _launcher_key(kind: str, part: str) -> str:
    return f"user_smart_launcher_feed_news_{kind}_fc_news_{part}"


def _list_key(kind: str) -> str:
    return f"user_sl_feed_news_{kind}_fc_v2"


def _parse_lists(requests: DataFrame) -> DataFrame:
    """``lists``: the entries of the three behaviour lists, each parsed once"""
    keys = F.array(*[F.lit(_list_key(kind)) for kind in k.SL2_KINDS])

    def entries(key: Column) -> Column:
        return sequences.behavior_entries(F.from_json(F.try_element_at("user", key), "array<string>"))

    return requests.withColumn("lists", F.transform(keys, entries))


def _list_arrays() -> Column:
    """``b``: per behaviour list its times, ids, durations and tokens as parallel arrays"""

    def read(m: Column, name: str) -> Column:
        return F.try_element_at(m, F.lit(name))

    def tokens(m: Column, name: str) -> Column:
        return F.transform(F.split(sequences.entry_value(m, name, k.TOP), "#"), lambda x: x.try_cast("int"))

    def one(m: Column) -> Column:
        return F.struct(
            F.coalesce(read(m, "event_time").try_cast("bigint"), F.lit(None)).alias("t"),
            read(m, "news_id").alias("id"),
            F.coalesce(read(m, "read_duration").try_cast("double"), F.lit(0.0)).alias("d"),
            *[tokens(m, name).alias(part) for part, name in k.SL2_TOKENS.items()],
        )

    return F.transform("lists", lambda entries: F.transform(entries, one))


def _heaviest(raw: Column) -> Column:
    """The heaviest key of a JSON map"""
    weights = F.transform_values(
        F.coalesce(F.from_json(raw, "map<string,string>"), F.create_map().cast("map<string,string>")),
        lambda _, w: F.coalesce(w.try_cast("double"), F.lit(0.0)),
    )
    return F.get(sequences.topn_entries(weights, 1), F.lit(0))


def _code_lists(parsed: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(request_id, codes_<kind>_<part>): one int array per list and dictionary field, in list order.

    The heaviest key of every entry and field goes out as a row, all of them meet the dictionary in one
    join, and the codes come back by position. An entry without the field is coded 0.
    """
    keys = [
        F.struct(F.lit(part).alias("part"), F.lit(field).alias("feature")) for part, field in k.SL2_DICTIONARY.items()
    ]
    entries = parsed.select("request_id", F.posexplode("lists").alias("kind", "entries")).select(
        "request_id", "kind", F.posexplode("entries").alias("pos", "m")
    )
    fields = entries.select("request_id", "kind", "pos", "m", F.explode(F.array(*keys)).alias("f")).select(
        "request_id", "kind", "pos", "f.part", "f.feature", F.try_element_at("m", F.col("f.feature")).alias("raw")
    )
    keyed = fields.select("request_id", "kind", "pos", "part", "feature", _heaviest(F.col("raw")).alias("text"))
    codes = dictionary.select("feature", "text", "code")
    coded = lookups.lookup_join(keyed, codes, ["feature", "text"], "left", spread=["request_id", "kind", "pos"])

    def in_order(kind: int, part: str) -> Column:
        # a profile keeps a bounded number of entries, so this list is short
        own = F.when(
            (F.col("kind") == kind) & (F.col("part") == part),
            F.struct("pos", F.coalesce("code", F.lit(0)).alias("code")),
        )
        return F.array_sort(F.collect_list(own)).getField("code")

    return coded.groupBy("request_id").agg(
        *[in_order(n, part).alias(_code_column(kind, part)) for n, kind in enumerate(k.SL2_KINDS) for part in k.SL2_DICTIONARY]
    )


def _code_column(kind: str, part: str) -> str:
    return f"codes_{kind}_{part}"


def _behaviour(kind: str, field: str) -> Column:
    return F.get(F.col("b"), F.lit(k.SL2_KINDS.index(kind))).getField(field)


# ---------------------------------------------------------------- one training row


class Plan:
    """Collects what the asked columns need from each stage"""

    def __init__(self, names: Sequence[str]):
        self.user, self.item = Side("u", "user"), Side("i", "item")
        self.user_scalars: dict[str, Column] = {}
        self.item_scalars: dict[str, Column] = {}
        self.sequences: dict[str, Column] = {}
        self.needs: set[str] = set()
        self.histories: dict[tuple[str, str], int] = {}
        self.values: dict[tuple[str, str], int] = {}
        self.tokens: dict[tuple[str, str], int] = {}
        kinds = k.columns()
        unknown = [n for n in names if n not in kinds]
        if unknown:
            raise KeyError(f"unknown training columns {unknown}")
        makers = self._makers()
        self.final = {n: makers[n]().cast(f"array<{kinds[n]}>") for n in names}

    # -- stage access

    def _user(self, name: str, value: Column) -> Column:
        self.user_scalars[name] = value
        return F.col(name)

    def _item(self, name: str, value: Column) -> Column:
        self.item_scalars[name] = value
        return F.col(name)

    def _held(self, name: str, value: Column) -> Column:
        """A sequence as the user stage leaves it, made once a request"""
        self.sequences[f"q_{name}"] = value
        return F.col(f"q_{name}")

    def _req_ms(self) -> Column:
        return self._user("req_ms", scalars.token_ms(self.user.cell("token")))

    def _event_ms(self) -> Column:
        return self._user("event_ms", self.user.cell("event_time").try_cast("bigint"))

    def _behaviour(self, kind: str, field: str) -> Column:
        self.needs.add("lists")
        return _behaviour(kind, field)

    def _codes(self, kind: str, part: str) -> Column:
        self.needs |= {"lists", "codes"}
        return F.coalesce(F.col(_code_column(kind, part)), F.array().cast("array<int>"))

    def _launcher(self, kind: str, part: str) -> Column:
        return self.user.launcher(_launcher_key(kind, part))

    def _launcher_ints(self, kind: str, part: str) -> Column:
        values = self._launcher(kind, part).getField("v")
        if part in k.LAUNCHER_TOKENS:
            return sequences.flatten_tokens(values, k.TOKEN_LENGTH)
        return F.coalesce(values.try_cast("array<int>"), values.cast("array<string>").try_cast("array<int>"))

    # -- column makers

    def _makers(self) -> dict[str, Callable[[], Column]]:
        u, i, one = self.user, self.item, F.array
        out: dict[str, Callable[[], Column]] = {}

        def family(names: Sequence[str] | dict[str, str], pick: Callable[..., Column], whole: bool = False) -> None:
            keyed = names if isinstance(names, dict) else {n: n for n in names}
            for n, key in keyed.items():
                out[n] = (lambda key=key: pick(key)) if whole else (lambda key=key: one(pick(key)))

        family(k.USER_INTS, u.int)
        family(k.USER_NULLABLE_INTS, u.nullable_int)
        family(k.USER_DOUBLES, u.double)
        family(k.USER_NULLABLE_DOUBLES, u.nullable_double)
        family(k.USER_SECONDS, u.seconds)
        family(k.USER_DENSE, u.dense, whole=True)
        family(k.ITEM_INTS, i.int)
        family(k.ITEM_NULLABLE_INTS, i.nullable_int)
        family(k.ITEM_DOUBLES, i.double)
        family(k.ITEM_GUARDED, i.guarded)
        family(k.ITEM_NULLABLE_DOUBLES, i.nullable_double)
        family(k.ITEM_SECONDS, i.seconds)
        family(k.ITEM_DENSE, i.dense, whole=True)
        family(("rowkey", "event_id", "token", "user_imei"), u.text)
        family({"news_id": "newsId", "news_source": "news_source"}, i.text)
        family(("news_source_level1", "news_source_level2"), i.int)
        family({f"news_{n}category_v3_update": f"{n}_category_v3_update" for n in ("top", "sub", "third")}, i.argmax)
        family(("news_topcategory_v3", "news_subcategory_v3"), i.argmax)
        for name, pairs in self._pair_makers().items():
            indices, values = k.pair_columns(name)
            out[indices] = lambda p=pairs: vectors.indices_of(p())
            out[values] = lambda p=pairs: vectors.values_of(p())
        for s in k.SURFACES:
            show, click = f"user_{s}_show_cnt_30d", f"user_{s}_click_cnt_30d"
            out[f"user_{s}_ctr_30d"] = lambda a=show, b=click: one(scalars.ctr(u.nullable_double(a), u.nullable_double(b)))
        for name, (a, b) in k.COSINES.items():
            out[name] = lambda a=a, b=b: one(self._cosine(a, b))
        out |= {n: lambda m=m: one(m()) for n, m in self._scalar_makers().items()}
        out["recall_type"] = lambda: self._coded("recall_type")
        out |= self._sequence_makers() | self._frequency_makers()
        return out

    def _scalar_makers(self) -> dict[str, Callable[[], Column]]:
        u, i = self.user, self.item
        imei, news_id = u.cell("user_imei"), i.cell("newsId")
        event_ms = u.cell("event_time").try_cast("bigint")
        sale = scalars.lenient_long(u.cell("user_sale_date"))
        read = F.coalesce(i.cell("duration").try_cast("double"), F.lit(0.0))
        video = F.coalesce(i.cell("video_duration").try_cast("double"), F.lit(0.0))
        hash_user, hash_item = hashing.java_hash(imei), hashing.java_hash(news_id)
        user = {
            "experiment_rank_layer": lambda: hashing.experiment_bucket(imei, 100, k.EXPERIMENT_SALT),
            "group_id": lambda: hashing.experiment_bucket(imei, 10_000),
            "user_imei_hash": lambda: hash_user,
            "user_imei_hash_mod": lambda: hashing.bucket_abs_of_mod(hash_user, 10_000_000),
            "user_sale_month": lambda: scalars.device_age_months(event_ms, sale),
            "news_show_time": lambda: event_ms.cast("string"),
            "news_show_hour": lambda: scalars.hour_of(event_ms, "Asia/Shanghai"),
            "news_show_week_of_day": lambda: scalars.weekday_of(event_ms, "Asia/Shanghai"),
        }
        item = {
            "news_id_hash": lambda: hash_item,
            "news_id_hash_mod": lambda: hashing.bucket_signed(hash_item, 1_000_000),
            "clicked": lambda: i.cell("clicked").try_cast("double").try_cast("int"),
            "news_position": lambda: scalars.safe_int(i.cell("news_position")),
            "video_duration": lambda: scalars.clean_video(video),
            "read_duration": lambda: scalars.clean_read_seconds(read),
            "pcr": lambda: scalars.completion_rate(read, video),
        }
        out = {n: lambda n=n, m=m: self._user(n, m()) for n, m in user.items()}
        out |= {n: lambda n=n, m=m: self._item(n, m()) for n, m in item.items()}
        out |= {n: lambda n=n: self._coded(n) for n in ("news_show_is_holiday", "source_pkg_name_code", "news_source_encode")}
        published = scalars.lenient_long(i.cell("news_publish_time"))
        out["news_show_hour_duration"] = lambda: scalars.item_age_hours(
            self._event_ms(), self._item("publish_ms", published)
        )
        for h in HORIZONS:
            out[f"sb_user_{h}_read_duration"] = lambda h=h: scalars.seconds2(self._read_total(h))
        return out

    def _coded(self, name: str) -> Column:
        """A column that a lookup join of its side computes"""
        self.needs.add(name)
        return F.col(name)

    def _reads(self) -> Column:
        self.user.launcher(READ_DURATION)
        self.needs.add("reads")
        return F.col("reads")

    def _read_total(self, horizon: str) -> Column:
        self._event_ms()
        self.needs.add("read_totals")
        return F.coalesce(F.col(f"{horizon}_read"), F.lit(0)) / F.lit(PARTS)

    def _pair_makers(self) -> dict[str, Callable[[], Column]]:
        u, i, topic = self.user, self.item, vectors.TOPIC_DEFAULT
        out: dict[str, Callable[[], Column]] = {n: lambda n=n: u.vector(n, 0) for n in k.USER_VECTORS}
        out["appsDurationVector"] = lambda: u.vector("apps_duration", 0)
        out |= {n: lambda n=n: u.vector(n, topic) for n in k.USER_TOPICS}
        out |= {n: lambda key=key: u.int_tags(key) for n, key in k.USER_INT_TAGS.items()}
        out |= {n: lambda key=key, m=m: u.text_tags(key, m) for n, (key, m) in k.USER_TEXT_TAGS.items()}
        out |= {n: lambda n=n: u.rt_tags(n) for n in k.USER_RT_TAGS}
        out |= {n: lambda key=key: i.vector(key, 0) for n, key in k.ITEM_VECTORS.items()}
        out |= {n: lambda key=key: i.vector(key, topic) for n, key in k.ITEM_TOPICS.items()}
        out |= {n: lambda key=key: i.int_tags(key) for n, key in k.ITEM_INT_TAGS.items()}
        out |= {n: lambda key=key, m=m: i.text_tags(key, m) for n, (key, m) in k.ITEM_TEXT_TAGS.items()}
        out["user_app_use_bert_vec"] = lambda: F.transform(
            u.dense("user_app_use_bert_vec"), lambda x, n: F.struct(n.alias("i"), x.alias("v"))
        )
        for kind in k.LAUNCHER_KINDS:
            for field in k.HISTORY_VECTORS:
                out[k.history_name(kind, field)] = lambda kind=kind, f=field: self._history_pairs(kind, f)
        return out

    def _history_pairs(self, kind: str, field: str) -> Column:
        return F.get(F.col("histories"), F.lit(self.histories.setdefault((kind, field), len(self.histories))))

    def _cosine(self, user: str, item: str) -> Column:
        makers = self._pair_makers()
        a, b = makers[user](), makers[item]()
        return vectors.cosine_sparse(
            vectors.indices_of(a), vectors.values_of(a), vectors.indices_of(b), vectors.values_of(b)
        )

    def _sequence_makers(self) -> dict[str, Callable[[], Column]]:
        out: dict[str, Callable[[], Column]] = {}
        for name, (kind, length, fill) in k.padded().items():
            values = self._sequence(name)
            if length != k.TOKEN_LENGTH:
                values = lambda v=values, n=length: sequences.latest(v(), n)
            held = lambda v=values, name=name: self._held(name, v())
            out[name] = lambda v=held, n=length, f=fill, t=kind: sequences.pad(v(), n, F.lit(f).cast(t))
            if name != k.NO_LENGTH:
                out[f"{name}_length"] = lambda v=held: F.array(F.size(v()))
        return out

    def _sequence(self, name: str) -> Callable[[], Column]:
        if name == READ_DURATION:
            return lambda: F.transform(self._reads(), lambda e: scalars.seconds2(e["d"]))
        if name == "user_smart_launcher_feed_news_show_fc_action_flag":
            return lambda: sequences.click_in_show(
                self._launcher("show", "id").getField("v"), self._launcher("click", "id").getField("v")
            )
        for kind in k.SL2_KINDS:
            part = name.removeprefix(f"user_sl2_feed_news_{kind}_fc_news_")
            if part == "id":
                return lambda: F.transform(
                    self._behaviour(kind, "id"), lambda x: F.coalesce(hashing.java_hash(x), F.lit(0))
                )
            if part in k.SL2_TOKENS:
                return lambda: sequences.latest(F.flatten(self._behaviour(kind, part)), k.TOKEN_LENGTH)
            if part != name:
                return lambda: self._codes(kind, part)
        for kind in k.LAUNCHER_KINDS:
            part = name.removeprefix(f"user_smart_launcher_feed_news_{kind}_fc_news_")
            if part == "id_string":
                return lambda: self._launcher(kind, "id").getField("v")
            if part == "id":
                return lambda: F.transform(self._launcher(kind, "id").getField("v"), hashing.java_hash)
            if part != name:
                return lambda: self._launcher_ints(kind, part)
        raise KeyError(name)

    # -- frequency control

    def _frequency_makers(self) -> dict[str, Callable[[], Column]]:
        out: dict[str, Callable[[], Column]] = {}
        for fields, places, column in (
            (k.FREQUENCY_VALUES, self.values, "value_sums"),
            (k.FREQUENCY_TOKENS, self.tokens, "token_sums"),
        ):
            for field in fields:
                kinds = [("show", "s_times"), ("click", "c_times")]
                if k.is_nv(field):
                    kinds.append(("duration", "read_duration"))
                for kind, tail in kinds:
                    for n, h in enumerate(HORIZONS):
                        stem = f"sl_news_{field}_{h}_{tail}"

                        def at(f: str = field, kind: str = kind, n: int = n, places=places, column=column) -> Column:
                            if column == "value_sums":
                                self._own_value(f)  # asks for the stage columns
                            else:
                                self._own_tokens(f)
                            self._req_ms()
                            place = places.setdefault((f, kind), len(places))
                            return F.get(F.get(F.col(column), F.lit(place)), F.lit(n))

                        if fields is k.FREQUENCY_VALUES:
                            out[stem] = lambda at=at: F.array(at())
                        else:
                            out[f"{stem}_indices"] = lambda at=at: vectors.indices_of(at())
                            out[f"{stem}_values"] = lambda at=at: vectors.values_of(at())
        return out

    def _own_value(self, field: str) -> Column:
        item = k.FREQUENCY_VALUES[field][1]
        if item == "news_id":
            return self.item.text("newsId")
        return self.item.argmax(item.replace("category", "_category") if item.endswith("_update") else item).cast("int")

    def _own_tokens(self, field: str) -> Column:
        return F.array_distinct(vectors.indices_of(self._pair_makers()[k.FREQUENCY_TOKENS[field][1]]()))

    def places(self) -> list[tuple[str, str]]:
        """(field, list) of the asked frequency features: those of one value, then those of tokens"""
        return [*self.values, *self.tokens]

    def asked(self) -> Column:
        """The item's values and tokens at each place"""
        fields = [*[F.array(self._own_value(f).cast("string")) for f, _ in self.values]]
        fields += [self._own_tokens(f).cast("array<string>") for f, _ in self.tokens]
        return _at_places(dict(enumerate(fields)))


def _at_places(values: dict[int, Column]) -> Column:
    """array of (place, x), one for each element of the arrays in ``values``"""

    def placed(n: int, found: Column) -> Column:
        held = F.coalesce(found, F.array().cast("array<string>"))
        return F.transform(held, lambda x: F.struct(F.lit(n).alias("place"), x.alias("x")))

    each = [placed(n, found) for n, found in values.items()]
    return F.filter(F.concat(*each), lambda e: e["x"].isNotNull())


# ---------------------------------------------------------------- whole histories


def cell_history(requests: DataFrame) -> DataFrame:
    """The behaviour cells of requests in the long form that ``assemble`` takes as ``history``"""

    def listed(key: str) -> Column:
        entries = F.coalesce(F.from_json(F.try_element_at("user", F.lit(key)), "array<string>"), F.array().cast("array<string>"))
        return F.transform(
            entries, lambda x: F.struct(F.lit(key).alias("cell"), F.lit(None).cast("bigint").alias("t"), x.alias("value"))
        )

    def timed(key: str) -> Column:
        entries = sequences.tuple_sequence(F.try_element_at("user", F.lit(key)))
        return F.transform(entries, lambda e: F.struct(F.lit(key).alias("cell"), e["t"].alias("t"), e["v"].alias("value")))

    parts = ("id", *k.LAUNCHER_VALUES, *k.LAUNCHER_TOKENS)
    keys = [_launcher_key(kind, part) for kind in k.LAUNCHER_KINDS for part in parts]
    cells = [listed(_list_key(kind)) for kind in k.SL2_KINDS] + [timed(key) for key in (*keys, READ_DURATION)]
    return requests.select("request_id", F.explode(F.concat(*cells)).alias("e")).select("request_id", "e.*")


def _parts(amount: Column) -> Column:
    return F.round(amount * F.lit(PARTS)).cast("bigint")


def _facts(plan: Plan, history: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(request_id, place, x, t, n): what every history row adds to the places that read its cell"""
    places = plan.places()
    found = []

    def at(kind: str, wanted: Callable[[str], bool]) -> dict[int, str]:
        """place -> history part, of the frequency fields that read a list of this kind"""
        parts = k.FREQUENCY_VALUES | k.FREQUENCY_TOKENS
        return {n: parts[f][0] for n, (f, on) in enumerate(places) if on == kind and wanted(f)}

    for kind in k.SL2_KINDS:
        parts = at(kind, k.is_nv)
        if not parts:
            continue
        own = history.filter(F.col("cell") == _list_key(kind))
        entries = own.select("request_id", F.explode(sequences.behavior_entries(F.array("value"))).alias("m"))
        read = F.coalesce(F.try_element_at("m", F.lit("read_duration")).try_cast("double"), F.lit(0.0))
        timed = entries.select(
            "request_id",
            "m",
            F.try_element_at("m", F.lit("event_time")).try_cast("bigint").alias("t"),
            _parts(read if kind == "duration" else F.lit(1)).alias("n"),
        ).filter(F.col("t").isNotNull())
        direct: dict[int, Column] = {}
        for n, part in parts.items():
            if part == "id":
                direct[n] = F.array(F.try_element_at("m", F.lit("news_id")))
            elif part in k.SL2_TOKENS:
                tokens = F.split(sequences.entry_value(F.col("m"), k.SL2_TOKENS[part], k.TOP), "#")
                direct[n] = F.transform(tokens, lambda x: x.try_cast("int").cast("string"))
        if direct:
            found.append(timed.select("request_id", "t", "n", F.explode(_at_places(direct)).alias("e")))
        coded = {n: part for n, part in parts.items() if part in k.SL2_DICTIONARY}
        if coded:
            keys = [F.struct(F.lit(n).alias("place"), F.lit(k.SL2_DICTIONARY[part]).alias("feature")) for n, part in coded.items()]
            fields = timed.select("request_id", "t", "n", "m", F.explode(F.array(*keys)).alias("f"))
            keyed = fields.select(
                "request_id", "t", "n", "f.place", "f.feature", _heaviest(F.try_element_at("m", F.col("f.feature"))).alias("text")
            )
            codes = dictionary.select("feature", "text", "code")
            met = lookups.lookup_join(keyed, codes, ["feature", "text"], "left", spread=["request_id", "place", "t"])
            x = F.coalesce("code", F.lit(0)).cast("string").alias("x")
            found.append(met.select("request_id", "t", "n", F.struct("place", x).alias("e")))
    for kind in k.LAUNCHER_KINDS:
        for n, part in at(kind, lambda f: not k.is_nv(f)).items():
            own = history.filter((F.col("cell") == _launcher_key(kind, part)) & F.col("t").isNotNull())
            x = F.array("value")
            if part in k.LAUNCHER_TOKENS:
                x = F.transform(F.split("value", "#"), lambda v: v.try_cast("int").cast("string"))
            one = F.lit(PARTS).cast("bigint").alias("n")
            found.append(own.select("request_id", "t", one, F.explode(_at_places({n: x})).alias("e")))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.select("request_id", "e.place", "e.x", "t", "n")


def _asked_once(requests: DataFrame, at: Column) -> bool:
    """Whether no request comes with two times"""
    times = requests.groupBy("request_id").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    return times.filter(F.col("first") != F.col("last")).isEmpty()


def _frequencies(
    plan: Plan, requests: DataFrame, own: DataFrame, asked: Column, dictionary: DataFrame, history: DataFrame
) -> DataFrame:
    """sample_id and ``_all``: place, x and the sums over each horizon before the request, where one is not 0"""
    at = plan.user_scalars["req_ms"]
    times = requests.select("request_id", at.alias("at")).filter(F.col("at").isNotNull())
    wanted = own.select("sample_id", "request_id", F.explode(asked).alias("e"))
    wanted = skew_join(
        wanted.select("sample_id", "request_id", "e.*"), times, "request_id", "inner", spread=["sample_id"], count_from=own
    )
    # both sides are read several times, so they are written once; so is the result, which keeps the plan small
    facts = materialize(_facts(plan, history, dictionary), "facts")
    sums = horizon_sums(
        materialize(wanted, "asked"), facts, ["request_id", "place", "x"], "at", "t", ["n"], once=_asked_once(requests, at)
    )
    sums = sums.filter(reduce(or_, [F.col(f"{h}_n") != 0 for h in HORIZONS]))
    totals = F.array(*[F.col(f"{h}_n") / F.lit(PARTS) for h in HORIZONS]).alias("v")
    # an item has few values and tokens, so a sample's list is short
    lists = sums.groupBy("sample_id").agg(F.collect_list(F.struct("place", "x", totals)).alias("_all"))
    return materialize(lists, "frequencies")


def _value_sums(plan: Plan) -> Column:
    def one(n: Column) -> Column:
        own = F.get(F.filter("_all", lambda e: e["place"] == n), F.lit(0))
        return F.coalesce(own["v"], F.array_repeat(F.lit(0.0), len(HORIZONS)))

    return F.transform(F.array(*[F.lit(n) for n in range(len(plan.values))]), one).alias("value_sums")


def _token_sums(plan: Plan) -> Column:
    first = len(plan.values)
    spots = [
        F.struct(F.lit(n).alias("place"), F.lit(k.FREQUENCY_TOKENS[f][2]).alias("size"))
        for n, (f, _) in enumerate(plan.tokens, first)
    ]

    def pairs(s: Column) -> Column:
        def per_horizon(own: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.lit(len(HORIZONS) - 1)),
                lambda h: _float(
                    vectors.sparse_or_default(
                        F.transform(own, lambda e: F.struct(e["x"].cast("int").alias("i"), F.get(e["v"], h).alias("v"))),
                        s["size"],
                    )
                ),
            )

        held = F.coalesce(F.filter("_all", lambda e: e["place"] == s["place"]), F.array().cast(SUMS))
        return let(held, per_horizon)

    return F.transform(F.array(*spots), pairs).alias("token_sums")


def _history_counts(plan: Plan, history: DataFrame) -> DataFrame:
    """request_id and ``counts``: occurrences per value of the launcher cells, over whole histories"""
    found = None
    for n, (kind, field) in enumerate(plan.histories):
        _, size, drop = k.HISTORY_VECTORS[field]
        own = history.filter(F.col("cell") == _launcher_key(kind, field))
        x = F.col("value").try_cast("int")
        if field in k.LAUNCHER_TOKENS:
            x = F.explode(F.transform(F.split("value", "#"), lambda v: F.coalesce(v.try_cast("int"), F.lit(0))))
        rows = own.select("request_id", F.lit(n).alias("place"), x.alias("i")).filter(F.col("i") < size)
        rows = rows if drop is None else rows.filter(F.col("i") != drop)
        found = rows if found is None else found.unionByName(rows)
    counts = found.groupBy("request_id", "place", "i").agg(F.count(F.lit(1)).cast("double").alias("v"))
    # values are below the vector's size, so a list is at most as long
    return counts.groupBy("request_id").agg(F.collect_list(F.struct("place", "i", "v")).alias("counts"))


# ---------------------------------------------------------------- assembly


def _history_family(plan: Plan) -> Column:
    """Occurrences per value of the launcher lists"""
    inputs = []
    for n, (_, field) in enumerate(plan.histories):
        default = vectors.TOPIC_DEFAULT if field == "topic_top5" else 0
        size = k.HISTORY_VECTORS[field][1]
        inputs.append(F.struct(F.lit(n).alias("place"), F.lit(size).alias("size"), F.lit(default).alias("default")))

    def one(s: Column) -> Column:
        own = F.filter(F.coalesce("counts", F.array().cast(COUNTS)), lambda e: e["place"] == s["place"])
        pairs = F.transform(own, lambda e: F.struct(e["i"].alias("i"), e["v"].alias("v")))
        return vectors.sparse_or_default(pairs, s["size"], s["default"])

    return F.transform(F.array(*inputs), one).alias("histories")


def _user_stage(
    plan: Plan, requests: DataFrame, dictionary: DataFrame, calendar: DataFrame, history: DataFrame
) -> DataFrame:
    cell = plan.user.cell
    out = requests.select("request_id", "user")
    kept = ["request_id"]
    if "lists" in plan.needs:
        out = _parse_lists(out)
        if "codes" in plan.needs:
            codes = _code_lists(out, dictionary)
            kept += [x for x in codes.columns if x != "request_id"]
            out = out.join(codes, "request_id", "left")
        out = out.withColumn("b", _list_arrays()).drop("lists")
        kept.append("b")
    if "news_show_is_holiday" in plan.needs:
        day = scalars.ms_to_ntz(cell("event_time").try_cast("bigint"), "Asia/Shanghai").cast("date")
        out = lookups.holiday_lookup(out.withColumn("_day", day), calendar, "_day")
        out = out.withColumnRenamed("is_holiday", "news_show_is_holiday")
        kept.append("news_show_is_holiday")
    if "source_pkg_name_code" in plan.needs:
        named = out.withColumn("_pkg", cell("source_pkg_name"))
        out = lookups.dict_encode(named, dictionary, "source_pkg_name", "_pkg", "source_pkg_name_code")
        kept.append("source_pkg_name_code")
    out = out.select(*kept, *plan.user.columns(), *[c.alias(n) for n, c in plan.user_scalars.items()])
    if plan.histories:
        out = out.join(_history_counts(plan, history), "request_id", "left")
        out = out.select(*[c for c in out.columns if c != "counts"], _history_family(plan))
    if "read_totals" in plan.needs:
        own = history.filter((F.col("cell") == READ_DURATION) & F.col("t").isNotNull())
        read = _parts(F.coalesce(_read_ms(F.col("value")), F.lit(0.0))).alias("read")
        at = plan.user_scalars["event_ms"]
        moments = requests.select("request_id", at.alias("event_ms")).filter(F.col("event_ms").isNotNull())
        reads = own.select("request_id", "t", read)
        sums = horizon_sums(moments, reads, ["request_id"], "event_ms", "t", ["read"], once=_asked_once(requests, at))
        out = out.join(sums.drop("event_ms"), "request_id", "left")
    if "reads" in plan.needs:
        out = out.withColumn("reads", _read_entries(plan.user.launcher(READ_DURATION)))
    if plan.sequences:
        # only sequences read these
        spent = {"b", "reads", plan.user.families["launcher"].column}
        spent |= {_code_column(kind, part) for kind in k.SL2_KINDS for part in k.SL2_DICTIONARY}
        ready = [value.alias(name) for name, value in plan.sequences.items()]
        out = out.select(*[c for c in out.columns if c not in spent], *ready)
    return out


def _read_ms(value: Column) -> Column:
    return F.when(value.contains("{"), F.get_json_object(value, "$.duration")).otherwise(value).try_cast("double")


def _read_entries(entries: Column) -> Column:
    return F.transform(entries, lambda e: F.struct(e["t"].alias("t"), _read_ms(e["v"]).alias("d")))


def _item_stage(plan: Plan, items: DataFrame, dictionary: DataFrame) -> DataFrame:
    cell = plan.item.cell
    out = items.select("sample_id", "request_id", "item")
    kept = ["sample_id", "request_id"]
    if "recall_type" in plan.needs:
        pieces = out.select("sample_id", cell("recall_type").alias("text"))
        codes = lookups.multi_encode(pieces, dictionary, "recall_type", "text", "sample_id", "recall_type")
        out = out.join(codes, "sample_id", "left")
        kept.append("recall_type")
    if "news_source_encode" in plan.needs:
        named = out.withColumn("_source", cell("news_source"))
        out = lookups.dict_encode(named, dictionary, "news_source", "_source", "news_source_encode")
        kept.append("news_source_encode")
    return out.select(*kept, *plan.item.columns(), *[c.alias(n) for n, c in plan.item_scalars.items()])


def assemble(
    requests: DataFrame,
    items: DataFrame,
    dictionary: DataFrame,
    calendar: DataFrame | None,
    columns: Sequence[str] | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Training rows: ``sample_id`` and the asked columns, all of them by default.

    ``requests``: request_id, user map<string,string>; ``items``: sample_id, request_id, item
    map<string,string>; ``dictionary``: feature, text, code; ``calendar``: d, is_holiday, for the holiday
    column only; ``history``: request_id, cell, t, value, the entries of the behaviour cells as rows.

    Counts, read time and history vectors come from the whole of ``history``, by default the requests' own
    cells; the cells themselves are only read for the padded sequences, which are cut at their lengths.
    """
    plan = Plan(list(columns if columns is not None else k.columns()))
    if history is None and (plan.places() or plan.histories or "read_totals" in plan.needs):
        history = cell_history(requests)
    # built before the stages, because building them asks for stage columns
    asked = plan.asked() if plan.places() else None
    own = _item_stage(plan, items, dictionary)
    if asked is not None:
        own = materialize(own, "items")
        # the sums are joined while a row is the item's alone: users' arrays go through one shuffle only
        own = own.join(_frequencies(plan, requests, own, asked, dictionary, history), "sample_id", "left")
    users = _user_stage(plan, requests, dictionary, calendar, history)
    rows = skew_join(own, users, "request_id", "inner", spread=["sample_id"], count_from=items)
    if asked is not None:
        sums = [f(plan) for f, places in ((_value_sums, plan.values), (_token_sums, plan.tokens)) if places]
        rows = rows.select(*[c for c in rows.columns if c != "_all"], *sums)
    return rows.select("sample_id", *[c.alias(n) for n, c in plan.final.items()])
