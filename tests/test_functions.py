import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import hashing, scalars, sequences, vectors
from feedloom.plans import catalog

c = F.col


def one(spark, column, **values):
    """The value of an expression over one row of literals"""
    df = spark.range(1).select(*[F.lit(v).alias(n) if not hasattr(v, "alias") else v.alias(n) for n, v in values.items()])
    row = df.select(column.alias("x")).first()
    return row["x"]


# ---------------------------------------------------------------- hashes


@pytest.mark.parametrize(
    "text, h", [("abc", 96354), ("中国", 642672), ("", 0), ("V000005", 435911131), ("a😀b", 57849694), (None, None)]
)
def test_java_hash(spark, text, h):
    assert one(spark, hashing.java_hash(c("s")), s=F.lit(text).cast("string")) == h


@pytest.mark.parametrize(
    "text, h", [("", 0), ("abc", 0xB3DD93FA), ("hello", 0x248BFA47), ("test", 0xBA6BD213)]
)
def test_murmur3(spark, text, h):
    assert one(spark, hashing.murmur3_32(c("s")), s=text) & 0xFFFFFFFF == h


def test_buckets_of_smallest_int(spark):
    h = F.lit(-(2**31))
    assert one(spark, hashing.bucket_mod_of_abs(c("h"), 1_000_000), h=h) == 483648
    assert one(spark, hashing.bucket_abs_of_mod(c("h"), 1_000_000), h=h) == 483648
    assert one(spark, hashing.bucket_signed(c("h"), 1_000_000), h=h) == -483648


# ---------------------------------------------------------------- scalars


@pytest.mark.parametrize(
    "text, x",
    [(None, 0.0), ('{"compress":false}', 0.0), ("NaN", 0.0), ("Infinity", 0.0), ("-Infinity", 0.0), ("0.25", 0.25)],
)
def test_guarded_double(spark, text, x):
    assert one(spark, scalars.guarded_double(c("s")), s=F.lit(text).cast("string")) == x


def test_string_to_array(spark):
    assert one(spark, scalars.string_to_array(c("s"), ","), s="V000005,,V000001,") == ["V000005", "V000001"]
    assert one(spark, scalars.string_to_array(c("s"), "[|]+"), s="a||b") == ["a", "b"]
    assert one(spark, scalars.string_to_array(c("s"), ","), s=F.lit(None).cast("string")) == []


def test_coding_map(spark):
    assert one(spark, scalars.coding_map(c("s")), s="1:2,3:4,1:9") == {1: 9.0, 3: 4.0}
    assert one(spark, scalars.coding_map(c("s")), s=" ") == {}
    assert one(spark, scalars.coding_map(c("s"), "hash"), s="abc:1") == {96354: 1.0}


def test_json_maps_default(spark):
    null = F.lit(None).cast("string")
    assert one(spark, scalars.json_int_map(c("s")), s=null) == {0: 0.0}
    assert one(spark, scalars.json_string_map(c("s")), s=null) == {"": 0.0}
    assert one(spark, scalars.json_string_map(c("s")), s='{"a":"x"}') == {"": 0.0}
    assert one(spark, scalars.json_int_map(c("s")), s='{"7":"1.5"}') == {7: 1.5}


def test_rounding_and_ages(spark):
    assert one(spark, scalars.duration_seconds(c("s")), s="8905") == 8.91
    assert one(spark, scalars.duration_seconds(c("s")), s='{"duration":"1500"}') == 1.5
    day = scalars.DAY_MS
    ages = [(30 * day - 1, 0.0), (30 * day, 1.0), (61 * 30 * day, 60.0), (-1, 0.0)]
    for gap, months in ages:
        assert one(spark, scalars.device_age_months(c("t"), F.lit(0)), t=F.lit(gap)) == months
    for hours, kept in [(-1, 0.0), (0, 0.0), (1, 1.0), (359, 359.0), (360, 0.0)]:
        assert one(spark, scalars.item_age_hours(c("t"), F.lit(0)), t=F.lit(hours * scalars.HOUR_MS)) == kept
    assert one(spark, scalars.completion_rate(c("r"), F.lit(0)), r=5000) == 0.0
    assert one(spark, scalars.completion_rate(c("r"), F.lit(2)), r=5000) == 1.0


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Shanghai", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, scalars.format_ms(c("t")), t=F.lit(1_704_164_640_000)) == "2024-01-02 03:04:00"
            assert one(spark, scalars.hour_of(c("t"), "Asia/Shanghai"), t=F.lit(1_704_164_640_000)) == 11
            assert one(spark, scalars.parse_minute(c("s")), s="2024-01-02 03 04") == 1_704_164_640_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_overlay(spark):
    a = F.create_map(*[F.lit(x) for x in ("k", "1", "z", "2")])
    b = F.create_map(F.lit("k"), F.lit(""), F.lit("z"), F.lit(None), F.lit("n"), F.lit("3"))
    keys = F.array(F.lit("k"), F.lit("z"), F.lit("n"))
    assert one(spark, scalars.overlay(a, b, keys)) == {"k": "", "z": "2", "n": "3"}
    assert one(spark, scalars.overlay(a, b, keys, need_text=True)) == {"k": "1", "z": "2", "n": "3"}
    assert one(spark, scalars.overlay(a, F.lit(None).cast("map<string,string>"), keys)) == {"k": "1", "z": "2"}


# ---------------------------------------------------------------- vectors


def arrays(indices, values):
    return {
        "i": F.lit(None).cast("array<int>") if indices is None else F.array(*map(F.lit, indices)).cast("array<int>"),
        "v": F.lit(None).cast("array<double>")
        if values is None
        else F.array(*map(F.lit, values)).cast("array<double>"),
    }


@pytest.mark.parametrize(
    "indices, values, default, out",
    [
        (None, None, 0, [(0, 0.0)]),
        (None, None, 2000, [(2000, 0.0)]),
        ([], [], 2000, [(2000, 0.0)]),
        ([1, 2], [0.0, 0.0], 2000, [(2000, 0.0)]),
        ([1, 5], [0.0, 2.0], 0, [(5, 2.0)]),
        ([1, 5], [1.0, 2.0], 0, [(1, 1.0), (5, 2.0)]),
        ([1], [1.0, 2.0], 2000, [(0, 0.0)]),
    ],
)
def test_sparse_export(spark, indices, values, default, out):
    got = one(spark, vectors.sparse_export(c("i"), c("v"), default), **arrays(indices, values))
    assert [tuple(x) for x in got] == out


def test_map_to_sparse_is_ascending(spark):
    m = F.create_map(*[F.lit(x) for pair in [(9, 1.0), (2, 3.0), (4, 0.0), (50, 1.0), (3, -1.0)] for x in pair])
    assert [tuple(x) for x in one(spark, vectors.map_to_sparse(m, 50))] == [(2, 3.0), (9, 1.0)]
    assert [tuple(x) for x in one(spark, vectors.map_to_sparse(m, 1))] == [(0, 0.0)]


def test_colliding_tags_are_summed(spark):
    m = F.create_map(*[F.lit(x) for pair in [("Aa", 1.0), ("BB", 2.0), ("c", 4.0)] for x in pair])
    got = one(spark, vectors.tag_hash_sum(m, lambda t: hashing.bucket_abs_of_mod(hashing.java_hash(t), 1000)))
    assert [tuple(x) for x in got] == [(99, 4.0), (112, 3.0)]


def test_vector_repair_and_argmax(spark):
    got = one(spark, vectors.vector_repair(c("i"), c("v")), **arrays([], [0.5, 0.25]))
    assert [tuple(x) for x in got] == [(0, 0.5), (1, 0.25)]
    assert [tuple(x) for x in one(spark, vectors.vector_repair(c("i"), c("v")), **arrays(None, None))] == [(0, 0.0)]
    assert one(spark, vectors.argmax_index(c("i"), c("v")), **arrays([7, 8, 9], [1.0, 3.0, 3.0])) == 8
    assert one(spark, vectors.argmax_index(c("i"), c("v")), **arrays([], [])) == 0


def test_cosine_of_nothing_is_zero(spark):
    a = arrays([1, 2], [3.0, 4.0])
    empty = F.array().cast("array<int>"), F.array().cast("array<double>")
    assert one(spark, vectors.cosine_sparse(c("i"), c("v"), *empty), **a) == 0.0
    assert one(spark, vectors.cosine_sparse(c("i"), c("v"), c("i"), c("v")), **a) == pytest.approx(1.0)


# ---------------------------------------------------------------- sequences


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_pad_gives_the_length(spark, n):
    got = one(spark, sequences.pad(c("a"), n, F.lit(9)), a=F.array(F.lit(1), F.lit(2)))
    assert got == ([1, 2] + [9] * n)[:n]


def test_topn_breaks_ties_by_key(spark):
    m = F.create_map(*[F.lit(x) for pair in [("b", 3.0), ("a", 1.0), ("c", 3.0)] for x in pair])
    assert one(spark, sequences.topn_tokens(m, 5, sequences.hash_code)) == "98#99#97#0#0"
    assert one(spark, sequences.topn_tokens(m, 1, sequences.hash_code)) == "98"


def test_behaviour_entries(spark):
    entries = F.array(
        F.lit(None).cast("string"), F.lit(""), F.lit("broken"),
        F.lit('{"event_time":"5","news_id":"V1","read_duration":"x","news_topic_vec_v2":{"4":1,"8":2}}'),
    )
    assert [tuple(x) for x in one(spark, sequences.parse_behavior_seq(entries, "news_id"))] == [(5, "V1")]
    assert [tuple(x) for x in one(spark, sequences.parse_behavior_seq(entries, "news_topic_vec_v2", 3))] == [
        (5, "8#4#0")
    ]
    assert [tuple(x) for x in one(spark, sequences.parse_duration_seq(entries, "news_id"))] == [(5, "V1", 0.0)]
    with pytest.raises(ValueError):
        sequences.parse_behavior_seq(entries, "news_category_v3", 1)


def test_click_in_show(spark):
    show, click = F.array(*map(F.lit, "aba")), F.array(F.lit("b"))
    assert one(spark, sequences.click_in_show(show, click)) == [0, 1, 0]


# ---------------------------------------------------------------- catalogue


def test_training_row_has_735_columns():
    columns = catalog.columns()
    assert len(columns) == 735
    assert set(columns.values()) == {"int", "double", "string"}
    assert len(catalog.frequency_columns()) == 312


def test_random_hashes_agree_with_a_plain_loop(spark):
    rng = random.Random(5)
    words = ["".join(chr(rng.choice([97, 233, 0x4E2D, 0x1F600])) for _ in range(rng.randrange(12))) for _ in range(200)]

    def plain(text):
        h = 0
        units = text.encode("utf-16-be")
        for at in range(0, len(units), 2):
            h = (h * 31 + units[at] * 256 + units[at + 1]) & 0xFFFFFFFF
        return h - (1 << 32) if h >> 31 else h

    df = spark.createDataFrame([(w,) for w in words], "s string").select("s", hashing.java_hash(c("s")).alias("h"))
    assert all(r["h"] == plain(r["s"]) for r in df.collect())
