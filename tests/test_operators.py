import json
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.operators import cdc, history, keyed, lookups, recall, samples, skew, stats, training, windows
from feedloom.plans.views import Views
from feedloom.session import run_dir
from feedloom.sources import readers, writers

c = F.col


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# ---------------------------------------------------------------- skew


@pytest.fixture(scope="module")
def hot(spark):
    """Key 0 holds most rows, key 9 has no partner, key 7 no left row; one key is null"""
    left = [(i, 0 if i % 3 else i % 10) for i in range(300)] + [(999, None)]
    right = [(k, f"r{k}{n}") for k in (0, 3, 6, 7) for n in range(2)]
    return (
        spark.createDataFrame(left, "id int, k int"),
        spark.createDataFrame(right, "k int, v string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(hot, how):
    left, right = hot
    columns = ["id", "k"] + (["v"] if how in ("inner", "left") else [])
    got = skew.skew_join(left, right, "k", how, hot_rows=20, salts=7)
    key = lambda r: tuple(str(x) for x in r)
    plain = sorted(map(tuple, left.join(right, "k", how).select(*columns).collect()), key=key)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == plain


def test_skew_join_spreads_the_hot_key(hot):
    left, right = hot
    plan = skew.skew_join(left, right, "k", "inner", hot_rows=20, salts=7)
    assert "_salt" in plan._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        skew.skew_join(left, right, "k", "full")


def test_hot_keys_follow_rows_and_share(hot, monkeypatch):
    left, _ = hot
    counts = {r["k"]: r["count"] for r in left.groupBy("k").count().collect()}
    for hot_rows, share in ((20, 100_000), (0, 3)):
        monkeypatch.setattr(skew, "HOT_KEYS", share)
        least = max(hot_rows, sum(counts.values()) / share)
        got = {r["k"] for r in skew.hot_keys(left, ["k"], hot_rows).collect()}
        assert got == {k for k, n in counts.items() if n > least}
        assert len(got) < share
    assert skew.hot_keys(left.limit(0), ["k"], 0).count() == 0


def test_lookup_join_has_a_way_beyond_the_size_limit(hot):
    left, right = hot
    small = skew.lookup_join(left, right, "k", "inner", max_bytes=skew.estimated_bytes(right))
    large = skew.lookup_join(left, right, "k", "inner", max_bytes=1, hot_rows=20, salts=5)
    assert "_salt" not in small._jdf.queryExecution().toString()
    assert "_salt" in large._jdf.queryExecution().toString()
    assert rows(small, "id", "k", "v") == rows(large, "id", "k", "v")


# ---------------------------------------------------------------- horizons


@pytest.mark.parametrize("hot_rows", [0, 150, 10_000])
def test_horizon_sums_against_brute_force(spark, hot_rows):
    rng = random.Random(1)
    hist = [(rng.randrange(3), rng.randrange(1, 400) * 1000, rng.randrange(5)) for _ in range(400)]
    asked = [(i, rng.randrange(4), rng.randrange(1, 400) * 1000) for i in range(200)]
    horizons = {"a": 5_000, "b": 100_000}
    got = history.horizon_sums(
        spark.createDataFrame(asked, "id int, u int, at bigint"),
        spark.createDataFrame(hist, "u int, t bigint, n int"),
        ["u"], "at", "t", ["n"], horizons, block_ms=7_000, hot_rows=hot_rows,
    )
    want = [
        (i, *[sum(n for hu, t, n in hist if hu == u and at - h < t < at) for h in horizons.values()])
        for i, u, at in asked
    ]
    assert rows(got, "id", "a_n", "b_n") == sorted(want)


def test_horizon_bounds_are_strict(spark):
    hist = spark.createDataFrame([(1, t, 1) for t in (100, 150, 200)], "u int, t bigint, n int")
    asked = spark.createDataFrame([(0, 1, 200)], "id int, u int, at bigint")
    got = history.horizon_sums(asked, hist, ["u"], "at", "t", ["n"], {"h": 100, "g": 101}, block_ms=30, hot_rows=0)
    assert rows(got, "h_n", "g_n") == [(1, 2)]


def test_counts_grow_with_the_horizon(spark, sf_dir):
    from feedloom.plans.views import Views

    v = Views(spark, sf_dir)
    asked = v.sample.select("sample_id", "user_id", "event_time")
    out = history.frequency_control(asked, v.show, v.click, ["user_id"], "event_time", "t_ms")
    order = ["r", "1hour", "l", "48hour", "7days", "14days"]
    wrong = [c(f"{a}_s") > c(f"{b}_s") for a, b in zip(order, order[1:])]
    for w in wrong:
        assert out.filter(w).count() == 0


def test_history_vectors_keep_users_without_values(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 2), (2, 0), (3, 99)], "u int, x int")
    got = history.history_vector(df, "u", "x", 50, drop_value=0)
    assert rows(got, "u", "indices", "values") == [(1, [2, 5], [1.0, 2.0]), (2, [0], [0.0]), (3, [0], [0.0])]


# ---------------------------------------------------------------- windows


@pytest.mark.parametrize("emit_first", [True, False])
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_monotonic_filter(spark, emit_first, block):
    rng = random.Random(2)
    data = [(i, rng.randrange(3), rng.randrange(-5, 60)) for i in range(300)]
    top, want = {}, []
    for i, k, t in data:
        if k not in top and not emit_first:
            top[k] = t
        elif t > top.get(k, 0):
            top[k] = t
            want.append((i, k, t))
    got = windows.monotonic_filter(
        spark.createDataFrame(data, "seq int, k int, t int"), "k", "t", "seq", block, emit_first
    )
    assert rows(got, "seq", "k", "t") == want


def test_latest_n_is_cut_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = recall.latest_n(df, "user_id", [F.desc("ts")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# ---------------------------------------------------------------- keyed tables


def test_key_range_with_equal_bounds_is_one_row(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert rows(keyed.key_range(df, "k", "b", "b"), "k") == [("b",)]
    assert rows(keyed.key_range(df, "k", "a", "c"), "k") == [("a",), ("b",)]
    assert rows(keyed.key_contains(df, "k", "B"), "k") == [("b",)]


def test_upsert_keeps_the_last_value_of_each_cell(spark):
    old = spark.createDataFrame([("k1", "a", "b"), ("k2", "c", None)], "k string, x string, y string")
    new = spark.createDataFrame(
        [("k1", None, "b2", 1), ("k1", None, "b3", 2), ("k3", "n", None, 3)], "k string, x string, y string, seq bigint"
    )
    got = keyed.merge_upsert(old, new, "k", ["x", "y"], "seq")
    assert {tuple(r) for r in got.collect()} == {("k1", "a", "b3"), ("k2", "c", None), ("k3", "n", None)}


def test_row_without_cells_is_gone(spark):
    table = spark.createDataFrame([("k1", "a", 1), ("k2", "b", None)], "k string, x string, y int")
    deletes = spark.createDataFrame([("k1", "x"), ("k2", "x"), ("k9", "x")], "k string, cell string")
    assert {tuple(r) for r in keyed.delete_cells(table, deletes, "k", ["x", "y"]).collect()} == {("k1", None, 1)}


def test_check_and_delete(spark):
    table = spark.createDataFrame(
        [("a", "1", "x"), ("b", None, "x"), ("c", "2", "x"), ("d", "1", "x")], "k string, chk string, val string"
    )
    asked = spark.createDataFrame(
        [("a", "1"), ("a", "2"), ("b", None), ("c", "1"), ("c", "3")], "k string, expected string"
    )
    got = keyed.check_and_delete(table, asked, "k", "chk", "val")
    assert {tuple(r) for r in got.select("k", "val", "applied").collect()} == {
        ("a", None, True), ("b", None, True), ("c", "x", False), ("d", "x", None),
    }
    assert got.count() == 4


def test_an_empty_list_is_encoded_as_one(spark):
    entry = "array<struct<t:bigint,keys:array<string>>>"
    df = spark.createDataFrame([(1, [(5, ["a", "z"])]), (2, []), (3, None)], f"id int, keys {entry}")
    codes = spark.createDataFrame([("f", "a", 7)], "feature string, text string, code int")
    got = lookups.encode_sequence(df, codes, "id", "keys", "f", 2, "seq")
    assert {r["id"]: [tuple(e) for e in r["seq"]] for r in got.collect()} == {1: [(5, "7#0")], 2: [], 3: []}


def test_expiry(spark):
    df = keyed.with_expiry(spark.createDataFrame([(100,), (200,)], "t bigint"), c("t"), 60)
    assert rows(keyed.alive(df, F.lit(160)), "t") == [(200,)]


# ---------------------------------------------------------------- samples, lookups, statistics


def test_broken_items_are_dropped(spark):
    cells = {
        "itemFeature_ok": '{"a":"1"}',
        "itemFeature_bad": "no json",
        "itemFeature_pctr": '{"a":"1"}',
        "recommend_result_pctr": '{"pctr":"x"}',
        "itemFeature_none": "{}",
        "feedback_like:ok": "1",
    }
    df = spark.createDataFrame([(cells,)], "cells map<string,string>")
    out = samples.explode_items(df.withColumn("items", samples.items_of(c("cells"), ["a"])))
    got = out.select("item.news_id", "item.pctr", "item.recall_type", "item.feedback_like_flag", "item.duration")
    assert [tuple(r) for r in got.collect()] == [("ok", 0.0, "", 1, None)]


def test_gates(spark):
    data = [("0000000001000u", t) for t in (1000, 1001, 3_600_999, 3_601_000)]
    df = spark.createDataFrame(data, "token string, t bigint")
    assert rows(samples.latency_gate(df, "token", "t"), "t") == [(1001,), (3_600_999,)]
    items = spark.createDataFrame(
        [(5, "V001", "20"), (6, "V061", "20"), (7, "V001", "25|1"), (8, None, "20"), (9, "V002", "21")],
        "at bigint, id string, r string",
    )
    assert rows(samples.freshness_gate(items, "at", 5, "id", "r"), "at") == [(9,)]


def test_prebatch_drops_incomplete_groups(spark):
    df = spark.range(0, 25).select(c("id"), F.array(c("id"), -c("id")).alias("v"))
    got = samples.prebatch_pack(df, "id", 3, ["id", "v"], partition_rows=10)
    assert rows(got, "part", "grp", "id")[-1] == (2, 0, [20, 21, 22])
    assert got.count() == 7
    assert got.filter((c("part") == 0) & (c("grp") == 0)).first()["v"] == [0, 0, 1, -1, 2, -2]


def test_sampling_and_partitions(spark):
    df = spark.range(10_000)
    half = samples.fraction_sample(df, 0.5, "id")
    assert 4500 < half.count() < 5500
    assert rows(half, "id") == rows(samples.fraction_sample(df, 0.5, "id"), "id")
    assert [samples.output_partitions(n) for n in (0, 1, 100_000, 100_001)] == [1, 1, 1, 2]


def test_dictionary_codes(spark):
    words = [("f", w) for w in ("b", "a", "ab", "b", "zz", None)] + [("g", "a")]
    d = lookups.build_dictionary(spark.createDataFrame(words, "feature string, text string"))
    assert rows(d, "feature", "text", "code") == [("f", "a", 1), ("f", "ab", 2), ("f", "b", 3), ("f", "zz", 4), ("g", "a", 1)]
    df = spark.createDataFrame([(1, "ab|q|zz"), (2, None)], "id int, s string")
    got = lookups.multi_encode(df, d, "f", "s", "id", "codes", limit=4)
    assert rows(got, "id", "codes") == [(1, [2, 0]), (2, [0])]


def test_dictionary_is_numbered_in_ranges(spark):
    text = F.concat(F.lit("https://example.com/"), F.lpad(F.col("id").cast("string"), 6, "0"))
    words = spark.range(100_000).select(F.lit("f").alias("feature"), text.alias("text"))
    assert lookups.text_ranges(words).select("_block").distinct().count() > 1
    d = lookups.build_dictionary(words)
    wrong = d.filter(F.col("code") != F.substring("text", 21, 6).cast("int") + 1)
    assert (d.count(), wrong.count()) == (100_000, 0)


def test_membership_flag(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    members = spark.createDataFrame([(2,), (2,), (5,)], "id int")
    assert rows(lookups.membership_flag(df, members, ["id"], "m"), "id", "m") == [(1, 0), (2, 1), (2, 1)]


def test_statistics_spec():
    assert stats.parse_spec("a:MAX, b:avg") == [("a", "MAX"), ("b", "AVG")]
    for bad in ("a", "a:MEDIAN", ":MAX"):
        with pytest.raises(ValueError):
            stats.parse_spec(bad)


def test_cdc_flattens_every_row_of_a_message(spark):
    text = '{"type":"INSERT","database":"d","table":"t","ts":1704164640000,"data":[{"id":"1"},{"id":"2","x":"é"}]}'
    df = spark.createDataFrame([(text,), ("broken",)], "value string")
    got = cdc.cdc_flatten(cdc.cdc_filter(df, "INSERT", "d", "t"), "id", zone="Asia/Shanghai")
    assert rows(got, "primary_key", "date_time", "params") == [
        ("1", "2024-01-02 11:04:00", '{"id":"1"}'), ("2", "2024-01-02 11:04:00", '{"id":"2","x":"é"}'),
    ]


# ---------------------------------------------------------------- sources and sinks


def test_source_switch(spark):
    assert readers.resolve_source("HBase") == "hbase"
    with pytest.raises(ValueError):
        readers.resolve_source("ftp")


def test_unreadable_text_is_empty(spark):
    assert readers.text_lines(spark, "/nowhere/at/all").count() == 0


def test_manifest_columns_of_any_length(spark):
    entries = spark.range(25_000).select(F.concat(F.lit("f"), "id").alias("name"), F.lit("int").alias("type"))
    found = readers.manifest_columns(entries.union(entries))
    assert found.count() == 25_000 and found.select("type").distinct().collect()[0]["type"] == "array<int>"
    with pytest.raises(Exception, match="manifest type unknown: date"):
        readers.manifest_columns(spark.createDataFrame([("a", "date")], "name string, type string")).collect()


def test_coding_map_by_dictionary(spark):
    dictionary = spark.createDataFrame([("f", "a", 1), ("f", "b", 2), ("g", "c", 3)], "feature string, text string, code int")
    texts = [(1, "a:1,b:2,a:3"), (2, None), (3, " "), (4, "c:5,x:6"), (5, "a:oops,bad")]
    got = lookups.coding_map_by_dictionary(
        spark.createDataFrame(texts, "id long, text string"), dictionary, "f", "id", "text", "m"
    )
    assert dict(map(tuple, got.collect())) == {1: {1: 3.0, 2: 2.0}, 2: {}, 3: {}, 4: {0: 6.0}, 5: {1: None}}


def test_topn_codes_breaks_ties_by_key(spark):
    rows = [(1, "c", 2.0), (1, "b", 3.0), (1, "a", 2.0), (2, "z", 1.0)]
    top = recall.topn_codes(spark.createDataFrame(rows, "id long, k string, w double"), "id", "k", "w", 2, F.upper)
    assert dict(map(tuple, top.collect())) == {1: ["B", "A"], 2: ["Z"]}


def test_manifest_refuses_rather_than_cuts(spark):
    entries = spark.createDataFrame([("a", "int"), ("b", "double")], "name string, type string")
    assert readers.manifest_schema(entries).simpleString() == "struct<a:array<int>,b:array<double>>"
    with pytest.raises(ValueError):
        readers.manifest_schema(entries, max_fields=1)


def test_csv_sink_does_not_overwrite(spark):
    from pyspark.errors import AnalysisException

    path = run_dir(spark, "csv")
    df = spark.range(3)
    writers.write_csv_once(df, path, single_file=True)
    with pytest.raises(AnalysisException):
        writers.write_csv_once(df, path)


def test_scans_reach_the_files(spark, sf_dir):
    df = readers.scan_time_range(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", 1_704_412_800_000, 1_706_184_000_000)
    plan = df.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan and "props" not in plan
    path = run_dir(spark, "parts")
    writers.write_partitioned(spark.range(4).select("id", F.lit("2024-01-05").alias("day"), (c("id") + 8).cast("string").alias("hour")), path, "day", "hour")
    got = readers.scan_day_hour(spark.read.parquet(path), 1_704_445_200_000, 1_704_452_400_000)
    assert rows(got, "id") == [(1,), (2,)]
    assert "PartitionFilters: []" not in got._jdf.queryExecution().executedPlan().toString()


def test_failed_partition_leaves_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")

    class Failing(writers.JsonLinesWriter):
        def write(self, row):
            raise RuntimeError("store is down")

    with pytest.raises(Exception, match="store is down"):
        writers.foreach_partition_write(spark.range(3).coalesce(1), lambda n: Failing(folder, n))
    assert not list((tmp_path / "out").glob("part-*"))


def test_brute_force_recall(spark):
    rng = random.Random(3)
    clicks = [(rng.randrange(5), rng.randrange(6), t) for t in range(80)]
    near = [(i, f"n{rng.randrange(9)}", rng.choice("xy")) for i in range(6) for _ in range(3)]
    got = recall.recall_by_neighbors(
        spark.createDataFrame(clicks, "u int, news_id int, t int"),
        spark.createDataFrame(near, "news_id int, recalled string, articletype string"),
        "u", [F.desc("t")], 4,
    )
    want = defaultdict(set)
    for u in range(5):
        for _, item, _ in sorted((x for x in clicks if x[0] == u), key=lambda x: -x[2])[:4]:
            for i, r, a in near:
                if i == item:
                    want[u, a].add(r)
    assert Counter(tuple(r) for r in got.collect()) == Counter((u, a, ",".join(sorted(s))) for (u, a), s in want.items())


# ---------------------------------------------------------------- training rows


def test_training_row_counts_whole_histories(spark):
    """A user with 350 events of each kind: sums are of all of them, sequences are the latest"""
    n, at = 350, 1_700_000_000_000
    times = [at - 60_000 * (n - i) for i in range(n)]
    behaviour = [
        f'{{"event_time":"{t}","news_id":"V{i % 2}","read_duration":"{i}","news_category_v3":{{"c1":1}},'
        f'"news_topic_vec_v2":{{"{i % 2}":1.0}}}}'
        for i, t in enumerate(times)
    ]
    entries = [
        (1, cell, t, value(i))
        for i, t in enumerate(times)
        for cell, value in (
            ("user_sl_feed_news_show_fc_v2", lambda i: behaviour[i]),
            ("user_sl_feed_news_duration_fc_v2", lambda i: behaviour[i]),
            ("user_smart_launcher_feed_news_click_fc_news_top_category_v3", lambda i: str(i % 2)),
            ("user_smart_launcher_feed_news_duration_fc_read_duration", lambda i: str(i)),
        )
    ]
    history = spark.createDataFrame(entries, "request_id int, cell string, t bigint, value string")
    user = {
        "token": f"{at}1",
        "event_time": str(at),
        "user_sl_feed_news_show_fc_v2": json.dumps(behaviour),
        "user_sl_feed_news_duration_fc_v2": json.dumps(behaviour),
        "user_smart_launcher_feed_news_click_fc_news_top_category_v3": json.dumps(
            {"t1": times, "t2": [str(i % 2) for i in range(n)]}
        ),
        "user_smart_launcher_feed_news_duration_fc_read_duration": json.dumps(
            {"t1": times, "t2": [str(i) for i in range(n)]}
        ),
    }
    item = {"newsId": "V1", "topic_vec_v2": '{"size":2001,"indices":[1],"values":[0.5]}'}
    requests = spark.createDataFrame([(1, user)], "request_id int, user map<string,string>")
    items = spark.createDataFrame([(7, 1, item)], "sample_id bigint, request_id int, item map<string,string>")
    dictionary = spark.createDataFrame([("news_category_v3", "c1", 1)], "feature string, text string, code int")
    odd = range(1, n, 2)
    expected = {
        "sl_news_id_nv_14days_s_times": [len(odd)],
        "sl_news_id_nv_14days_read_duration": [sum(odd)],
        "sl_news_id_nv_1hour_s_times": [len([i for i in odd if n - i < 60])],
        "sl_news_topic_v2_top5_nv_14days_s_times_values": [len(odd)],
        "sb_user_14days_read_duration": [round(sum(range(n)) / 1000, 2)],
        "user_click_news_top_category_v3_history_indices": [0, 1],
        "user_click_news_top_category_v3_history_values": [n / 2, n / 2],
    }
    few = requests.withColumn(
        "user", F.map_filter("user", lambda key, _: key.isin("token", "event_time", "user_sl_feed_news_show_fc_v2"))
    )
    ids = "user_sl2_feed_news_show_fc_news_id"
    for given, whole in ((few, history), (requests, None)):
        row = training.assemble(given, items, dictionary, None, [*expected, ids, f"{ids}_length"], whole).first()
        assert {name: list(row[name]) for name in expected} == expected
        assert row[f"{ids}_length"] == [121] and len(row[ids]) == 121
        codes = {f"V{p}": 31 * ord("V") + ord(str(p)) for p in (0, 1)}
        assert row[ids] == [codes[f"V{i % 2}"] for i in range(n - 121, n)]


def test_profile_keeps_whole_histories(spark, tmp_path):
    """The stand-in hands every event on, not the latest of each kind"""
    events = [(i, 1, "view", datetime(2024, 1, 1) + timedelta(minutes=i), 1.0, '{"k": 1}') for i in range(350)]
    schema = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    views = Views(spark, str(tmp_path))
    got = training.assemble(
        views.requests, views.request_items, views.training_dictionary, None, ["sl_news_id_nv_14days_s_times"], views.behaviours
    ).collect()
    assert len(got) == 350 and {r["sl_news_id_nv_14days_s_times"][0] for r in got} == {350.0}


def test_deletes_in_order_against_one_by_one(spark):
    rng = random.Random(9)
    cells = ["x", "y", "z"]
    table = [(k, *[rng.choice([None, "1", "2"]) for _ in cells]) for k in range(30)]
    requests = []
    for k in range(-2, 32):
        for turn in rng.sample(range(100), rng.randint(0, 12) if k != 7 else 60):
            requests.append((k, turn, rng.choice(cells), rng.choice([None, "1", "2"]), rng.choice(cells)))
    rows = {k: dict(zip(cells, v)) for k, *v in table}
    want = []
    for k, turn, check, expected, target in sorted(requests, key=lambda r: r[:2]):
        if k in rows:
            holds = rows[k][check] == expected
            want.append((k, turn, holds))
            if holds:
                rows[k][target] = None
    final, judged = keyed.delete_in_order(
        spark.createDataFrame(table, "k long, x string, y string, z string"),
        spark.createDataFrame(requests, "k long, turn long, check string, expected string, target string"),
        "k",
        cells,
        "turn",
    )
    assert sorted((r["k"], r["turn"], r["applied"]) for r in judged.collect()) == want
    assert {tuple(r) for r in final.collect()} == {(k, *v.values()) for k, v in rows.items()}
    none = spark.createDataFrame([], "k long, turn long, check string, expected string, target string")
    same, nothing = keyed.delete_in_order(spark.createDataFrame(table, final.schema), none, "k", cells, "turn")
    assert {tuple(r) for r in same.collect()} == set(table) and nothing.count() == 0


def test_histories_of_training_rows_are_written_once(spark, sf_dir, monkeypatch):
    from feedloom.plans import q_training

    monkeypatch.setattr(q_training.training, "assemble", lambda *given: given[-1])
    kept = q_training.training_rows(Views(spark, sf_dir), ["token"])
    assert kept.inputFiles() and not any("events.parquet" in f for f in kept.inputFiles())


def test_sums_of_keys_asked_once_are_those_by_points(spark):
    day = 86_400_000
    facts = [(u, x, day * 20 + n * 3_600_001 - v, v) for u in ("a", "b", None) for x in ("p", "q") for n in range(-400, 5, 3) for v in (1, -2, 7)]
    facts += [("a", "p", None, 5), ("a", None, day * 20 - 1, 9), ("a", "p", day * 20 - 300_000, 11), ("a", "p", day * 20, 13)]
    asked = [(1, "a", "p", day * 20), (2, "a", "p", day * 20), (3, "a", "p", day * 19), (4, "a", "r", day * 20)]
    asked += [(5, "b", "q", day * 20 + 7), (6, None, "p", day * 20), (7, "b", "p", None), (8, "c", "p", day * 20)]
    history_rows = spark.createDataFrame(facts, "u string, x string, t bigint, n bigint")
    samples = spark.createDataFrame(asked, "id int, u string, x string, at bigint")
    got = []
    for how in ({}, {"once": True}, {"once": True, "hot_rows": 10}):
        sums = history.horizon_sums(samples, history_rows, ["u", "x"], "at", "t", ["n"], **how)
        got.append(sorted(map(str, sums.select("id", *[f"{h}_n" for h in history.HORIZONS]).collect())))
    assert got[0] == got[1] == got[2]
    assert len(got[0]) == len(asked)


def test_training_rows_of_a_request_with_two_times(spark):
    """Counts are those before each of the times, although most requests have one"""
    listed = json.dumps([json.dumps({"event_time": str(t), "news_id": "V1"}) for t in (1_700_000_000_000, 1_700_000_100_000)])
    cells = [
        ("r", {"token": f"{ms}r", "event_time": str(ms), "user_sl_feed_news_show_fc_v2": listed})
        for ms in (1_700_000_050_000, 1_700_000_150_000)
    ]
    given = spark.createDataFrame(cells, "request_id string, user map<string,string>")
    items = spark.createDataFrame([("s", "r", {"newsId": "V1"})], "sample_id string, request_id string, item map<string,string>")
    dictionary = spark.createDataFrame([], "feature string, text string, code int")
    # a history of its own, as those of two requests of one id would be added up
    whole = training.cell_history(given.limit(1))
    for columns in (["sl_news_id_nv_1hour_s_times", "token"], ["token", "user_sl2_feed_news_show_fc_news_id_length"]):
        rows = training.assemble(given, items, dictionary, None, columns, whole).collect()
        assert {r["token"][0] for r in rows} == {"1700000050000r", "1700000150000r"}
    assert training._asked_once(given.limit(1), F.col("user")["event_time"])
    assert not training._asked_once(given, F.col("user")["event_time"])


def test_training_sequences_are_made_once_a_request():
    """The columns of a pair read ready sequences; the entries they are made of stay with the request"""
    name = "user_sl2_feed_news_click_fc_news_id"
    plan = training.Plan([name, f"{name}_length"])
    assert list(plan.sequences) == [f"q_{name}"]
