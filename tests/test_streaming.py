import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.operators import windows
from feedloom.session import run_dir, shared_dir
from feedloom.sources import readers
from feedloom.streaming import jobs, levels, state

c = F.col


def stream_of(spark, *batches, schema):
    """A file stream that hands out one batch per trigger"""
    path = run_dir(spark, "source")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    return readers.stream_files(spark, path, spark.createDataFrame([], schema).schema, files_per_trigger=1)


def drained(spark, df, **options):
    out = run_dir(spark, "out")
    with jobs.without_idle_batches(spark):
        jobs.drain(jobs.to_files(df, out, run_dir(spark, "checkpoint"), **options))
    return spark.read.schema(df.schema).parquet(out)


def test_keep_increasing():
    keep, top = state.keep_increasing(np.array([3, 2, 3, 5]), None, True)
    assert keep.tolist() == [True, False, False, True] and top == 5
    keep, top = state.keep_increasing(np.array([3, 2, 4]), None, False)
    assert keep.tolist() == [False, False, True] and top == 4
    keep, top = state.keep_increasing(np.array([3, 9]), 5, True)
    assert keep.tolist() == [False, True] and top == 9
    keep, top = state.keep_increasing(np.array([-3]), None, True)
    assert keep.tolist() == [False] and top == 0


@pytest.mark.parametrize("emit_first", [True, False])
def test_stream_state_is_kept_between_batches(spark, emit_first):
    first = [(0, 1, 10), (1, 2, 5), (2, 1, 8)]
    second = [(3, 1, 9), (4, 1, 11), (5, 2, 6), (6, 3, 1)]
    rows = stream_of(spark, first, second, schema="seq bigint, k bigint, t bigint")
    got = drained(spark, state.monotonic_filter(rows, "k", "t", "seq", emit_first=emit_first))
    batch = windows.monotonic_filter(
        spark.createDataFrame(first + second, "seq bigint, k bigint, t bigint"), "k", "t", "seq", emit_first=emit_first
    )
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in batch.collect()}


def test_expired_state_counts_as_none(spark):
    rows = stream_of(spark, [(0, 1, 10)], [(1, 1, 5)], schema="seq bigint, k bigint, t bigint")
    got = drained(spark, state.monotonic_filter(rows, "k", "t", "seq", ttl_ms=1))
    assert {r["seq"] for r in got.collect()} == {0, 1}


def test_first_writes_over_the_whole_stream(spark):
    rows = stream_of(spark, [("a", "1", "x")], [("a", "1", "y"), ("b", "1", "z")], schema="n string, f string, v string")
    got = drained(spark, jobs.first_writes(rows, "n", "f"))
    assert {tuple(r) for r in got.collect()} == {("a", "1", "x"), ("b", "1", "z")}


def test_repeated_batch_counts_once(spark):
    table = run_dir(spark, "upserts")
    sink = jobs.upsert_sink(table, "k", ["x", "y"], "seq")
    schema = "k string, x string, y string, seq bigint"
    one = spark.createDataFrame([("a", "1", None, 1), ("a", None, "2", 2)], schema)
    two = spark.createDataFrame([("a", None, "3", 3), ("b", "4", None, 4)], schema)
    for batch, n in ((one, 0), (two, 1), (two, 1)):
        sink(batch, n)
    got = jobs.read_upserts(spark, table, "k", ["x", "y"])
    assert {tuple(r) for r in got.collect()} == {("a", "1", "3"), ("b", "4", None)}
    target = run_dir(spark, "compact")
    jobs.compact_upserts(spark, table, "k", ["x", "y"], target)
    assert spark.read.parquet(target).count() == 2


def test_processing_time_counts(spark):
    rows = stream_of(spark, [("a",), ("a",), ("b",)], schema="k string")
    table = run_dir(spark, "counts")
    counts = jobs.tumbling_count(rows, ["k"])
    jobs.drain(jobs.to_batches(counts, jobs.counts_sink(table), run_dir(spark, "checkpoint"), mode="update"))
    got = jobs.read_counts(spark, table, ["k"])
    assert {(r["k"], r["n"]) for r in got.collect()} == {("a", 2), ("b", 1)}


def test_late_files_count(spark):
    source, table = run_dir(spark, "source"), run_dir(spark, "counts")
    for day in (3, 2, 1):  # a file each, the latest first
        rows = spark.range(100).select((F.lit(day * 86_400_000) + F.col("id") * 1000).alias("t"), F.lit("a").alias("k"))
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = readers.stream_files(spark, source, "t bigint, k string", files_per_trigger=1)
    sink = jobs.count_deltas_sink(table, ["k"], F.timestamp_millis("t"))
    jobs.drain(jobs.to_batches(stream, sink, run_dir(spark, "checkpoint")))
    got = jobs.read_count_deltas(spark, table, ["k"])
    assert got.agg(F.sum("n")).first()[0] == 300 and got.count() == 60


def test_console_sink(spark):
    rows = stream_of(spark, [("a",)], schema="k string")
    jobs.drain(jobs.to_console(rows, run_dir(spark, "checkpoint")))


def test_unknown_text_source(spark):
    with pytest.raises(ValueError):
        readers.stream_text(spark, "pipe")


def test_a_cluster_has_to_name_the_shared_folder():
    class Context:
        master = "yarn"
        applicationId = "x"

    class Conf:
        def __init__(self, value=None):
            self.value = value

        def get(self, _, default):
            return self.value or default

    class Session:
        sparkContext = Context()

        def __init__(self, value=None):
            self.conf = Conf(value)

    with pytest.raises(RuntimeError):
        shared_dir(Session())
    assert shared_dir(Session("hdfs:///work/")) == "hdfs:///work"


def test_map_state_entries_expire_one_by_one(spark):
    """Three batches: 'a' is read in the second and lives on, 'b' is not and starts anew in the third"""
    schema = "k bigint, f string, t bigint, seq bigint"

    def reader(ttl_ms):
        source, out, checkpoint = run_dir(spark, "source"), run_dir(spark, "out"), run_dir(spark, "checkpoint")

        def take_in(*rows):
            start = time.time()
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
            stream = readers.stream_files(spark, source, spark.createDataFrame([], schema).schema)
            latest = state.latest_per_field(stream, "k", "f", "t", "seq", ttl_ms=int(ttl_ms), parts=2)
            with state.map_state_store(spark), jobs.without_idle_batches(spark):
                jobs.drain(jobs.to_files(latest, out, checkpoint))
            return start, time.time()

        return take_in, out

    start, end = reader(1000)[0]((1, "a", 1, 0))
    ttl = 4 * (end - start)  # seconds, by the time a drain takes here
    take_in, out = reader(1000 * ttl)
    first = take_in((1, "a", 10, 0), (1, "b", 10, 1), (1, "a", 9, 2), (2, "b", 1, 3), (None, "a", 1, 4), (1, None, 1, 5))
    time.sleep(0.4 * ttl)
    second = take_in((1, "a", 8, 6))
    time.sleep(max(0, first[1] + ttl + 0.1 - time.time()))
    third = take_in((1, "a", 7, 7), (1, "b", 7, 8))
    if second[1] - first[0] >= ttl or third[1] - second[0] >= ttl:
        pytest.skip("the machine's pace changed during the test")
    got = {tuple(r) for r in spark.read.schema(schema).parquet(out).collect()}
    assert got == {(1, "a", 10, 0), (1, "b", 10, 1), (2, "b", 1, 3), (1, "b", 7, 8)}


class FakeMap(dict):
    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value


def test_map_state_is_written_back_when_read():
    written = []

    class Handle:
        def getMapState(self, *_, ttlDurationMs):
            assert ttlDurationMs == 5
            return type("Noted", (FakeMap,), {"updateValue": lambda m, k, v: (written.append(k), m.__setitem__(k, v))})()

    latest = state.LatestPerField(("k", "f", "t", "seq"), ("bigint", "string", "bigint", "bigint"), 5)
    latest.init(Handle())
    chunks = [[("a", 3, 0), ("b", 1, 1)], [("a", 5, 2)]]
    frames = [pd.DataFrame([(1, *x) for x in chunk], columns=["k", "f", "t", "seq"]) for chunk in chunks]
    out = pd.concat(latest.handleInputRows((1, 0), iter(frames), None))
    assert sorted(map(tuple, out.to_numpy().tolist())) == [(1, "a", 5, 2), (1, "b", 1, 1)]
    assert not list(latest.handleInputRows((1, 0), iter(frames[:1]), None)) and written.count(("a",)) == 2


def test_map_state_group_holds_entries_of_several_keys():
    """Two messages to the store for each entry: one to read, one to write"""
    made, calls = FakeMap(), []

    class Handle:
        def getMapState(self, name, key, *_, ttlDurationMs):
            assert key == "key bigint, field string"
            return type("Counted", (FakeMap,), {n: lambda m, *x, n=n: (calls.append(n), getattr(made, n)(*x))[1]
                                                for n in ("containsKey", "getValue", "updateValue")})()

    names = ("k", "f", "t", "seq")
    latest = state.LatestPerField(names, ("bigint", "string", "bigint", "bigint"), 5, keyed=0)
    latest.init(Handle())
    frame = pd.DataFrame([(1, "a", 3, 0), (2, "a", 4, 1), (2, "b", 1, 2), (1, "a", 2, 3)], columns=names)
    out = pd.concat(latest.handleInputRows((17,), iter([frame]), None))
    assert sorted(map(tuple, out.to_numpy().tolist())) == [(1, "a", 3, 0), (2, "a", 4, 1), (2, "b", 1, 2)]
    assert len(calls) == 6


def test_map_state_of_a_hot_key_is_dealt_to_tasks(spark):
    rows = [(1, f"f{i % 50}", i, i) for i in range(3000)]
    stream = stream_of(spark, rows, schema="k bigint, f string, t bigint, seq bigint")
    latest = state.latest_per_field(stream, "k", "f", "t", "seq", parts=8)
    with state.map_state_store(spark):
        got = drained(spark, latest)
    assert {tuple(r) for r in got.collect()} == {(1, f"f{i % 50}", i, i) for i in range(2950, 3000)}
    plan = spark.createDataFrame(rows, stream.schema).select(F.pmod(F.xxhash64("f"), F.lit(8)).alias("p")).distinct()
    assert plan.count() > 4


ARRIVALS = "seq bigint, k bigint, t bigint"


@pytest.mark.parametrize("emit_first", [True, False])
def test_increasing_sink_equals_the_filter_over_all_batches(spark, emit_first):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 5)) if i % 3 else 0, int(rng.integers(-50, 50) + i // 10)) for i in range(600)]
    out, table = run_dir(spark, "kept"), run_dir(spark, "tops")
    sink = state.increasing_sink(out, table, "k", "t", "seq", emit_first=emit_first, block_rows=20, fan=2)
    for batch in range(6):
        sink(spark.createDataFrame(rows[100 * batch : 100 * batch + 100], ARRIVALS).repartition(3), batch)
    # the last batch is repeated, as after a failure
    sink(spark.createDataFrame(rows[500:], ARRIVALS), 5)
    got = [tuple(r) for r in state.read_kept(spark, out, ARRIVALS).collect()]
    want, tops = [], {}
    for seq, k, t in rows:
        if t > tops.get(k, 0 if emit_first else t):
            want.append((seq, k, t))
        tops[k] = max(tops.get(k, 0 if emit_first else t), t)
    assert sorted(got) == want
    assert len(levels.versions(spark, table)) == 2  # tops are folded on the way


def test_increasing_sink_lets_tops_expire(spark):
    out, table, now = run_dir(spark, "kept"), run_dir(spark, "tops"), [0]
    sink = state.increasing_sink(out, table, "k", "t", "seq", ttl_ms=10, now_ms=lambda: now[0])
    for batch, (at, *rows) in enumerate(
        [(0, (0, 1, 10), (1, 2, 10)), (9, (2, 1, 5)), (15, (3, 1, 6), (4, 2, 6)), (26, (5, 1, 1), (None, None, None))]
    ):
        now[0] = at
        sink(spark.createDataFrame(rows, ARRIVALS), batch)
    # key 1 was read at 9 and lives on at 15, key 2 was not; at 26 both are over
    assert {r["seq"] for r in state.read_kept(spark, out, ARRIVALS).collect()} == {0, 1, 4, 5}


def test_a_key_with_a_third_of_the_rows_uses_several_tasks(spark):
    rows = spark.range(9000).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # would put these few rows into one task
    spark.conf.set(name, "false")
    try:
        started = rows.withColumn("_start", F.lit(30))
        kept = windows.monotonic_filter(started, "k", "t", "seq", block_rows=500, start="_start")
        hot = kept.withColumn("task", F.spark_partition_id()).filter("k = 0")
        assert hot.count() == 2989 and hot.select("task").distinct().count() > 1
    finally:
        spark.conf.unset(name)


def test_counted_and_late_rows_are_all_rows(spark):
    """Any cut into batches, one of them repeated; a row is late by the clock of the batches before its own"""
    rng = np.random.default_rng(4)
    rows = [(int(t), rng.choice(["a", "b"])) for t in rng.integers(0, 60_000, 400)] + [(None, "a")]
    for cuts in ([0, 401], [0, 100, 101, 300, 401]):
        counts, late, clock = (run_dir(spark, n) for n in ("counts", "late", "clock"))
        sink = jobs.late_aware_sink(counts, late, clock, ["k"], F.timestamp_millis("t"), delay_ms=1000)
        want_late, top = [], None
        for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = spark.createDataFrame(rows[a:b], "t bigint, k string")
            sink(part, batch)
            if batch == 1:
                sink(part, batch)
            for t, k in rows[a:b]:
                if t is None or (top is not None and t // 5000 * 5000 + 5000 <= top - 1000):
                    want_late.append((t, k))
            top = max([t for t, _ in rows[a:b] if t is not None] + ([top] if top is not None else []))
        got_late = [(r["t"], r["k"]) for r in jobs.read_late(spark, late).collect()]
        assert sorted(got_late, key=str) == sorted(want_late, key=str)
        counted = jobs.read_count_deltas(spark, counts, ["k"]).agg(F.sum("n")).first()[0]
        assert counted + len(got_late) == len(rows)
