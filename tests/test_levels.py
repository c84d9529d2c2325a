"""Levelled compaction: what is read before and after folding, late writes, expiry, versions and leftovers."""

import pytest
from pyspark.sql import functions as F

from feedloom.session import run_dir
from feedloom.streaming import jobs, levels

SCHEMA = "k string, x string, y string, seq bigint, at bigint"


def writer(spark, keyed, fan=2):
    table = run_dir(spark, "levels")
    sink = jobs.keyed_sink(table, keyed, "seq", "at" if keyed.ttl_ms is not None else None, fan=fan)

    def write(batch, *rows):
        sink(spark.createDataFrame([r if len(r) == 5 else (*r, 0) for r in rows], SCHEMA).coalesce(1), batch)

    return table, write


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_folded_and_later_batches_read_alike(spark):
    keyed = levels.Keyed(("k",), ("x", "y"))
    table, write = writer(spark, keyed)
    write(0, ("a", "1", None, 5), ("b", "1", "1", 6))
    assert levels.manifest(spark, table) == {"runs": [], "last": -1}
    write(1, ("a", None, "2", 8), ("c", "3", None, 9))
    assert levels.manifest(spark, table)["last"] == 1
    want = {("a", "1", "2"), ("b", "1", "1"), ("c", "3", None)}
    assert rows(levels.read(spark, table, keyed)) == want
    # written after the fold, but with an older number: it loses; a newer one wins
    write(2, ("a", "old", "old", 4), ("b", None, "new", 7))
    want = {("a", "1", "2"), ("b", "1", "new"), ("c", "3", None)}
    assert rows(levels.read(spark, table, keyed)) == want
    for batch in range(3, 8):
        write(batch, ("d", str(batch), None, batch + 10))
    assert rows(levels.read(spark, table, keyed)) == want | {("d", "7", None)}
    assert [r["level"] for r in levels.manifest(spark, table)["runs"]] == [3]


def test_a_repeated_batch_after_its_fold_changes_nothing(spark):
    keyed = levels.Keyed(("k",), ("x",))
    table, write = writer(spark, keyed)
    write(0, ("a", "1", None, 1))
    write(1, ("a", "2", None, 2))
    before = levels.manifest(spark, table)
    write(1, ("a", "2", None, 2))
    assert levels.manifest(spark, table) == before and levels.later_batches(spark, table, before["last"]) == []
    assert rows(levels.read(spark, table, keyed)) == {("a", "2")}


def test_nothing_unnamed_piles_up(spark):
    keyed = levels.Keyed(("k",), ("x",))
    table, write = writer(spark, keyed)
    for batch in range(16):
        write(batch, ("a", str(batch), None, batch))
    assert len(levels.versions(spark, table)) == 2
    named = {r["folder"] for n in levels.versions(spark, table) for r in levels.manifest(spark, table, n)["runs"]}
    assert set(levels.names_in(spark, f"{table}/_runs")) == named
    assert len(levels.later_batches(spark, table, -1)) <= 4
    assert rows(levels.read(spark, table, keyed)) == {("a", "15")}


def test_a_reader_of_the_version_before_is_not_cut_off(spark):
    keyed = levels.Keyed(("k",), ("x",))
    table, write = writer(spark, keyed)
    for batch in range(3):
        write(batch, ("a", str(batch), None, batch))
    reader = levels.read(spark, table, keyed)
    write(3, ("a", "3", None, 3))
    assert rows(reader) == {("a", "2")} and rows(levels.read(spark, table, keyed)) == {("a", "3")}


def test_an_incomplete_version_is_not_read(spark):
    keyed = levels.Keyed(("k",), ("x",))
    table, write = writer(spark, keyed)
    write(0, ("a", "1", None, 1))
    write(1, ("a", "2", None, 2))
    broken = spark.createDataFrame([("{}",)], "value string").coalesce(1).write
    broken.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(f"{table}/_versions/{9:012d}")
    assert levels.versions(spark, table) == [0]
    assert rows(levels.read(spark, table, keyed)) == {("a", "2")}
    # another writer has published this version meanwhile
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        spark.createDataFrame([("x",)], "value string").write.mode("errorifexists").text(f"{table}/_versions/{0:012d}")


def test_first_writes_win(spark):
    keyed = levels.Keyed(("k",), ("x",), first=True)
    table, write = writer(spark, keyed)
    write(0, ("a", "late", None, 5), ("b", None, None, 1))
    write(1, ("a", "first", None, 2), ("b", "only", None, 7))
    write(2, ("a", "later", None, 9))
    assert rows(levels.read(spark, table, keyed)) == {("a", "first"), ("b", "only")}


def test_expired_cells(spark):
    keyed = levels.Keyed(("k",), ("x", "y"), ttl_ms=100)
    table, write = writer(spark, keyed, fan=100)
    write(0, ("a", "1", "1", 1, 0), ("b", "1", None, 2, 0))
    write(1, ("a", "2", None, 3, 150), ("c", "1", None, 4, 200))
    read = lambda now: rows(levels.read(spark, table, keyed, now))
    assert read(99) == {("a", "2", "1"), ("b", "1", None), ("c", "1", None)}
    # at 100 the writes of time 0 are over; an expired cell does not bring an older write back
    assert read(100) == {("a", "2", None), ("c", "1", None)} and read(250) == {("c", "1", None)}
    assert read(300) == set()
    levels.compact(spark, table, keyed, fan=2, as_of_ms=100)
    assert read(100) == {("a", "2", None), ("c", "1", None)}
    run = levels.paths(spark, table)[0]
    kept = spark.read.parquet(run)
    # the oldest run forgets expired writes; rows without any are gone
    assert {r["k"] for r in kept.collect()} == {"a", "c"}
    assert kept.filter(F.col("_seq_y").isNotNull()).count() == 0


def test_expired_cells_hide_older_writes_until_the_oldest_run_is_folded(spark):
    keyed = levels.Keyed(("k",), ("x",), ttl_ms=100)
    table, write = writer(spark, keyed, fan=100)
    write(0, ("a", "long ago", None, 1, 1000))  # by its number older, by its clock younger
    write(1, ("b", "1", None, 2, 1000))
    levels.compact(spark, table, keyed, fan=2, as_of_ms=500)
    write(2, ("a", "over", None, 3, 0))
    write(3, ("c", "1", None, 4, 1000))
    levels.compact(spark, table, keyed, fan=2, as_of_ms=500)
    assert rows(levels.read(spark, table, keyed, 500)) == {("b", "1"), ("c", "1")}


def test_an_unwritten_table(spark):
    with pytest.raises(FileNotFoundError):
        levels.read(spark, run_dir(spark, "none"), levels.Keyed(("k",), ("x",)))
