"""Keyed state: the monotonic filter, latest times per field in map state, and their expiry."""

from __future__ import annotations

import time as clock
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import windows
from ..operators.skew import lookup_join
from . import levels

STATE_TTL_MS = 300_000


def keep_increasing(times: np.ndarray, start: int | None, emit_first: bool) -> tuple[np.ndarray, int]:
    """Which times exceed all before them and ``start``, and the state afterwards"""
    if start is None and emit_first:
        start = 0
    if start is None:
        start = int(times[0])  # the first time sets the state and is not emitted
    tops = np.maximum.accumulate(np.concatenate([[start], times]))
    return times > tops[:-1], int(tops[-1])


def monotonic_filter(
    rows: DataFrame,
    key: str,
    time: str,
    seq: str,
    ttl_ms: int = STATE_TTL_MS,
    emit_first: bool = True,
) -> DataFrame:
    """Emit a row when its time is greater than its key's state, and store it.

    The state expires ``ttl_ms`` after the key was last read or written, whether or not the value changed:
    each call renews the timeout. Spark hands over new rows of a key before it fires the key's timeout, so
    the last access is kept in the state as well and an old state counts as none.

    Rows of a micro-batch come in no order, so ``seq`` orders them; a key's share of one micro-batch is
    held in memory and is bounded by the source's rate limit.
    """
    columns = rows.columns

    def step(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        batch = pd.concat(list(chunks), ignore_index=True)
        batch.columns = columns
        batch = batch.sort_values(seq, kind="stable")
        now = state.getCurrentProcessingTimeMs()
        start = None
        if state.exists:
            top, touched = state.get
            start = top if now - touched < ttl_ms else None
        kept, after = keep_increasing(batch[time].to_numpy("int64"), start, emit_first)
        state.update((after, now))
        state.setTimeoutDuration(ttl_ms)
        yield batch[kept]

    return rows.groupBy(key).applyInPandasWithState(
        step, rows.schema, "top bigint, touched bigint", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


# ---------------------------------------------------------------- without keyed Python


def increasing_sink(
    out: str,
    table: str,
    key: str,
    time: str,
    seq: str,
    ttl_ms: int = STATE_TTL_MS,
    emit_first: bool = True,
    block_rows: int = 100_000,
    fan: int = levels.FAN,
    now_ms: Callable[[], int] = lambda: int(clock.time() * 1000),
) -> Callable[[DataFrame, int], None]:
    """The monotonic filter as a sink: kept rows in ``out``, a folder for each batch, and every key's top in ``table``.

    A batch is filtered by ``windows.monotonic_filter``, which cuts each key into blocks of arrival numbers, so a key
    with a third of the rows is spread over as many tasks as it has blocks and no task holds it as a whole. The keys'
    tops before the batch are joined to its rows (hot keys salted). Tops are written for the batch's own keys only, with
    the time they were last touched, and folded in levels.

    A repeated batch starts from the tops before it and replaces its folders: only batches before the present one are
    folded. A top that was not touched for ``ttl_ms`` counts as none.
    """
    keyed = levels.Keyed((key,), ("top", "touched"))

    def handle(df: DataFrame, batch_id: int) -> None:
        spark, now = df.sparkSession, now_ms()
        levels.compact(spark, table, keyed, fan, before=batch_id)
        rows = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).persist()
        folders = levels.paths(spark, table, before=batch_id)
        if folders:
            tops = keyed.merged(levels.rows_of(spark, folders, keyed))
            alive = tops.filter(F.col("touched") + F.lit(ttl_ms) > F.lit(now)).select(key, F.col("top").alias("_start"))
            started = lookup_join(rows, alive, key, "left", spread=[seq])
        else:
            started = rows.withColumn("_start", F.lit(None).cast("bigint"))
        kept = windows.monotonic_filter(started, key, time, seq, block_rows, emit_first, start="_start")
        kept.select(*df.columns).write.mode("overwrite").parquet(levels.batch_path(out, batch_id))
        tops = [F.max(time), F.max("_start"), *([F.lit(0)] if emit_first else [])]
        marks = [F.lit(batch_id).cast("bigint").alias(f"_seq_{c}") for c in keyed.cells]
        new = started.groupBy(key).agg(F.greatest(*tops).cast("bigint").alias("top"))
        touched = new.withColumn("touched", F.lit(now).cast("bigint")).select(*new.columns, "touched", *marks)
        touched.write.mode("overwrite").parquet(levels.batch_path(table, batch_id))
        rows.unpersist()

    return handle


def read_kept(spark: SparkSession, out: str, schema) -> DataFrame:
    """The rows that ``increasing_sink`` kept"""
    folders = [levels.batch_path(out, b) for b in levels.later_batches(spark, out, -1)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


# ---------------------------------------------------------------- map state

# rows of a task that are reduced at once
REDUCED_ROWS = 250_000
MAP_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def map_state_store(spark: SparkSession) -> Iterator[None]:
    """Map state and its expiry need a state store on disk; the setting is read when a query starts"""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, MAP_STORE)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LatestPerField(StatefulProcessor):
    """A map field -> (time, seq) for each key; entries expire one by one

    A group is of one key, or with ``keyed=0`` of several: then the key stands before the field in the map.
    """

    def __init__(self, names: tuple[str, ...], kinds: tuple[str, ...], ttl_ms: int, keyed: int = 1):
        self.names, self.kinds, self.ttl_ms, self.keyed = names, kinds, ttl_ms, keyed

    def init(self, handle: StatefulProcessorHandle) -> None:
        *places, time, seq = self.kinds
        places = ", ".join(f"{n} {kind}" for n, kind in list(zip(("key", "field"), places))[self.keyed :])
        self.latest = handle.getMapState("latest", places, f"time {time}, seq {seq}", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best: dict = {}  # one entry for each field of the group's part in this batch
        for chunk in rows:
            for *place, time, seq in zip(*[chunk[n].tolist() for n in self.names[self.keyed :]]):
                place, new = tuple(place), (time, seq)
                best[place] = max(best.get(place, new), new)
        out = []
        for place, new in best.items():
            # every call is a message to the store, so an absent entry is told by its value alone
            old = self.latest.getValue(place)
            # written back in any case: an entry lives on when it is read, not only when it rises
            self.latest.updateValue(place, new if old is None else max(tuple(old), new))
            if old is None or new > tuple(old):
                out.append((*key[: self.keyed], *place, *new))
        if out:
            yield pd.DataFrame(out, columns=list(self.names))

    def close(self) -> None:
        pass


def latest_per_field(
    rows: DataFrame, key: str, field: str, time: str, seq: str, ttl_ms: int = STATE_TTL_MS, parts: int = 4096
) -> DataFrame:
    """(key, field, time, seq) whenever a field of a key has a greater (time, seq) than its map state holds.

    Each entry of the map expires ``ttl_ms`` after it was last read or written; a field that comes back later starts
    anew. Start the query within ``map_state_store`` (and ``without_idle_batches`` for one that drains).

    Entries are dealt to ``parts`` groups by key and field, so that a key with a third of all rows is no single task's and a
    key with few rows no group of its own; the rows of one field are reduced to their greatest before the shuffle, one
    for each run of rows. Rows with a null in
    one of the four columns are left out.
    """
    names = (key, field, time, seq)
    whole = rows.select(*names).dropna()

    def reduced(frames: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(frames).sort_values([time, seq]).drop_duplicates([key, field], keep="last")

    def greatest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, fresh = [], 0
        for frame in frames:
            held.append(frame)
            fresh += len(frame)
            if fresh >= REDUCED_ROWS:
                yield reduced(held)
                held, fresh = [], 0
        if held:
            yield reduced(held)

    part = F.pmod(F.xxhash64(F.col(key), F.col(field)), F.lit(parts)).cast("int")
    dealt = whole.mapInPandas(greatest, whole.schema).withColumn("_part", part)
    kinds = tuple(dict(whole.dtypes)[n] for n in names)
    return dealt.groupBy("_part").transformWithStateInPandas(
        LatestPerField(names, kinds, ttl_ms, keyed=0), whole.schema, "append", "processingTime"
    )
