"""Keyed tables written batch by batch and folded in levels.

Each batch of a stream adds a folder of its own (``jobs.write_batch``). Folders are folded into runs: as soon as there are
``fan`` of them, into a run of level 1; ``fan`` runs of a level into one of the next. So a row is rewritten once for every
level, and a reader merges at most ``fan`` folders a level. A run keeps what decides between writes, the sequence number
of every cell, so a late write with an older number still loses after its successor has been folded away.

What belongs to the table is said by a manifest: the runs and the last batch they hold. It is written as a new version
beside the old one, and readers take the newest complete version plus later batches. A batch that is repeated after it
was folded is not read again. Folders are removed when neither the newest version nor the one before it names them, so a
reader that has just started is not cut off.

A cell whose write is older than its time to live is dropped when the oldest run is rewritten: nothing older can come up in
its place. Elsewhere it stays as a mark that hides older writes, and readers leave it out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path

FAN = 8
BATCH = "batch="


@dataclass(frozen=True)
class Keyed:
    """How the rows of a table merge: the last write of a cell by its ``_seq_`` column, or with ``first`` the first one.

    With ``ttl_ms`` every cell has its write's time in ``_at_<cell>``.
    """

    key: tuple[str, ...]
    cells: tuple[str, ...]
    first: bool = False
    ttl_ms: int | None = None

    def columns(self) -> list[str]:
        times = [f"_at_{c}" for c in self.cells] if self.ttl_ms is not None else []
        return [*self.key, *self.cells, *[f"_seq_{c}" for c in self.cells], *times]

    def reduced(self, rows: DataFrame, seq: str, time: str | None = None) -> DataFrame:
        """The writes of a batch, one row for each key; a null is no write"""
        cells = {c: F.when(F.col(c).isNotNull(), F.col(seq)) for c in self.cells}
        marked = rows.select(
            *self.key,
            *self.cells,
            *[s.alias(f"_seq_{c}") for c, s in cells.items()],
            *([F.col(time).alias(f"_at_{c}") for c in self.cells] if self.ttl_ms is not None else []),
        )
        return self.merged(marked)

    def merged(self, rows: DataFrame) -> DataFrame:
        """Rows of several folders merged; combines on the map side"""
        pick, edge = (F.min_by, F.min) if self.first else (F.max_by, F.max)
        wins: list[Column] = []
        for c in self.cells:
            seq = f"_seq_{c}"
            wins += [pick(c, seq).alias(c), edge(seq).alias(seq)]
            if self.ttl_ms is not None:
                wins.append(pick(f"_at_{c}", seq).alias(f"_at_{c}"))
        return rows.groupBy(*self.key).agg(*wins).select(*self.columns())

    def without_expired(self, rows: DataFrame, as_of_ms: int | None, wholly: bool = False) -> DataFrame:
        """Cells within their time to live; ``wholly`` forgets the writes of the others as well"""
        if self.ttl_ms is None or as_of_ms is None:
            return rows
        over = {c: F.col(f"_at_{c}") + F.lit(self.ttl_ms) <= F.lit(as_of_ms) for c in self.cells}
        names = {n: c for c in self.cells for n in ([c, f"_seq_{c}", f"_at_{c}"] if wholly else [c])}
        left = rows.withColumns({n: F.when(~F.coalesce(over[c], F.lit(False)), F.col(n)) for n, c in names.items()})
        return left.filter(F.coalesce(*[F.col(f"_seq_{c}") for c in self.cells]).isNotNull())


# ---------------------------------------------------------------- folders and versions


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the complete folders in a folder"""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = path(folder)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    found = [status.getPath() for status in system.listStatus(target) if status.isDirectory()]
    return sorted(p.getName() for p in found if system.exists(path(p, "_SUCCESS")))


def versions(spark: SparkSession, table: str) -> list[int]:
    return [int(name) for name in names_in(spark, f"{table}/_versions")]


def manifest(spark: SparkSession, table: str, version: int | None = None) -> dict:
    """{"runs": [{"level", "folder", "last"}...] from the oldest on, "last": the last batch folded}"""
    known = versions(spark, table)
    if version is None and not known:
        return {"runs": [], "last": -1}
    version = known[-1] if version is None else version
    return json.loads(spark.read.text(f"{table}/_versions/{version:012d}").first()[0])


def later_batches(spark: SparkSession, table: str, last: int) -> list[int]:
    numbers = [int(n.removeprefix(BATCH)) for n in names_in(spark, table) if n.startswith(BATCH)]
    return [n for n in numbers if n > last]


def batch_path(table: str, batch: int) -> str:
    return f"{table}/{BATCH}{batch:012d}"


def paths(spark: SparkSession, table: str, before: int | None = None) -> list[str]:
    """The folders that make up the table now, or before batch ``before`` added to it"""
    known = manifest(spark, table)
    runs = [f"{table}/_runs/{r['folder']}" for r in known["runs"]]
    later = later_batches(spark, table, known["last"])
    return runs + [batch_path(table, b) for b in later if before is None or b < before]


# ---------------------------------------------------------------- reading and folding


def rows_of(spark: SparkSession, folders: Sequence[str], keyed: Keyed) -> DataFrame:
    out = None
    for folder in folders:
        rows = spark.read.parquet(folder).select(*keyed.columns())
        out = rows if out is None else out.unionByName(rows)
    return out


def read(spark: SparkSession, table: str, keyed: Keyed, as_of_ms: int | None = None) -> DataFrame:
    """The table's cells by key, without their sequence numbers; keys whose cells have all expired are left out"""
    folders = paths(spark, table)
    if not folders:
        raise FileNotFoundError(f"nothing has been written to {table}")
    merged = keyed.without_expired(keyed.merged(rows_of(spark, folders, keyed)), as_of_ms)
    return merged.filter(any_cell(keyed)).select(*keyed.key, *keyed.cells)


def any_cell(keyed: Keyed) -> Column:
    there = F.lit(False)
    for c in keyed.cells:
        there = there | F.col(c).isNotNull()
    return there


def fold(spark: SparkSession, table: str, folders: Sequence[str], keyed: Keyed, as_of_ms: int | None, oldest: bool) -> str:
    """Merge folders into a new run"""
    merged = keyed.merged(rows_of(spark, folders, keyed))
    if oldest:
        merged = keyed.without_expired(merged, as_of_ms, wholly=True)
    name = f"run-{uuid.uuid4().hex}"
    merged.write.parquet(f"{table}/_runs/{name}")
    return name


def compact(
    spark: SparkSession, table: str, keyed: Keyed, fan: int = FAN, as_of_ms: int | None = None, before: int | None = None
) -> int:
    """Fold what has come to ``fan`` folders and publish a new version; returns how many runs were written.

    ``before`` leaves that batch and later ones alone. One writer at a time: a version that another one has published meanwhile makes this one fail, with nothing changed.
    """
    known = manifest(spark, table)
    runs, last, written = list(known["runs"]), known["last"], 0
    batches = [b for b in later_batches(spark, table, last) if before is None or b < before]
    if len(batches) >= fan:
        folders = [batch_path(table, b) for b in batches]
        name = fold(spark, table, folders, keyed, as_of_ms, oldest=not runs)
        last, written = batches[-1], written + 1
        runs.append({"level": 1, "folder": name, "last": last})
    while runs:
        # the newest runs of the lowest level
        level = runs[-1]["level"]
        same = [r for r in runs if r["level"] == level]
        if len(same) < fan:
            break
        oldest = len(same) == len(runs)
        name = fold(spark, table, [f"{table}/_runs/{r['folder']}" for r in same], keyed, as_of_ms, oldest)
        written += 1
        runs = [*runs[: -len(same)], {"level": level + 1, "folder": name, "last": same[-1]["last"]}]
    if written:
        publish(spark, table, {"runs": runs, "last": last})
    return written


def publish(spark: SparkSession, table: str, new: dict) -> None:
    """Write the next version, then remove what the newest two versions do not name"""
    known = versions(spark, table)
    number = known[-1] + 1 if known else 0
    line = spark.createDataFrame([(json.dumps(new),)], "value string").coalesce(1)
    line.write.mode("errorifexists").text(f"{table}/_versions/{number:012d}")
    before = manifest(spark, table, known[-1]) if known else {"runs": [], "last": -1}
    named = {r["folder"] for version in (new, before) for r in version["runs"]}
    for name in names_in(spark, f"{table}/_runs"):
        if name not in named:
            delete_path(spark, f"{table}/_runs/{name}")
    for batch in later_batches(spark, table, -1):
        if batch <= before["last"]:
            delete_path(spark, batch_path(table, batch))
    for old in known[:-1]:
        delete_path(spark, f"{table}/_versions/{old:012d}")
