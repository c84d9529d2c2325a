"""Line dedup: lines found in many documents stay only in the document with the largest id.

Hashes of line keys are kept in levelled sorted runs. A run is a table of (hash, documents, largest id), bucketed and
sorted by the hash; every level holds at most one run, and two runs of a level are merged into one of the next. The
table comes in batches of descending ids. A new batch is anti-joined against the runs, by merging along the sorted
buckets: keys already known to be repeated are settled, for their largest id has been seen, and add no more entries.
What is left of the batch becomes a run of its own.

Cases: a null or empty text is one empty line, which is too short to drop; rows count as documents, so five equal rows
are five documents; of rows that share the largest id all keep the line; a null id counts as the smallest; a document
may lose all its lines, its text is then empty; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import STRIP, salted_join, sql_strip

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ("_h1", "_h2")


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased; ``lower`` does that where all is ASCII"""
    bare = F.btrim(line, F.lit(STRIP))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def lines_of(text: str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_keys(lines: Column, min_chars: int) -> Column:
    """Per line its key, null where it is too short to drop"""
    return F.transform(
        lines, lambda x: F.when(F.char_length(F.btrim(x, F.lit(STRIP))) >= min_chars, line_key(x))
    )


def hashes(key: str) -> list[Column]:
    """128 bits: two hashes with different seeds"""
    return [F.xxhash64(key).alias(KEY[0]), F.xxhash64(F.lit(1), key).alias(KEY[1])]


class LineRuns:
    """Levelled sorted runs of line hashes, as bucketed tables of the session's warehouse"""

    def __init__(self, spark: SparkSession, min_docs: int, buckets: int):
        self.spark, self.min_docs, self.buckets = spark, min_docs, buckets
        self.levels: list[str | None] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, *KEY)
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("compression", "zstd").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")

    def add(self, batch: DataFrame) -> None:
        """Merge-anti-join the batch (hash, _docs, _last) with the runs and add what is left as a run."""
        for name in filter(None, self.levels):
            settled = self.spark.table(name).filter(F.col("_docs") >= self.min_docs)
            batch = batch.join(settled, list(KEY), "left_anti")
        self._carry(self._write(batch), 0)

    def _carry(self, name: str, level: int) -> None:
        """Put a run on its level; when that is taken, merge the two and go on with the next level."""
        if level == len(self.levels):
            self.levels.append(None)
        held = self.levels[level]
        if held is None:
            self.levels[level] = name
            return
        self.levels[level] = None
        self._carry(self._merge(held, name), level + 1)

    def _merge(self, one: str, two: str) -> str:
        a, b = self.spark.table(one), self.spark.table(two).select(*KEY, F.col("_docs").alias("_d"), F.col("_last").alias("_l"))
        both = a.join(b, list(KEY), "full_outer")
        docs = F.coalesce("_docs", F.lit(0)) + F.coalesce("_d", F.lit(0))
        merged = self._write(both.select(*KEY, docs.alias("_docs"), F.greatest("_last", "_l").alias("_last")))
        self._drop(one)
        self._drop(two)
        return merged

    def repeated(self) -> DataFrame:
        """Compact all runs into one; its keys of at least ``min_docs`` documents, as a written table."""
        names = [n for n in self.levels if n]
        while len(names) > 1:
            names = [self._merge(names[0], names[1]), *names[2:]]
        out = materialize(self.spark.table(names[0]).filter(F.col("_docs") >= self.min_docs), "repeated_lines")
        self._drop(names[0])
        self.levels = []
        return out


def repeated_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, batches: int = 4) -> DataFrame:
    """(_h1, _h2, _docs, _last): the keys in at least ``min_docs`` documents and the largest id that holds them.

    ``_docs`` counts until the key was settled, so it is at least ``min_docs`` and at most the number of documents.
    The table is read once: lines are counted by (batch, hash), combined on the map side, and written by batch.
    """
    spark = docs.sparkSession
    shares = [i / batches for i in range(batches - 1, 0, -1)]
    edges = docs.approxQuantile("doc_id", shares, 0.01) if shares else []
    number = sum((F.when(F.col("doc_id") >= F.lit(int(e)), 0).otherwise(1) for e in edges), F.lit(0))
    keys = F.array_distinct(F.array_compact(long_keys(lines_of("text"), min_chars)))
    rows = docs.select("doc_id", number.alias("_batch"), F.explode(keys).alias("_key"))
    counted = (
        rows.select("doc_id", "_batch", *hashes("_key"))
        .groupBy("_batch", *KEY)
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("doc_id").alias("_last"))
    )
    table = materialize(counted, "line_batches")
    runs = LineRuns(spark, min_docs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for i in range(batches):
        runs.add(table.filter(F.col("_batch") == i).drop("_batch"))
    return runs.repeated()


def drop_repeated_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, batches: int = 4) -> DataFrame:
    """The documents with ``text`` reduced to the lines that stay, and the columns n_lines and n_dropped.

    Lines meet the repeated keys by hash, hot keys salted; what a document loses is gathered as line numbers, bounded
    by its own lines, and brought back by (doc_id, hash of the text), which tells rows of one id apart.
    """
    repeated = repeated_lines(docs.select("doc_id", "text"), min_docs, min_chars, batches)
    mark = F.xxhash64("text")
    lines = docs.select(
        "doc_id", mark.alias("_mark"), F.posexplode(long_keys(lines_of("text"), min_chars)).alias("_pos", "_key")
    ).filter(F.col("_key").isNotNull())
    met = salted_join(
        lines.select("doc_id", "_mark", "_pos", *hashes("_key")), repeated, KEY, "_docs", ["doc_id", "_mark", "_pos"]
    ).filter(~F.col("doc_id").eqNullSafe(F.col("_last")))
    lost = met.groupBy(F.col("doc_id").alias("_id"), F.col("_mark").alias("_of")).agg(
        F.collect_set("_pos").alias("_lost")
    )
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    marked = docs.select(
        "doc_id", F.struct(*rest).alias("_row"), mark.alias("_mark"), lines_of("text").alias("_lines")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of"))
    joined = marked.join(lost, same, "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_lost"))
    kept = F.when(F.col("_lost").isNull(), F.col("_lines")).otherwise(
        F.transform(places, lambda i: F.get("_lines", i))
    )
    out = joined.select(
        "_row.*",
        F.array_join(kept, "\n").alias("text"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
    return out.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


SQL = rf"""
WITH l AS (
  SELECT doc_id, lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos, row_no
  FROM (SELECT doc_id, row_number() OVER () AS row_no, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT doc_id, row_no, pos, line, translate({sql_strip('line')}, '{UPPER}', '{UPPER.lower()}') AS key FROM l
), r AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT row_no) >= 5
), f AS (
  SELECT k.doc_id, k.row_no, k.pos, k.line, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.last AS lost
  FROM k LEFT JOIN r ON k.key = r.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM f GROUP BY doc_id, row_no
"""
