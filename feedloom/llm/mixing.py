"""Mixing sources to target weights: every source's documents are repeated or thinned until its words come near a target.

Tokens are summed per source, a source's rate is target / size, and a document is emitted floor(rate) times plus once
more when its hash-seeded draw falls below the fraction of the rate.

Cases: a null or empty text has size 0; a null source is a source of its own, last in order; a source without words has
target 0 and is not emitted; an empty table gives no rows; rows with the same doc_id get the same draw (rows without one
draw by their text); other columns are kept as they are, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import running_totals
from ..session import materialize
from .common import SALTS, WORD

BROADCAST_SOURCES = 10_000
BROADCAST_CHARS = 1_000_000


def size_of(text: str | Column) -> Column:
    """Number of words, 0 for null"""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from a hash: 52 bits of MD5 over seed and id"""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), text), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**52))


def source_targets(totals: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size) -> + target. Targets share all words by weight, none above ``cap`` times its source.

    Sources are weighed in turn by code point order. In the order of cap / weight, the capped sources come first: a
    source is capped when the level (words left / weights left) reaches its ratio, and the rest share at the first
    level that does not. Ranks and running sums work by ranges, so the number of sources is not limited by one task.
    """
    by_name = [F.asc_nulls_last("source")]
    ranked = running_totals(totals, by_name, {"_rank": F.lit(1).cast("bigint")})
    turn = F.pmod("_rank", F.lit(len(weights))).cast("int")
    weighed = ranked.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("bigint").alias("_weight"),
    ).withColumn("_ratio", F.col("source_size") * F.lit(float(cap)) / F.col("_weight"))
    by_ratio = [F.asc("_ratio"), F.asc_nulls_last("source")]
    placed = materialize(
        running_totals(weighed, by_ratio, {"_capped": F.col("source_size") * F.lit(cap), "_passed": F.col("_weight")}),
        "sources",
    )
    sums = placed.agg(F.sum("source_size").alias("_all"), F.sum("_weight").alias("_weights"))
    left = F.col("_all") - F.col("_capped")
    level = left.cast("double") / (F.col("_weights") - F.col("_passed"))
    leveled = placed.join(F.broadcast(sums)).withColumn("_level", level)  # one row of sums
    open_level = leveled.filter(F.col("_ratio") > F.col("_level")).agg(F.max("_level").alias("_share"))
    capped = F.col("source_size") * F.lit(float(cap))
    target = F.when(F.col("_ratio") <= F.col("_level"), capped).otherwise(F.col("_weight") * F.col("_share"))
    return leveled.join(F.broadcast(open_level)).select("source", "source_size", target.alias("target"))


def with_targets(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Add source_size and target by source.

    The table of sources is measured: up to BROADCAST_SOURCES names it is broadcast, beyond that every source is
    repeated SALTS times and documents are dealt by (source, salt), so that a large source has many tasks.
    """
    keyed = targets.withColumnRenamed("source", "_source")
    measured = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("_source")).alias("chars")).first()
    same = F.col("source").eqNullSafe(F.col("_source"))
    if measured["n"] <= BROADCAST_SOURCES and (measured["chars"] or 0) <= BROADCAST_CHARS:
        return docs.join(F.broadcast(keyed), same).drop("_source")
    salted = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    dealt = docs.withColumn("_deal", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    return dealt.join(salted, same & (F.col("_deal") == F.col("_salt"))).drop("_source", "_salt", "_deal")


MADE = ("size", "source_size", "target", "n_copies")


def _counted(docs: DataFrame, weights: Sequence[int], cap: int, seed: int) -> DataFrame:
    """doc_id, text, source, the whole row packed as _row, and the columns MADE.

    Words are counted once, into a table by source; rates go back to the documents by their source.
    """
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row"))
    sized = packed.withColumn("size", size_of("text"))
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    out = with_targets(sized, materialize(source_targets(totals, weights, cap), "targets"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = F.when(draw(F.col("doc_id"), F.col("text"), seed) < rate - whole, 1).otherwise(0)
    return out.withColumn("n_copies", (whole + extra).cast("bigint"))


def copies(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: int = 7) -> DataFrame:
    """The documents with size, source_size, target and the number of copies the mix takes of each"""
    counted = _counted(docs, weights, cap, seed)
    return counted.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in MADE], *MADE)


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: int = 7) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, with the columns it came with"""
    taken = _counted(docs, weights, cap, seed).filter(F.col("n_copies") > 0)
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_copies")))
    return taken.select("_row", times.alias("_copy")).select("_row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s
), r AS (
  SELECT *, source_size * 3.0::DOUBLE / weight AS ratio, sum(source_size) OVER () AS everything,
    sum(weight) OVER () AS weights FROM w
), p AS (
  SELECT *, coalesce(sum(source_size * 3) OVER earlier, 0) AS capped, coalesce(sum(weight) OVER earlier, 0) AS passed
  FROM r WINDOW earlier AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (everything - capped)::DOUBLE / (weights - passed)::DOUBLE AS level FROM p
), t AS (
  SELECT source, source_size, CASE WHEN ratio <= level THEN source_size * 3.0::DOUBLE
    ELSE weight * (SELECT max(level) FROM l WHERE ratio > level) END::DOUBLE AS target FROM l
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    CAST('0x' || substr(md5('7:' || coalesce(CAST(d.doc_id AS VARCHAR), 'text:' || d.text, '')), 1, 13) AS BIGINT)
      / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
