"""Keyed tables: scans by row key, last write wins, deletes, set-if-absent, expiry."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .skew import lookup_join

# ---------------------------------------------------------------- scans


def key_range(df: DataFrame, key: str, start: str, stop: str) -> DataFrame:
    """Rows with key in [start, stop); equal bounds address the one row"""
    k = F.col(key)
    if start == stop:
        return df.filter(k == start)
    return df.filter((k >= start) & (k < stop))


def key_at_most(df: DataFrame, key: str, bound: str) -> DataFrame:
    return df.filter(F.col(key) <= bound)


def key_matches(df: DataFrame, key: str, regex: str) -> DataFrame:
    return df.filter(F.col(key).rlike(regex))


def key_contains(df: DataFrame, key: str, part: str) -> DataFrame:
    """Substring filter, letter case ignored"""
    return df.filter(F.lower(key).contains(part.lower()))


# ---------------------------------------------------------------- writes


def upsert_latest(df: DataFrame, key: str, cells: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per key; each cell holds its last written value (``seq`` gives the order of writes).

    A null is no write. ``max_by`` combines on the map side, so a key with many writes stays cheap.
    """
    order = F.struct(*seq)
    return df.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in cells])


def merge_upsert(table: DataFrame, writes: DataFrame, key: str, cells: Sequence[str], seq: str) -> DataFrame:
    """Merge new writes into a table; ``seq`` of the table is older than that of the writes"""
    both = table.withColumn(seq, F.lit(-1).cast("bigint")).unionByName(writes, allowMissingColumns=True)
    return upsert_latest(both, key, cells, [seq])


def with_expiry(df: DataFrame, write_ms: Column, ttl_ms: int) -> DataFrame:
    return df.withColumn("expire_at", write_ms + F.lit(ttl_ms))


def alive(df: DataFrame, as_of_ms: Column) -> DataFrame:
    return df.filter(F.col("expire_at") > as_of_ms)


def delete_cells(table: DataFrame, deletes: DataFrame, key: str, cells: Sequence[str]) -> DataFrame:
    """Blank the cells named in ``deletes`` (key, cell); a row without any cell left is gone"""
    marks = deletes.groupBy(key).agg(
        *[F.max(F.when(F.col("cell") == c, 1)).alias(f"_del_{c}") for c in cells]
    )
    out = lookup_join(table, marks, key, "left")
    out = out.withColumns({c: F.when(F.col(f"_del_{c}").isNull(), F.col(c)) for c in cells})
    anything_left = reduce(or_, [F.col(c).isNotNull() for c in cells])
    return out.drop(*[f"_del_{c}" for c in cells]).filter(anything_left)


def check_and_delete(table: DataFrame, requests: DataFrame, key: str, check: str, target: str) -> DataFrame:
    """Apply a delete of cell ``target`` only where cell ``check`` equals the request's ``expected``.

    A null ``expected`` asks for the cell to be absent. Returns the table with ``applied``: null for rows
    nobody asked to delete from, else whether the delete took place. Of several requests for a key one that holds is
    enough; they become one answer per key before they meet the table.
    """
    met = table.select(key, check).distinct().join(requests.select(key, "expected").distinct(), key)
    answers = met.groupBy(key, check).agg(F.max(F.col(check).eqNullSafe(F.col("expected"))).alias("applied"))
    own = answers.select(F.col(key).alias("_key"), F.col(check).alias("_check"), "applied")
    same = (F.col(key) == F.col("_key")) & F.col(check).eqNullSafe(F.col("_check"))
    out = table.join(own, same, "left").drop("_key", "_check")
    return out.withColumn(target, F.when(~F.coalesce("applied", F.lit(False)), F.col(target)))


def delete_in_order(
    table: DataFrame, requests: DataFrame, key: str, cells: Sequence[str], seq: str
) -> tuple[DataFrame, DataFrame]:
    """Conditional deletes applied one after another: a later check sees what an earlier delete did.

    ``requests`` has the key, ``seq`` (the order within a key), ``check`` and ``target`` (names of cells) and
    ``expected`` (the check cell's value as text, null for an absent cell). A request holds when its check cell is as
    expected at its turn; then its target cell is blank from there on. Returns the table (one row per key) after all
    requests, and the requests for keys of the table with ``applied``.

    A cell can be blanked once only. So between two changes of a row nothing depends on order, and the next change is the
    earliest request that holds now and has something to delete: a minimum, combined on the map side. As many such turns
    as there are cells settle every key at once, however many requests it has; no task sorts or folds a key's requests.
    Equal ``seq`` of a key are ordered by target, check and expected value.
    """
    values = {c: F.col(f"_v_{c}") for c in cells}
    cells_of = table.select(key, *[F.col(c).cast("string").alias(f"_v_{c}") for c in cells])
    place = F.struct(F.col(seq).alias("s"), "target", "check", "expected")
    asked = lookup_join(requests, cells_of, key, "inner", spread=[seq, "target", "check"])
    met = materialize(asked.withColumn("_place", place), "requests")
    gone = {c: F.col(f"_gone_{c}") for c in cells}
    kind = met.schema["_place"].dataType
    blank = {f"_gone_{c}": F.lit(None).cast(kind) for c in cells}
    settled = materialize(cells_of.select(key).withColumns(blank), "blanked")

    def value(name: str, turn: Column | None) -> Column:
        """The cell a column names, before the change at ``turn`` (None: after all changes so far)"""
        out = F.lit(None).cast("string")
        for c in cells:
            kept = gone[c].isNull() if turn is None else gone[c].isNull() | (gone[c] >= turn)
            out = F.when(F.col(name) == c, F.when(kept, values[c])).otherwise(out)
        return out

    latest = F.greatest(*gone.values()) if len(cells) > 1 else gone[cells[0]]
    for _ in cells:
        now = lookup_join(met, settled, key, "inner", spread=[seq, "target", "check"])
        open_ = now.filter(latest.isNull() | (F.col("_place") > latest))
        holding = open_.filter(value("check", None).eqNullSafe(F.col("expected")) & value("target", None).isNotNull())
        found = materialize(holding.groupBy(key).agg(F.min("_place").alias("_next")), "next")
        if found.isEmpty():
            break
        changed = {n: F.when(F.col("_next.target") == c, F.col("_next")).otherwise(F.col(n)) for c, n in
                   ((c, f"_gone_{c}") for c in cells)}
        settled = materialize(settled.join(found, key, "left").withColumns(changed).drop("_next"), "blanked")

    final = table.join(settled, key, "left").withColumns({c: F.when(gone[c].isNull(), F.col(c)) for c in cells})
    judged = lookup_join(met, settled, key, "inner", spread=[seq, "target", "check"])
    applied = value("check", F.col("_place")).eqNullSafe(F.col("expected"))
    return final.select(*table.columns), judged.select(*requests.columns, applied.alias("applied"))


def set_if_absent(df: DataFrame, name: str, field: str, value: str, seq: str) -> DataFrame:
    """The first value written to each (name, field)"""
    return df.groupBy(name, field).agg(F.min_by(value, seq).alias(value))


def set_flag_with_expiry(
    df: DataFrame, name: str, field: str, click: str, seq: str, write_ms: str, ttl_ms: int = 180_000
) -> DataFrame:
    """First-written click flag ('1' or '0') per (name, field); every write renews the expiry of the name.

    A name's last write comes from the aggregated rows, not from a window over all writes of the name.
    """
    flags = df.groupBy(name, field).agg(
        F.min_by(F.when(F.col(click) == "1", "1").otherwise("0"), seq).alias("flag"),
        F.max(write_ms).alias("_last"),
    )
    expiry = flags.groupBy(name).agg((F.max("_last") + F.lit(ttl_ms)).alias("expire_at"))
    return lookup_join(flags.drop("_last"), expiry, name, "inner", spread=[name, field])


def setex_rows(
    df: DataFrame, user: str, category: str, ids: str, allow: Sequence[str], now_ms: Column, ttl_s: int = 86_400
) -> DataFrame:
    """(key, value, expire_at) rows for the allowed users; the key is ``{user}category:bert``"""
    key = F.concat(F.lit("{"), F.col(user).cast("string"), F.lit("}"), F.col(category), F.lit(":bert"))
    return df.filter(F.col(user).isin(*allow)).select(
        key.alias("key"), F.col(ids).alias("value"), (now_ms + F.lit(ttl_s * 1000)).alias("expire_at")
    )
