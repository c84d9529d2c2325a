"""Licence scans: lines compared to licence notices by the Dice coefficient over word bigrams.

A unit (a line, or a whole text of several lines) is normalised to lower-case letters and digits. A notice with a
bigrams and a unit with b can reach a coefficient t only when t / (2 - t) <= a / b <= (2 - t) / t. So every notice is listed under the unit
sizes it can match, and units meet that short list by their size. A match also shares at least t / (2 - t) of the notice's
bigrams, so it holds one of any few of them that are more than the rest; those with the longest words are listed, and
documents and units without a listed bigram are dropped by one search before they are normalised.

Cases: null and empty texts match nothing; units of one word have no bigrams and match nothing; repeated bigrams count
once; a unit may match several notices; rows with the same doc_id are one document; an empty table gives no rows;
other columns are not returned.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: wording of public licence notices
NOTICES = (
    ("mit-short", "Released under the MIT License."),
    ("mit-licensed", "Licensed under the MIT License."),
    ("apache-2.0-short", "Licensed under the Apache License, Version 2.0."),
    ("gpl-2.0-short", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0-short", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3.0-short", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("cc-by-4.0-short", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0-short", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0-short", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0-named", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-4.0-named", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "mit-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "isc-permission",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "bsd-redistribution",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "gpl-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "apache-2.0-notice",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "mpl-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
THRESHOLD = 0.8


def normalised(text: str | Column) -> Column:
    """Words of ASCII letters and digits in lower case, one blank between them"""
    return F.btrim(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")))


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words"""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pair = lambda a, b: F.concat_ws(" ", a, b)
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), pair))


def _pairs(text: str) -> list[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Smallest and largest number of bigrams that can reach the threshold with ``n``"""
    return ceil(n * threshold / (2 - threshold) - 1e-9), floor(n * (2 - threshold) / threshold + 1e-9)


def telling_pairs(pairs: list[str], threshold: float) -> set[str]:
    """Bigrams, those of the longest words, of which every text that reaches the threshold holds at least one"""
    shared = ceil(len(pairs) * threshold / (2 - threshold) - 1e-9)
    return set(sorted(pairs, key=lambda p: (-max(map(len, p.split())), -len(p), p))[: len(pairs) - shared + 1])


def bigram_pattern(pairs: set[str]) -> str:
    """Regular expression that finds one of the bigrams in a text that is not normalised"""
    following: dict[str, list[str]] = {}
    for first, second in sorted(tuple(p.split()) for p in pairs):
        following.setdefault(first, []).append(second)
    choices = "|".join(f"{first}[^a-z0-9]++(?:{'|'.join(seconds)})" for first, seconds in following.items())
    return f"(?i)(?<![a-z0-9])(?:{choices})(?![a-z0-9])"


def scan(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per matching unit and notice: doc_id, unit (line number from 1, 0 for the whole text), license, dice;
    a document without matches has one row of nulls.

    Everything up to the grouping happens in the row; the listed notices are a parameter, a few KB that are broadcast.
    """
    spark = docs.sparkSession
    listed = [(name, _pairs(text)) for name, text in notices]
    sizes = {name: size_bounds(len(pairs), threshold) for name, pairs in listed}
    rows = [{"license": name, "_pairs": pairs, "low": sizes[name][0], "high": sizes[name][1]} for name, pairs in listed]
    kind = "array<struct<license:string,_pairs:array<string>,low:int,high:int>>"
    parsed = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))
    table = parsed.select(F.explode(F.sequence("low", "high")).alias("_n"), "license", "_pairs")
    least, most = min(low for low, _ in sizes.values()), max(high for _, high in sizes.values())
    telling = F.lit(bigram_pattern(set().union(*(telling_pairs(pairs, threshold) for _, pairs in listed))))

    def unit(number: Column, line: Column) -> Column:
        return F.struct(number.alias("unit"), line.alias("line"))

    lines = F.split("text", "\n", -1)
    numbered = F.transform(lines, lambda x, i: unit(i + 1, x))
    # n distinct bigrams have at most n + 1 distinct words, and a whole text with more cannot match
    few = F.size(F.array_distinct(F.split(normalised("text"), " "))) <= most + 1
    whole = F.when((F.size(lines) > 1) & few, F.array(unit(F.lit(0), F.col("text"))))
    none = F.array(unit(F.lit(-1), F.lit("")))
    units = F.concat(none, numbered, F.coalesce(whole, F.slice(none, 1, 0)))
    # documents without a telling bigram are told by one search, before anything is taken apart
    exploded = docs.select("doc_id", F.explode_outer(F.when(F.rlike("text", telling), units).otherwise(none)).alias("u"))
    marked = F.col("unit") == -1
    held = exploded.select("doc_id", "u.*").filter(marked | F.rlike("line", telling))
    split = held.select("doc_id", "unit", F.split(normalised("line"), " ").alias("words"))
    # a unit has fewer distinct bigrams than words, so short ones go before their bigrams are made
    large = split.filter((F.size("words") > least) | marked)
    sized = large.select("doc_id", "unit", bigrams(F.col("words")).alias("own")).withColumn("_n", F.size("own"))
    met = sized.join(F.broadcast(table), "_n", "left").filter(F.col("license").isNotNull() | (F.col("unit") == -1))
    common = F.size(F.array_intersect("own", "_pairs"))
    dice = (2.0 * common) / (F.size("own") + F.size("_pairs"))
    scored = met.withColumn("dice", dice).filter((F.col("dice") >= threshold) | (F.col("unit") == -1))
    real = F.col("unit") >= 0
    return scored.select(
        "doc_id", *[F.when(real, F.col(c)).alias(c) for c in ("unit", "license", "dice")]
    )


def by_document(found: DataFrame) -> DataFrame:
    """doc_id, n_matches, licenses (sorted names), best_dice; 0, '' and 0.0 without matches"""
    return found.groupBy("doc_id").agg(
        F.count("license").alias("n_matches"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.coalesce(F.max("dice"), F.lit(0.0)).alias("best_dice"),
    )


def _sql() -> str:
    values = ", ".join(f"('{name}', {_pairs(text)!r})" for name, text in NOTICES)
    return rf"""
WITH notices(license, pairs) AS (VALUES {values}),
t AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT row_no, doc_id, text, string_split(text, chr(10)) AS lines FROM t),
u AS (
  SELECT row_no, doc_id, unnest(lines) AS unit FROM l
  UNION ALL SELECT row_no, doc_id, text FROM l WHERE len(lines) > 1
), w AS (
  SELECT doc_id, string_split(trim(lower(regexp_replace(unit, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS words FROM u
), b AS (
  SELECT doc_id, list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS own FROM w
), m AS (
  SELECT doc_id, license,
    2.0::DOUBLE * len(list_intersect(own, pairs)) / (len(own) + len(pairs))::DOUBLE AS dice
  FROM b JOIN notices ON len(own) BETWEEN len(pairs) * 0.6 AND len(pairs) * 1.6
), h AS (SELECT * FROM m WHERE dice >= {THRESHOLD}::DOUBLE)
SELECT t.doc_id, count(h.license)::BIGINT AS n_matches,
  coalesce(string_agg(DISTINCT h.license, ',' ORDER BY h.license), '') AS licenses,
  coalesce(max(h.dice), 0.0::DOUBLE) AS best_dice
FROM (SELECT DISTINCT doc_id FROM t) t LEFT JOIN h ON t.doc_id IS NOT DISTINCT FROM h.doc_id
GROUP BY t.doc_id
"""


SQL = _sql()
