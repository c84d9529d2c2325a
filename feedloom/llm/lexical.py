"""Ranked lexical search: the best documents of each item by summed term impacts, skipping by pair bounds.

Documents are read once into a table of postings by document: the number of terms and, for the terms asked, how often they
stand in the text. Its sums give the collection's figures (documents, terms, documents of a term) and with them every
term's weight. Then each task builds the inverted index of a run of documents: for every term the documents with their
impacts, and the largest impact. For pairs of terms that stand next to each other in an item, by growing largest impact, the
intersection of their lists is made beforehand, with its joint largest impact. A document with both terms has at most
the joint impact, one with a single term at most the larger of the two, so a pair adds at most the largest of these three,
which is often less than the sum of both.

An item is answered from its strongest term on (MaxScore). As long as a document that no list has named yet could still be
among the best, lists are added up whole. Once the bound of the terms to come, put together from pair bounds, is below
the score of the last place, only documents whose score so far plus that bound reaches it are kept; the other lists are
only probed for them, and every probed term drops more. The last place's score is carried from run to run in a task. A
run yields its best documents of each item, and the best of all runs are ranked: nothing is shuffled but those.

Items are answered in blocks of about ITEM_CHARS characters, whose distinct terms are all that is sent to the tasks; the
documents are read once for each block.

Cases: null and empty texts have no terms and count in nothing; a very long text is one row of postings; each row is a
document of its own, so repeated rows rank side by side, and repeated items are answered each; equal scores rank by
doc_id, rows without one last; items without a term or a document of positive score give no rows; an empty table gives no
rows; other columns are not returned.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import slices

# fixed values: what a term is, and the scale of weights and impacts
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
LENGTH_SHARE = 25

ITEM_CHARS = 4_000_000
RUN_DOCS = 32_768
RUN_POSTINGS = 4_000_000
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def terms(text: str | None) -> list[str]:
    return FIND(text.translate(UPPER)) if text else []


FIND = re.compile(TERM).findall


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def postings(docs: DataFrame, numbers) -> DataFrame:
    """doc_id, n (terms of the text), ids and times (the numbered terms it holds and how often); ``numbers`` is a broadcast"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in slices(batches, "text"):
            sizes, ids, times, ends = [], [], [], [0]
            for text in batch.column("text").to_pylist():
                found = terms(text)
                held = Counter(map(number, found))
                held.pop(None, None)
                sizes.append(len(found))
                ids.extend(held)
                times.extend(held.values())
                ends.append(len(ids))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                ],
                names=["doc_id", "n", "ids", "times"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, ids array<int>, times array<long>")


class Run:
    """Inverted index of a run of documents, rows in the order of ids"""

    def __init__(self, docs: np.ndarray, ids: np.ndarray, impacts: np.ndarray, size: int):
        order = np.lexsort((docs, ids))
        ids, self.all_docs, self.all_impacts = ids[order], docs[order], impacts[order]
        self.size = size
        present, starts = np.unique(ids, return_index=True)
        ends = np.append(starts[1:], len(ids))
        self.lists = {t: (self.all_docs[a:b], self.all_impacts[a:b]) for t, a, b in zip(present.tolist(), starts, ends)}
        self.most = {t: int(impact.max()) for t, (_, impact) in self.lists.items()}
        self.pairs: dict[tuple[int, int], int] = {}

    def order_of(self, item: dict[int, int]) -> list[tuple[int, int]]:
        """The item's terms that some document holds, with their repeats, by growing bound"""
        held = [(t, q) for t, q in item.items() if self.most.get(t, 0) > 0]
        return sorted(held, key=lambda x: (self.most[x[0]] * x[1], x[0]))

    def prepare(self, items: list[dict[int, int]]) -> None:
        """Intersect the lists of neighbouring terms of all items and keep their joint largest impacts"""
        for item in items:
            order = self.order_of(item)
            for (t, _), (u, _) in zip(order[::2], order[1::2]):
                key = (min(t, u), max(t, u))
                if key not in self.pairs:
                    self.pairs[key] = self.joint(*key)

    def joint(self, t: int, u: int) -> int:
        (a, x), (b, y) = self.lists[t], self.lists[u]
        if len(a) > len(b):
            (a, x), (b, y) = (b, y), (a, x)
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        both = b[at] == a
        return int((x[both] + y[at[both]]).max()) if both.any() else 0

    def bounds(self, order: list[tuple[int, int]]) -> list[int]:
        """Entry i: what the first i terms can add to a document, pairs taken together"""
        out = [0]
        for i, (t, q) in enumerate(order):
            alone = out[-1] + self.most[t] * q
            if i % 2:
                u, p = order[i - 1]
                joint = self.pairs.get((min(t, u), max(t, u)), self.most[t] + self.most[u]) * max(p, q)
                pair = max(joint, self.most[t] * q, self.most[u] * p)
                alone = min(alone, out[i - 1] + pair)
            out.append(alone)
        return out

    def search(self, item: dict[int, int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the best ``k`` documents that score at least ``least``, best first"""
        order = self.order_of(item)
        bounds = self.bounds(order)
        scores = np.zeros(self.size, np.int64)
        some = None  # the documents that can still be among the best, once only they can
        for i in range(len(order) - 1, -1, -1):
            t, q = order[i]
            rows, impacts = self.lists[t]
            if some is None:
                if self.size > k:
                    least = max(least, int(np.partition(scores, self.size - k)[self.size - k]))
                if bounds[i + 1] < least:
                    some = np.flatnonzero(scores + bounds[i + 1] >= least)
                    scores = scores[some]
            if some is None:
                scores[rows] += impacts * q
                continue
            at = np.minimum(np.searchsorted(rows, some), len(rows) - 1)
            scores += np.where(rows[at] == some, impacts[at] * q, 0)
            if len(scores) > k:
                least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            open_ = scores + bounds[i] >= least
            some, scores = some[open_], scores[open_]
        if some is None:
            some = np.arange(self.size)
        good = scores >= max(least, 1)
        some, scores = some[good], scores[good]
        first = np.lexsort((some, -scores))[:k]
        return some[first], scores[first]


def best_of_runs(index: DataFrame, items, weights, n: int, length: int, k: int) -> DataFrame:
    """item (place), doc_id, score: the best ``k`` of every run; ``items`` and ``weights`` are broadcasts"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = items.value, weights.value
        least = [[] for _ in asked]  # the best scores seen in this task
        held, docs, count = [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                held.append(part)
                docs += part.num_rows
                count += len(part.column("ids").flatten())
                if docs >= RUN_DOCS or count >= RUN_POSTINGS:
                    yield from of_run(held, asked, w, least)
                    held, docs, count = [], 0, 0
        if held:
            yield from of_run(held, asked, w, least)

    def of_run(held, asked, w, least) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).sort_by([("doc_id", "ascending")])  # nulls last
        lists = table.column("ids").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        ids = lists.flatten().to_numpy()
        times = table.column("times").combine_chunks().flatten().to_numpy()
        rows = np.repeat(np.arange(table.num_rows), sizes)
        terms_of = table.column("n").to_numpy()
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * terms_of * n) // max(length, 1)
        impacts = w[ids] * ((SCALE * times) // (1000 * times + 12 * m[rows]))
        index = Run(rows, ids, impacts, table.num_rows)
        index.prepare(asked)
        places, found, scores = [], [], []
        for place, item in enumerate(asked):
            known = least[place]
            some, score = index.search(item, k, known[-1] if len(known) == k else 0)
            places += [place] * len(some)
            found.append(some)
            scores.append(score)
            least[place] = sorted([*known, *score.tolist()], reverse=True)[:k]
        rows = pa.array(np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64))
        doc_ids = table.column("doc_id").combine_chunks().take(rows)
        score = pa.array(np.concatenate([*scores, np.zeros(0, np.int64)]).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), doc_ids, score], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id long, score long")


def search_block(docs: DataFrame, asked: list, k: int) -> DataFrame:
    """The ranks of a block of items, given as (item_id, terms with repeats)"""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, held in asked for t in held}))}
    items = [{vocabulary[t]: q for t, q in held.items()} for _, held in asked]
    index = materialize(postings(docs, share(vocabulary)), "postings")
    n, length = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    # one row for each term of the block
    for number, df in index.select(F.explode("ids").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect():
        weights[number] = weight(n, df)
    found = best_of_runs(index, share(items), share(weights), n, length or 0, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(asked)], "item int, item_id long")
    # one row for each item of the block
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of each item (item_id, text)"""
    rows = items.select(F.col("item_id").cast("bigint"), "text").filter(F.col("text").isNotNull())
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // ITEM_CHARS))
    block: Column = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for i in range(blocks):
        # about ITEM_CHARS characters, whatever the number of items
        asked = [(r["item_id"], Counter(terms(r["text"]))) for r in rows.filter(block == i).collect()]
        asked = [(name, held) for name, held in asked if held]
        if asked:
            found = search_block(docs, asked, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), c AS (
  SELECT count(*) AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0
), q AS (
  SELECT i, item_id, term, count(*) AS repeats FROM (
    SELECT row_number() OVER () AS i, item_id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY ALL
), t AS (
  SELECT r, doc_id, len(terms)::BIGINT AS size, u.term, count(*)::BIGINT AS tf
  FROM d, unnest(terms) AS u(term) WHERE u.term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * c.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM t, c GROUP BY term, c.n
), p AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * c.n) // c.l))) AS impact
  FROM t JOIN w USING (term), c
), s AS (
  SELECT i, item_id, r, doc_id, sum(repeats * impact)::BIGINT AS score FROM p JOIN q USING (term) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""
