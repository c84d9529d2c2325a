"""Hard negatives and ranked lexical search against brute force, with odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import lexical, negatives

ROWS = "vec_id long, embedding array<double>, label int, v string, cls string"


def mined(rows, every=10, positives=5, negs=10, low=30, high=90, scale=256):
    """The definition, row by row"""
    sound = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        sound[i, label, tuple(math.floor(scale * x) for x in v)] = None
    out = set()
    for a, la, va in sound:
        if a % every:
            continue
        score = [(-sum(x * y for x, y in zip(va, vb)), b, lb) for b, lb, vb in sound if b != a]
        same = sorted(x for x in score if x[2] == la)[:positives]
        for p, pid, _ in same:
            window = sorted(x for x in score if x[2] != la and low * -p <= 100 * -x[0] <= high * -p)[:negs]
            out |= {(a, pid, r + 1, x[1], -p, -x[0]) for r, x in enumerate(window)}
    return out


def as_set(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return {tuple(r[n] for n in names) for r in df.collect()}


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        v = [rng.gauss(0, 1) + (1 if d == i % 3 else 0) for d in range(12)]
        rows.append((i, [x / 4 for x in v], i % 3, "x", None))
    hot = [0.5] * 12
    rows += [(1000 + i, hot, i % 2, "x", None) for i in range(200)]  # a third of all rows
    rows += [(2000 + i, [0.25] * (i % 5), 1, None, "y") for i in range(20)]  # other lengths, empty ones
    rows += [(3000, None, 1, "n", "n"), (3010, [1.0] * 12, None, "n", "n"), (None, [1.0] * 12, 1, "n", "n")]
    rows += [(3020, [float("nan")] * 12, 1, "n", "n"), (3030, [None] * 12, 1, "n", "n"), (3040, [float("inf")], 1, "", "")]
    rows += [(4000, [0.0] * 12, 7, "lone label", ""), (4010, [-1.0] * 12, 8, "", ""), (4011, [1.0] * 12, 8, "", "")]
    return rows + rows[:30]


def test_hard_negatives_against_brute_force(spark, vectors):
    df = spark.createDataFrame(vectors, ROWS)
    got = negatives.mine(df, F.col("vec_id") % 10 == 0)
    rows = as_set(got)
    assert rows == mined(vectors) and got.count() == len(rows) > 1000


def test_other_windows_and_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(negatives, "CELLS", 12 * 64)
    monkeypatch.setattr(negatives, "ANCHORS", 16)
    df = spark.createDataFrame(vectors, ROWS)
    got = negatives.mine(df, F.col("vec_id") % 20 == 0, positives=2, negatives=30, low=0, high=100, scale=16)
    assert as_set(got) == mined(vectors, 20, 2, 30, 0, 100, 16)


def test_no_rows_to_mine(spark):
    assert negatives.mine(spark.createDataFrame([], ROWS), F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1, "", "")], ROWS)
    assert negatives.mine(one, F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("share", [-2.0, 0.0, 0.1, 0.3, 0.6])
def test_index_loses_no_pair(share):
    rng = np.random.default_rng(3)
    x = rng.integers(-100, 100, (300, 40)) * (rng.random((300, 40)) < 0.7)
    x[:5] = 0
    a = rng.integers(-100, 100, (50, 40))
    norms = np.sqrt((a**2).sum(1))
    least = share * norms * np.sqrt((x**2).sum(1)).max() * rng.uniform(0.5, 1, 50)
    index = negatives.Index(x, negatives.reach(a, least))
    allowed = rng.random((300, 50)) < 0.8
    found = list(index.search(a, least, allowed))
    got = {(int(r), int(c), int(s)) for part in found for r, c, s in zip(*part)}
    scores = x @ a.T
    want = {(int(r), int(c), int(scores[r, c])) for r, c in zip(*np.nonzero(allowed & (scores >= least[None, :])))}
    assert got == want
    if share > 0:
        assert sum(map(len, index.rows)) < np.count_nonzero(x)


DOCS = "doc_id long, text string, item string, n string, ids string"


def ranked(docs, items, k=20):
    term = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    held = [(i, Counter(term.findall(low(t)))) for i, t, *_ in docs]
    n = sum(1 for _, c in held if c)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            s = 0
            for t in term.findall(low(text)):
                if c[t]:
                    m = 75 + (25 * sum(c.values()) * n) // length
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    s += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if s > 0:
                scored.append((-s, i is None, i))
        top = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(top)]
    return sorted(out, key=str)


def test_lexical_search_against_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "a_b", "KelvinK", "x-y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 40))), "", "", "") for i in range(150)]
    docs += [(150 + i, "W1 w2 w3", "", None, "") for i in range(60)]  # ties beyond the ranks returned
    docs += docs[:5] + [(None, "w1 w2 W40", "", "", ""), (900, None, "", "", ""), (901, "", "", "", ""), (902, "., !", "", "", "")]
    docs += [(903, " ".join(rng.choices(words, k=200_000)), "", "", "")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "unknown words"), (3, "w1 w1 w1 w2"), (None, "w5 w6"), (34, "w1 w2 w3")]
    got = lexical.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == ranked(docs, items)


def test_items_in_blocks(spark, monkeypatch):
    docs = [(i, f"a{i % 7} b{i % 3} c", "", "", "") for i in range(40)]
    items = [(i, f"a{i} b{i} c{i} c") for i in range(9)]
    monkeypatch.setattr(lexical, "ITEM_CHARS", 30)
    got = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == ranked(docs, items)


def test_lexical_search_without_rows(spark):
    none, item = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(none, item).count() == 0
    assert lexical.search(none, item.limit(0)).count() == 0


def test_skipping_run_equals_plain_sums():
    rng = np.random.default_rng(8)
    n, kinds, k = 500, 30, 7
    held = rng.random((n, kinds)) < np.linspace(0.02, 0.9, kinds)
    impacts = np.where(held, rng.integers(1, 100, (n, kinds)) * np.linspace(50, 1, kinds).astype(int), 0)
    rows, ids = np.nonzero(held)
    run = lexical.Run(rows, ids, impacts[held], n)
    items = [dict(Counter(rng.integers(0, kinds + 2, rng.integers(1, 12)).tolist())) for _ in range(200)]
    run.prepare(items)
    tighter = 0
    for item in items:
        order = run.order_of(item)
        tighter += run.bounds(order)[-1] < sum(run.most[t] * q for t, q in order)
        want = sum((impacts[:, t] * q for t, q in item.items() if t < kinds), np.zeros(n, np.int64))
        assert run.bounds(order)[-1] >= want.max()
        best = sorted((-s, i) for i, s in enumerate(want.tolist()) if s > 0)[:k]
        some, scores = run.search(item, k, 0)
        assert list(zip((-scores).tolist(), some.tolist())) == best
        if len(best) == k:
            some, scores = run.search(item, k, -best[-1][0])
            assert list(zip((-scores).tolist(), some.tolist())) == best
    assert tighter > 50
