"""The neighbour index: exact when all lists are searched, recall otherwise, equal and unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.operators import neighbors

SCHEMA = "item long, v array<double>"


def exact(rows, k):
    sound = {i: np.floor(np.array(v) / np.sqrt(np.dot(v, v)) * neighbors.SCALE) for i, v in rows}
    out = set()
    for i, u in sound.items():
        scored = sorted((-int(u @ x), j) for j, x in sound.items() if j != i)[:k]
        out |= {(i, j, -s) for s, j in scored}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(6, 8))
    out = [(i, (centers[i % 6] + 0.3 * rng.normal(size=8)).tolist()) for i in range(300)]
    return out + [(1000 + i, [1.0] * 8) for i in range(150)]  # a third share one vector


def test_all_lists_give_exact_neighbors(spark, rows, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 16)
    odd = [(5000, None), (5001, []), (5002, [0.0] * 8), (5003, [float("nan")] * 8), (None, [1.0] * 8), (5004, [1.0])]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = neighbors.nearest(df, "item", "v", k=4, share=1.0, lists=9)
    assert {tuple(r) for r in got.collect()} == exact(rows, 4)
    assert got.columns == ["item", "neighbor", "score"]


def test_clustered_vectors_need_few_lists(spark, rows):
    df = spark.createDataFrame(rows[:300], SCHEMA)
    want = {(i, j) for i, j, _ in exact(rows[:300], 4)}
    got = {(r["item"], r["neighbor"]) for r in neighbors.nearest(df, "item", "v", k=4, share=0.2, rounds=3).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_recall_on_the_given_vectors(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/embeddings.parquet")
    found = neighbors.nearest(items, "vec_id", "embedding").select("vec_id", "neighbor")
    want = neighbors.nearest(items, "vec_id", "embedding", share=1.0).select("vec_id", "neighbor")
    assert found.join(want, ["vec_id", "neighbor"]).count() >= 0.9 * want.count()
    assert found.join(items.select(F.col("vec_id").alias("neighbor")), "neighbor", "left_anti").count() == 0


def test_no_vectors(spark):
    assert neighbors.nearest(spark.createDataFrame([], SCHEMA), "item", "v").count() == 0
    assert neighbors.nearest(spark.createDataFrame([(1, [1.0])], SCHEMA), "item", "v").count() == 0


def test_a_row_is_not_repeated_for_every_list_it_asks(spark, rows):
    units = neighbors.unit_vectors(spark.createDataFrame(rows[:300], SCHEMA), "item", "v")
    classes = units.select(F.col("id").alias("cls"), F.col("id").alias("first"), "u")
    centroids = np.array([r["u"] for r in units.limit(9).collect()], np.float64)
    sent = neighbors.in_lists(classes, centroids, 6).collect()
    assert len(sent) == 300
    assert {int(np.unpackbits(np.frombuffer(r["asked"], np.uint8)).sum()) for r in sent} == {6}


def test_single_precision_does_not_decide(spark):
    """Products that single precision can't tell apart, over several blocks of data"""
    rng = np.random.default_rng(2)
    near = [(i, (1000 + rng.normal(size=64) * 0.3).tolist()) for i in range(3000)]
    got = neighbors.nearest(spark.createDataFrame(near, SCHEMA), "item", "v", k=5, share=1.0, lists=4)
    u = np.stack([np.floor(np.array(v) / np.sqrt(np.dot(v, v)) * neighbors.SCALE) for _, v in near])
    products = (u @ u.T).astype(np.int64)
    np.fill_diagonal(products, 0)
    best = np.argsort(-products, axis=1, kind="stable")[:, :5]
    want = {(i, int(j), int(products[i, j])) for i in range(3000) for j in best[i]}
    found = {tuple(r) for r in got.collect()}
    assert len(found - want) <= 0.001 * len(want)  # Spark and numpy may floor a cell apart
