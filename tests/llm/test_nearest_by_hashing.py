"""Recall of the hashing alone, without the bucket of long vectors, and how much of a table a query compares."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import ann
from llm.tables import stored, table


def made(kind, n):
    draw = np.random.default_rng(n)
    if kind == "uniform":
        x = draw.normal(size=(n, 64))
    else:
        x = draw.normal(size=(200, 64))[draw.integers(0, 200, n)] + 0.7 * draw.normal(size=(n, 64))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def recall(out, x, ids):
    place, hit, asked = {v: k for k, v in enumerate(ids)}, 0, 0
    for query, found in out.groupby("query_id"):
        score = x @ x[place[query]]
        score[place[query]] = -np.inf
        hit += len(set(ids[np.lexsort((ids, -score))[:20]]) & set(found.vec_id))
        assert list(found.sort_values("rank")["rank"]) == list(range(1, 21))
        asked += 20
    return hit / asked


@pytest.mark.parametrize("kind,n", [("sf0.01", 0), ("sf0.1", 0), ("clustered", 20_000), ("uniform", 10_000)])
def test_hashing_alone(spark, kind, n):
    if n:
        x = made(kind, n).astype(float)
        ids = np.arange(n)
        df = stored(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x.astype(np.float32))], "vec_id BIGINT, embedding ARRAY<FLOAT>"))
    else:
        df = table(spark, f"/root/testdata/{kind}", "embeddings")
        known = df.where("embedding IS NOT NULL").toPandas()
        x, ids = np.array(known.embedding.tolist(), float), known.vec_id.to_numpy()
    every = 200 if n else 20
    out = ann.search(df, F.col("vec_id") % every == 0, longest=0.0).toPandas()
    assert recall(out, x, ids) >= 0.9


def test_unit_vectors_have_no_longest(spark):
    x = made("uniform", 2000)
    norms = np.linalg.norm(x.astype(float), axis=1)
    assert norms.max() > np.quantile(norms, 15 / 16) * (1 + 1e-9), "they differ by rounding"
    assert norms.max() <= np.quantile(norms, 15 / 16) * (1 + ann.ROUNDING)


def test_axes_fall_with_size_and_cover_small_tables():
    axes = [ann.probed_axes(10**k) for k in range(9)]
    assert axes == sorted(axes, reverse=True) and axes[0] >= 50 and axes[8] >= 3


def test_bounds_hold():
    draw = np.random.default_rng(2)
    q, p = (v / np.linalg.norm(v, axis=1)[:, None] for v in draw.normal(size=(2, 4000, 33)))
    q[:5, 1:], p[:5, 1:] = 1e-9, 1e-9
    rough = (q.astype(np.float16).astype(np.float32) * p.astype(np.float16).astype(np.float32)).sum(1)
    assert (np.abs(rough - (q * p).sum(1)) <= ann.HALF).all()


def test_ties_beyond_what_a_cell_keeps(spark):
    """A hundred different vectors with one score each: the smallest ids win."""
    made = [(0, [1.0] + [0.0] * 100)] + [(k, [0.5] + [float(j == k) for j in range(1, 101)]) for k in range(100, 0, -1)]
    df = spark.createDataFrame(made, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    out = ann.search(df, F.col("vec_id") == 0).toPandas().sort_values("rank")
    assert list(out.vec_id) == list(range(1, 21)) and set(out.score) == {0.5}


def test_best_lists_are_merged():
    best = ann._Best(2)
    best.add(np.array([1, 1, 1, 1]), np.array([5, 6, 7, 8]), np.array([0.1, 0.5, 0.4, 0.45]), np.array([0.12, 0.52, 0.42, 0.47]))
    best.add(np.array([1, 2]), np.array([6, 5]), np.array([0.5, 0.0]), np.array([0.52, 0.02]))
    query, point, *_ = best.kept()
    assert list(zip(query, point)) == [(1, 6), (1, 8), (1, 7), (2, 5)]
