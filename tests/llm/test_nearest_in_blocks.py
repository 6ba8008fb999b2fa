"""The blocks of the search: what a task keeps of what meets, and how often a vector travels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm import ann


def placed(x, probes):
    """Rows as a task gets them."""
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(list(x))], ["id", "vector"])
    rows = pa.Table.from_batches(list(ann._hashed(x.shape[1], ann.TABLES, probes)(iter([batch]))))
    return rows.append_column("far", pa.array(np.zeros(len(x), bool)))


def test_a_block_keeps_what_can_be_nearest_and_no_more(monkeypatch):
    """Most pairs that meet are dropped at once; the best of those that meet in a bucket are all there (F1)."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(5000, 64))
    x *= (draw.uniform(0.5, 2, len(x)) / np.linalg.norm(x, axis=1))[:, None]
    asked = x[::20]
    points, queries = placed(x, 0), placed(asked, ann.PROBES)
    added = []
    add = ann._Best.add
    monkeypatch.setattr(ann._Best, "add", lambda self, *c: added.append(len(c[0])) or add(self, *c))
    out = ann._Block(points, queries, ann.TABLES, 20).met()
    matrix = lambda rows, name: np.array([list(b) for b in rows[name].to_pylist()]).reshape(len(rows), ann.TABLES, -1)
    p1, p2, q1, q2 = (matrix(r, c) for r in (points, queries) for c in ("firsts", "seconds"))
    pairs, found = 0, set(zip(out["query_id"].to_pylist(), out["id"].to_pylist()))
    for q in range(len(asked)):
        meets = ((p1 == q1[q]).any(2) & (p2 == q2[q]).any(2)).sum(1)
        pairs += meets.sum()
        score = np.where(meets > 0, x @ asked[q], -np.inf)
        assert {(q, p) for p in np.argsort(-score)[:21]} <= found
    assert sum(added) < pairs / 3 and len(found) < 40 * len(asked)


def test_a_vector_travels_once_per_block(spark, monkeypatch):
    """The search moves no vector once per table or bucket, and blocks do not change what is found (F1)."""
    draw = np.random.default_rng(4)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(draw.normal(size=(1200, 16)))], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = lambda: sorted(tuple(r) for r in ann.search(df, F.col("vec_id") % 20 == 0).collect())
    whole = found()
    moved = spark.sparkContext.accumulator(0)
    meet = ann._meet

    def counted(*how):
        run = meet(*how)

        def rows(batches):
            for batch in batches:
                moved.add(batch.num_rows)
                yield batch

        return lambda batches: run(rows(batches))

    monkeypatch.setattr(ann, "_meet", counted)
    monkeypatch.setattr(ann, "BLOCK_POINTS", (300, 300))
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 25)
    assert found() == whole
    # 1,200 points meet 3 blocks of queries, 60 queries meet 4 blocks of points.
    assert moved.value == 1200 * 3 + 60 * 4
