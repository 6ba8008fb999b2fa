"""What a query finds does not hang on how many other rows the table has."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from llm import ann


def test_rows_far_from_all_queries_change_nothing(spark):
    draw = np.random.default_rng(7)
    near, far = np.zeros((300, 64)), np.zeros((6000, 64))
    near[:, :32], far[:, 32:] = draw.normal(size=(300, 32)), draw.normal(size=(6000, 32))
    x = np.concatenate([near, far])
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]

    def found(rows):
        df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
        out = ann.search(df, (F.col("vec_id") < 300) & (F.col("vec_id") % 5 == 0), longest=0.0)
        return sorted(tuple(r) for r in out.collect())

    assert found(rows[:300]) == found(rows)
