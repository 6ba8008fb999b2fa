import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.operators.joins import enrich, interval_join, point_lookup
from streammart.operators.skew import content_bytes, fits_broadcast, hot_keys, lookup_join

T0 = dt.datetime(2024, 1, 1, 10)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def frames(spark, orders, details):
    left = spark.createDataFrame(
        [(k, at(s)) for k, s in orders], "id BIGINT, t TIMESTAMP"
    )
    right = spark.createDataFrame(
        [(n, k, at(s)) for n, (k, s) in enumerate(details)],
        "line BIGINT, order_id BIGINT, lt TIMESTAMP",
    )
    return left, right


def test_interval_ends_are_included(spark):
    left, right = frames(spark, [(1, 0)], [(1, s) for s in (-6, -5, 0, 5, 6)])
    pairs = interval_join(left, right, ("id", "order_id"), ("t", "lt"), "-5 seconds", "5 seconds")
    assert rows(pairs, "line") == [(1,), (2,), (3,)]
    assert pairs.columns == ["id", "t", "line", "order_id", "lt"]


def test_interval_looking_back(spark):
    left, right = frames(spark, [(1, 900)], [(1, s) for s in (-1, 0, 900, 901)])
    pairs = interval_join(left, right, ("id", "order_id"), ("t", "lt"), "-15 minutes", "0 seconds")
    assert rows(pairs, "line") == [(1,), (2,)]


def test_interval_with_split_hot_key_is_exact(spark):
    rng = random.Random(5)
    orders = [(k, rng.randrange(100)) for k in range(30)]
    details = [(rng.choice([7] * 20 + list(range(35))), rng.randrange(100)) for _ in range(900)]
    left, right = frames(spark, orders, details)
    args = (("id", "order_id"), ("t", "lt"), "-9 seconds", "4 seconds")
    hot = hot_keys(right, ["order_id"], share=0.05, min_rows=20)
    assert [k for k, _ in hot] == [7] and hot[0][1] > 5
    split = rows(interval_join(left, right, *args, hot=hot), "id", "line")
    expected = sorted(
        (k, n) for k, s in orders for n, (d, ds) in enumerate(details)
        if d == k and s - 9 <= ds <= s + 4
    )
    assert split == expected == rows(interval_join(left, right, *args, hot=[]), "id", "line")


def test_hot_key_goes_to_many_tasks_even_if_rows_are_equal(spark):
    facts = spark.range(8000, numPartitions=8).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "dk INT, name STRING")
    hot = hot_keys(facts, ["k"], share=0.1, min_rows=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(facts, dim, {"k": "dk"}, small=False, hot=hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 8000
    assert len(sizes) > 1


@pytest.mark.parametrize("small", [True, False, None])
def test_enrich_keeps_rows_without_a_match(spark, small):
    facts = spark.createDataFrame(
        [(1, 7, "own"), (2, 99, "own"), (3, None, "own")], "n INT, sku BIGINT, sku_name STRING"
    )
    dim = spark.createDataFrame([(7, "seven", 3)], "id BIGINT, name STRING, spu BIGINT")
    out = enrich(facts, dim, {"sku": "id"}, {"name": "sku_name", "spu": "spu_id"}, small=small)
    assert rows(out.select("n", "sku_name", "spu_id")) == [
        (1, "seven", 3), (2, "own", None), (3, "own", None)
    ]


def test_left_join_with_hot_and_null_keys(spark):
    facts = spark.range(500).select(
        F.col("id").alias("n"),
        F.when(F.col("id") < 200, 1).when(F.col("id") < 400, None).otherwise(F.col("id")).alias("k"),
    )
    dim = spark.createDataFrame([(1, "a"), (450, "b")], "id BIGINT, name STRING")
    hot = hot_keys(facts, ["k"], share=0.01, min_rows=10)
    assert {k for k, _ in hot} == {1, None}
    out = enrich(facts, dim, {"k": "id"}, {"name": "name"}, small=False, hot=hot)
    assert out.count() == 500
    assert out.filter("name = 'a'").count() == 200
    assert out.filter("name = 'b'").count() == 1
    assert out.filter("k IS NULL AND name IS NULL").count() == 200


def test_several_key_columns(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "x INT, y STRING")
    dim = spark.createDataFrame([(1, "a", "hit")], "dx INT, dy STRING, v STRING")
    out = enrich(facts, dim, {"x": "dx", "y": "dy"}, {"v": "v"})
    assert rows(out) == [(1, "a", "hit"), (1, "b", None), (2, "a", None)]
    assert rows(point_lookup(dim, dx=1, dy="a"), "v") == [("hit",)]


def test_sizes_are_measured(spark):
    df = spark.createDataFrame([("abc", 1)] * 10, "s STRING, n BIGINT")
    assert content_bytes(df) == 10 * (16 + 3)
    assert fits_broadcast(df, 190) and not fits_broadcast(df, 189)


def test_small_tables_have_no_hot_keys(spark):
    assert hot_keys(spark.range(100), ["id"]) == []
