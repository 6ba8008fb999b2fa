"""Joins and windows a micro-batch at a time: the rows of Spark's own stateful operators, without its state store."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.operators.joins import interval_join
from streammart.plans.product_stats import MEASURED, measure_rows, product_measures
from streammart.streaming.batches import Kept, interval_join_batches, tagged, window_batches
from streammart.workload import streams

SMALL = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)
ORDER, LINE = "id BIGINT, t TIMESTAMP", "of BIGINT, lt TIMESTAMP, n INT"


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def feed(spark, folder, schema, parts):
    """A stream, and what adds a part of its rows."""
    place = f"{folder}/in"
    os.makedirs(place)
    add = lambda k: spark.createDataFrame(parts[k], schema).coalesce(1).write.mode("append").parquet(place)
    return spark.readStream.schema(schema).parquet(place), add


def run(stream, folder, each=None):
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").start(f"{folder}/out")
    query.awaitTermination()


def run_parts(adds, *how):
    """A restart before every part, so that Spark's watermark moves before the next."""
    for k in range(4):
        for add in adds:
            add(k)
        run(*how)


@pytest.fixture
def feeds(spark, tmp_path):
    """Four micro-batches: pairs within one and across two, rows too late, times and keys that are null, copies."""
    orders = [
        [(1, at(0)), (2, at(1)), (2, at(1)), (3, None), (None, at(2))],
        [(4, at(10)), (5, at(11))],
        [(6, at(30)), (7, at(3)), (8, at(29))],
        [(9, at(60)), (6, at(20))],
    ]
    lines = [
        [(1, at(2), 1), (1, at(6), 2), (4, at(8), 3), (2, at(0), 4), (None, at(2), 5), (3, None, 6)],
        [(2, at(5), 7), (2, at(7), 8), (5, at(12), 9), (1, at(4), 10)],
        [(4, at(11), 11), (5, at(16), 12), (6, at(31), 13), (8, at(31), 14), (7, at(3), 15)],
        [(6, at(35), 16), (9, at(58), 17), (1, at(1), 18), (8, at(33), 19)],
    ]
    return lambda name: (feed(spark, f"{tmp_path}/{name}-o", ORDER, orders), feed(spark, f"{tmp_path}/{name}-l", LINE, lines))


def test_pairs_are_those_of_the_stream_join(spark, tmp_path, feeds):
    bounds = {"lower": "-5 minutes", "upper": "5 minutes"}
    how = (("id", "of"), ("t", "lt"))
    (one, add_one), (many, add_many) = feeds("native")
    run_parts([add_one, add_many], interval_join(one, many, *how, **bounds), f"{tmp_path}/native")
    expected = rows(spark.read.schema(f"{ORDER}, {LINE}").parquet(f"{tmp_path}/native/out"))
    assert len(expected) > 8

    found, failed, kept = {}, [], Kept(f"{tmp_path}/kept")
    (one, add_one), (many, add_many) = feeds("batches")
    stream = tagged({"orders": (one, "t"), "lines": (many, "lt")})

    def write(pairs, batch_id):
        found[batch_id] = rows(pairs)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost in the middle")

    each = interval_join_batches(lambda o, d: interval_join(o, d, *how, hot=[], **bounds), write, kept, ("orders", "t"), ("lines", "lt"), **bounds)
    for k in range(4):
        add_one(k)
        add_many(k)
        if k == 2:
            with pytest.raises(Exception, match="lost in the middle"):
                run(stream, f"{tmp_path}/batches", each)
        run(stream, f"{tmp_path}/batches", each)
    assert sorted(found) == [0, 1, 2, 3]
    assert sorted((r for part in found.values() for r in part), key=lambda t: [(x is None, x) for x in t]) == expected
    # The slowest feed has come to 58 minutes; only what can meet a later row is kept, and only by the last micro-batches.
    assert sorted(os.listdir(f"{tmp_path}/kept")) == ["2", "3"]
    left = spark.read.parquet(f"{tmp_path}/kept/3/rows")
    assert rows(left.select(F.coalesce("orders.id", "lines.of"))) == [(9,), (9,)]


def test_windows_are_those_of_the_stream_aggregates(spark, tmp_path):
    schema = "sku_id BIGINT, event_time TIMESTAMP, order_id BIGINT, total_amount DECIMAL(16,2), sku_num BIGINT"
    sold = [
        [(1, at(0), 7, 2, 1), (1, at(1), 7, 3, 1), (1, at(2), 8, 5, 2), (2, at(9), 9, 1, 1), (None, at(3), 9, 1, 1), (1, None, 9, 1, 1)],
        [(1, at(4), 8, 5, 2), (1, at(25), 8, 5, 2), (2, at(31), None, None, 1), (5, at(2), 1, None, 1)],
        [(1, at(5), 9, 100, 1), (1, at(26), 8, 1, 1), (3, at(47), 5, 1, 1)],
        [(1, at(90), 9, 1, 1)],
    ]
    faved = [[(1, at(0)), (1, at(15))], [(2, at(12)), (1, at(22))], [(1, at(3)), (3, at(41))], [(1, at(95))]]
    sold = [[(*r[:3], None if r[3] is None else Decimal(r[3]), r[4]) for r in part] for part in sold]

    def feeds(name):
        lines, add_line = feed(spark, f"{tmp_path}/{name}-s", schema, sold)
        favors, add_favor = feed(spark, f"{tmp_path}/{name}-f", "sku_id BIGINT, event_time TIMESTAMP", faved)
        measured = {"order_amount": F.col("total_amount"), "order_sku_num": F.col("sku_num"), "order_id": F.col("order_id")}
        return [(lines, measured), (favors, {"favor_ct": F.lit(1)})], [add_line, add_favor]

    both, adds = feeds("native")
    native = product_measures(both, "10 minutes", "1 minute", own_watermarks=True)
    run_parts(adds, native, f"{tmp_path}/native")
    shown = ["stt", "sku_id", "order_ct", "order_sku_num", "favor_ct", "order_amount"]
    picked = lambda df: rows(df, *shown)
    expected = picked(spark.read.schema(native.schema).parquet(f"{tmp_path}/native/out"))
    assert len(expected) > 5

    found = {}
    both, adds = feeds("batches")
    named = {f"f{k}": df for k, df in enumerate(measure_rows(both))}
    stream = None
    for name, df in named.items():
        one = df.withColumn("_feed", F.lit(name))
        stream = one if stream is None else stream.unionByName(one)
    measure = lambda ended: product_measures([(ended, {n: F.col(n) for n in MEASURED})], "10 minutes", micro_batch=True)
    each = window_batches(measure, lambda df, n: found.update({n: picked(df)}), Kept(f"{tmp_path}/kept"), named, "10 minutes", "1 minute")
    run_parts(adds, stream, f"{tmp_path}/batches", each)
    assert sorted((r for part in found.values() for r in part), key=lambda t: [(x is None, x) for x in t]) == expected
    assert sum(map(bool, found.values())) > 1, "windows end in several micro-batches"


def test_registered_streams_of_orders_keep_no_row_in_a_state_store(spark):
    """a state store looked up and wrote every line and every order, one after the other."""
    places = []
    made = streams.Run.__init__

    def noted(self, *a):
        made(self, *a)
        places.append(self.folder)

    streams.Run.__init__ = noted
    try:
        for name in ("stream_order_wide", "stream_payment_wide", "stream_product_stats"):
            assert streams.STREAMS[name](spark, SMALL).count() > 0
    finally:
        streams.Run.__init__ = made
    assert len(places) == 3
    assert not [f for place in places for f, *_ in os.walk(place) if "/state" in f.removeprefix(place)]
