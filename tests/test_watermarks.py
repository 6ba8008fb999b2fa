"""Feeds of different pace, late rows, and restarts on streams."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.operators.windows import tumbling_agg, union_feeds
from streammart.plans.product_stats import product_measures
from streammart.sources.topics import Topics
from streammart.streaming.late import DroppedRows, LateRows

T0 = dt.datetime(2024, 1, 1, 12)
SCHEMA = "feed STRING, n INT, event_time TIMESTAMP"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


class Feeds:
    """Feeds as folders; ``step`` adds rows to each and runs the query over what is new."""

    def __init__(self, spark, path, names, make):
        self.spark, self.path, self.names, self.make = spark, path, names, make
        for name in names:
            self.add(name, [])

    def add(self, name, times):
        data = [(name, k, at(m)) for k, m in enumerate(times)]
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def step(self, **times):
        for name, of in times.items():
            self.add(name, of)
        feeds = [self.spark.readStream.schema(SCHEMA).parquet(f"{self.path}/{n}") for n in self.names]
        query = (
            self.make(feeds).writeStream.format("parquet").option("checkpointLocation", f"{self.path}/cp")
            .trigger(availableNow=True).start(f"{self.path}/out")
        )
        query.awaitTermination(120)
        assert query.exception() is None
        return query

    def out(self, *columns):
        return rows(self.spark.read.parquet(f"{self.path}/out"), *columns)


def by_feed(own):
    def make(feeds):
        return tumbling_agg(union_feeds(feeds, "1 minute", own), ["feed"], {"n": F.count(F.lit(1))}, "10 minutes")

    return make


@pytest.mark.parametrize("own", [True, False])
def test_a_feed_an_hour_behind(spark, tmp_path, own):
    feeds = Feeds(spark, str(tmp_path), ["fast", "slow"], by_feed(own))
    feeds.step(fast=[0, 5, 65, 70], slow=[0])
    feeds.step(fast=[130], slow=[5, 12, 14])
    feeds.step(fast=[200], slow=[70])
    feeds.step(fast=[300], slow=[300])
    feeds.step(fast=[301], slow=[301])
    found = {(f, s[11:16]): n for f, s, n in feeds.out("feed", "stt", "n")}
    fast = {("fast", "12:00"): 2, ("fast", "13:00"): 1, ("fast", "13:10"): 1, ("fast", "14:10"): 1, ("fast", "15:20"): 1}
    slow = {("slow", "12:00"): 2, ("slow", "12:10"): 2, ("slow", "13:10"): 1}
    if own:
        assert found == fast | slow, "the slow feed loses nothing"
    else:
        assert {k: v for k, v in found.items() if k[0] == "fast"} == fast
        assert ("slow", "12:10") not in found, "the fast feed's watermark drops it"


def test_distinct_orders_in_two_steps_equal_batch(spark, tmp_path):
    schema = "sku_id BIGINT, order_id BIGINT, amount DECIMAL(10,2), event_time TIMESTAMP"
    data = [(s, o, Decimal(a), at(m)) for s, o, a, m in [
        (1, 10, 1, 0), (1, 10, 2, 1), (1, 11, 3, 2), (2, 10, 4, 2), (1, 10, 5, 12), (1, None, 6, 3), (None, 9, 7, 3), (3, 30, 8, 25)]]
    orders = spark.createDataFrame(data, schema)
    end = spark.createDataFrame([(99, 99, Decimal(0), at(900))], schema)
    favors = spark.createDataFrame([(1, None, None, at(4)), (4, None, None, at(5)), (99, None, None, at(900))], schema)
    measure = lambda o, f, **how: product_measures(
        [(f, {"favor_ct": F.lit(1)}), (o, {"order_amount": F.col("amount"), "order_id": F.col("order_id")}),
         (o, {"payment_amount": F.col("amount"), "paid_order_id": F.col("order_id")})], "10 minutes", **how)
    for name, df in (("o", orders.unionByName(end)), ("f", favors)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    for own in (True, False):
        for single in (True, False):
            stream = measure(*[spark.readStream.schema(schema).parquet(f"{tmp_path}/{n}") for n in "of"], single_row_zero=single, own_watermarks=own)
            out = f"{tmp_path}/out{own}{single}"
            query = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}-cp").trigger(availableNow=True).start(out)
            query.awaitTermination(120)
            assert query.exception() is None
            expected = measure(orders, favors, single_row_zero=single).filter("sku_id <> 99")
            assert rows(spark.read.parquet(out), *expected.columns) == rows(expected)


LATE = [  # Minutes of the rows of three micro-batches; 12:00 to 12:10 ends for good once 12:16 has been seen.
    [1, 5, 16], [2, 9, 17, 40], [3, 19, 29, 41, 33, 200],
]


def test_late_rows_are_set_aside(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"), checkpoints=str(tmp_path / "c"))
    late = LateRows(str(tmp_path / "marks"), "10 minutes", "5 minutes")
    listener = DroppedRows()
    spark.streams.addListener(listener)
    value = F.to_json(F.struct("feed", "n", "event_time")).alias("value")

    def write(on_time, aside, batch_id):
        both = on_time.select(F.lit("on_time").alias("topic"), value).unionByName(aside.select(F.lit("late").alias("topic"), value))
        topics.put(both, "part", batch_id)

    def count(topic, name):
        rows_in = topics.read(spark, topic).select(F.from_json("value", SCHEMA).alias("r")).select("r.*")
        windows = tumbling_agg(rows_in, [], {"n": F.count(F.lit(1))}, "10 minutes", delay="5 minutes")
        query = (
            windows.writeStream.queryName(name).format("parquet").option("checkpointLocation", f"{tmp_path}/{name}-cp")
            .trigger(availableNow=True).start(f"{tmp_path}/{name}")
        )
        query.awaitTermination(120)
        assert query.exception() is None

    try:
        for k, minutes in enumerate(LATE):
            data = spark.createDataFrame([("f", n, at(m)) for n, m in enumerate(minutes)] + ([("f", 99, None)] if k == 1 else []), SCHEMA)
            data.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            topics.put(data.select(F.lit("raw").alias("topic"), value), "raw", k)
            stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
            query = (
                stream.writeStream.foreachBatch(late.writer(write)).option("checkpointLocation", f"{tmp_path}/part-cp")
                .trigger(availableNow=True).start()
            )
            query.awaitTermination(120)
            assert query.exception() is None
            count("on_time", "kept")
            count("raw", "dropping")
        end = spark.createDataFrame([("f", 0, at(9000))], SCHEMA).select(value)
        for topic in ("on_time", "raw"):
            topics.put(end.select(F.lit(topic).alias("topic"), "value"), f"end-{topic}", 0)
        count("on_time", "kept")
        count("raw", "dropping")
    finally:
        spark.streams.removeListener(listener)
    aside = topics.read(spark, "late", False).select(F.from_json("value", SCHEMA).alias("r")).select("r.n", "r.event_time")
    assert rows(aside) == [(0, at(2)), (0, at(3)), (1, at(9)), (1, at(19)), (2, at(29)), (99, None)]
    windows = {r["stt"]: r["n"] for r in spark.read.parquet(f"{tmp_path}/kept").collect()}
    assert sum(windows.values()) + 6 == sum(map(len, LATE)) + 1, "rows in = rows in windows + rows set aside"
    fewer = {r["stt"]: r["n"] for r in spark.read.parquet(f"{tmp_path}/dropping").collect()}
    assert fewer == windows, "what is set aside is what Spark would drop"
    assert listener.dropped["kept"] == 0 and listener.dropped["dropping"] >= 1


def test_a_repeated_micro_batch_is_parted_as_before(spark, tmp_path):
    late, seen = LateRows(str(tmp_path), "10 minutes", "0 minutes"), []
    run = late.writer(lambda on_time, aside, batch_id: seen.append((batch_id, rows(on_time, "n"), rows(aside, "n"))))
    batch = lambda *minutes: spark.createDataFrame([("f", m, at(m)) for m in minutes], SCHEMA)
    run(batch(5), 0)
    run(batch(3, 25), 1)
    run(batch(3, 25), 1)
    run(batch(4, 26), 2)
    assert seen == [(0, [(5,)], []), (1, [(3,), (25,)], []), (1, [(3,), (25,)], []), (2, [(26,)], [(4,)])]
