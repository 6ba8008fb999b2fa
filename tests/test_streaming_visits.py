"""Streaming forms against batch forms, over files that arrive one by one."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.operators.visits import daily_unique_visits, detect_bounces, repair_is_new
from streammart.streaming.visits import (
    daily_unique_visits_stream,
    detect_bounces_stream,
    mark_newcomers,
    repair_is_new_stream,
    repair_marked,
)

SCHEMA = "id BIGINT, mid STRING, last_page_id STRING, is_new STRING, event_time TIMESTAMP"
T0 = dt.datetime(2024, 1, 1)


def log(spark, records):
    data = [
        (i, mid, last, new, T0 + dt.timedelta(seconds=s))
        for i, (mid, last, new, s) in enumerate(records)
    ]
    return spark.createDataFrame(data, SCHEMA)


def run(spark, tmp_path, files, transform):
    """Run a stream over one file per micro-batch and return its whole output."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for df in files:
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        query = (
            transform(stream)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination(120)
        assert not query.isActive and query.exception() is None
    return spark.read.parquet(out)


RECORDS = [
    ("m", None, "1", 1), ("m", "", "1", 3), ("m", "home", "0", 5), ("n", None, "1", 7),
    ("m", None, "1", 30), ("m", "home", "1", 40), ("k", None, "0", 41), ("k", "a", "0", 50),
    ("k", None, "1", 60), ("k", "a", "1", 70), ("h", None, "1", 90000), ("m", None, "1", 90001),
]
END = [("zz", "x", "0", 900000)]


@pytest.fixture()
def parts(spark):
    whole = log(spark, RECORDS + END)
    return whole, [whole.filter("id < 5"), whole.filter("id BETWEEN 5 AND 8"), whole.filter("id > 8")]


def test_bounces_stream_equals_batch(spark, tmp_path, parts):
    whole, files = parts
    expected = rows(detect_bounces(whole, "id"), "mid", "id")
    assert expected == [("h", 10), ("k", 8), ("m", 4), ("m", 11), ("n", 3)]
    found = run(spark, tmp_path, files, lambda df: detect_bounces_stream(df, "id"))
    assert rows(found, "mid", "id") == expected
    assert found.schema["event_time"].dataType == whole.schema["event_time"].dataType


def test_bounces_stream_same_in_one_batch(spark, tmp_path, parts):
    whole, _ = parts
    expected = rows(detect_bounces(whole, "id"))
    found = run(spark, tmp_path, [whole], lambda df: detect_bounces_stream(df, "id"))
    assert rows(found) == expected


def test_repair_stream_equals_batch(spark, tmp_path, parts):
    whole, files = parts
    order = ["event_time", "id"]
    expected = rows(repair_is_new(whole, order), "id", "is_new")
    found = run(spark, tmp_path, files, lambda df: repair_is_new_stream(df, order))
    assert rows(found, "id", "is_new") == expected


def test_daily_unique_stream_equals_batch(spark, tmp_path, parts):
    whole, files = parts
    expected = rows(daily_unique_visits(whole, ["id"]), "mid", "visit_date")
    found = run(spark, tmp_path, files, daily_unique_visits_stream)
    assert rows(found, "mid", "visit_date") == expected
    assert found.filter(F.col("mid") == "zz").count() == 0


def test_restart_does_not_repeat(spark, tmp_path, parts):
    whole, files = parts
    found = run(spark, tmp_path, [*files[:2]], daily_unique_visits_stream)
    before = found.count()
    query = (
        daily_unique_visits_stream(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == before


def test_marked_repair_equals_stream_repair(spark, tmp_path, parts):
    """Repaired micro-batch by micro-batch, with a restart before each, and nothing of it in Python."""
    whole, files = parts
    files[1] = files[1].unionByName(log(spark, [(None, None, "1", 8), ("q", None, None, 9)]).withColumn("id", F.col("id") + 100))
    order = ["event_time", "id"]
    expected = rows(run(spark, tmp_path / "stream", files, lambda df: repair_is_new_stream(df.filter("mid IS NOT NULL"), order)), "id", "mid", "is_new")
    source, plans = str(tmp_path / "in"), []

    def write(batch, batch_id):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        batch.persist()
        repair_marked(batch, order).write.mode("overwrite").parquet(str(tmp_path / f"out/batch={batch_id}"))
        batch.unpersist()

    for df in files:
        df.coalesce(1).write.mode("append").parquet(source)
        stream = mark_newcomers(spark.readStream.schema(SCHEMA).parquet(source)).writeStream.foreachBatch(write)
        stream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    found = rows(spark.read.parquet(str(tmp_path / "out")), "id", "mid", "is_new")
    assert [r for r in found if r[1] is not None] == expected and (100, None, "1") in found
    assert len(found) == len(expected) + 1 == whole.count() + 2


def test_log_base_keeps_its_rows_out_of_python(spark, tmp_path):
    from streammart.sources.topics import Topics
    from streammart.streaming.jobs import Warehouse, log_base

    topics = Topics(root=str(tmp_path / "topics"), checkpoints=str(tmp_path / "cp"))
    value = '{"common": {"mid": "m", "is_new": "1"}, "page": {"page_id": "home"}, "ts": %d}'
    topics.put(spark.createDataFrame([("ods_base_log", value % t) for t in (2, 1, 3)], "topic STRING, value STRING"), "client", 0)
    query = log_base(spark, Warehouse(topics, str(tmp_path / "stats"), str(tmp_path / "dims"), trigger={"availableNow": True}))
    query.awaitTermination(120)
    assert query.exception() is None
    assert not [s for p in query.recentProgress for s in p.stateOperators if "transformWithState" in s.operatorName]
    sent = topics.read(spark, "dwd_page_log", streaming=False)
    flags = sent.select(F.get_json_object("value", "$.ts").alias("ts"), F.get_json_object("value", "$.common.is_new").alias("f"))
    assert rows(flags) == [("1", "1"), ("2", "0"), ("3", "0")]
