from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.schemas import FAVOR_INFO
from streammart.session import shared_dir
from streammart.sources.tables import ingest_lines, jdbc_options, jdbc_sink, stats_sink
from streammart.sources.topics import Topics


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def records(spark, *pairs):
    return spark.createDataFrame(list(pairs), "topic STRING, value STRING")


def test_topics_on_folders(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"), checkpoints=str(tmp_path / "c"))
    topics.put(records(spark, ("a", "1"), ("a", "2"), ("b", "3")), "job", 0)
    topics.put(records(spark, ("a", "1"), ("a", "2"), ("b", "3")), "job", 0)
    topics.put(records(spark, ("a", "4")), "job", 1)
    read = topics.read(spark, "a", streaming=False)
    assert rows(read, "value") == [("1",), ("2",), ("4",)]
    assert read.select("src_partition", "src_offset").distinct().count() == 3


def test_records_go_to_the_topic_they_name(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"), checkpoints=str(tmp_path / "c"))
    topics.put(records(spark, ("in", "x:1"), ("in", "y:2")), "seed")
    stream = topics.read(spark, "in").select(
        F.substring("value", 1, 1).alias("topic"), F.substring("value", 3, 1).alias("value")
    )
    finish(topics.write_routed(stream, "router"))
    finish(topics.write_routed(stream, "router"))
    assert rows(topics.read(spark, "x", False), "value") == [("1",)]
    assert rows(topics.read(spark, "y", False), "value") == [("2",)]


def test_a_batch_that_was_cut_short_is_finished(spark, tmp_path, monkeypatch):
    topics = Topics(root=str(tmp_path / "t"))
    batch = records(spark, *[(f"topic{k % 3}", str(k)) for k in range(9)])
    moved = []

    def dying(spark, written, place):
        if len(moved) == 1:
            raise OSError("lost")
        moved.append(place)
        real(spark, written, place)

    real = Topics._deliver
    with monkeypatch.context() as patch:
        patch.setattr(Topics, "_deliver", staticmethod(dying))
        with pytest.raises(OSError):
            topics.put(batch, "job", 4)
    before = [topics.read(spark, f"topic{k}", False).count() for k in range(3)]
    assert sorted(before) == [0, 0, 3]
    topics.put(batch, "job", 4)
    topics.put(batch, "job", 4)
    assert [topics.read(spark, f"topic{k}", False).count() for k in range(3)] == [3, 3, 3]
    topics.put(records(spark, ("topic1", "x")), "job.other-checkpoint", 4)
    assert topics.read(spark, "topic1", False).count() == 4


def test_a_small_batch_is_one_file_per_topic(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"))
    many = spark.range(2000).repartition(8).select(F.concat(F.lit("t"), F.col("id") % 5).alias("topic"), F.col("id").cast("string").alias("value"))
    topics.put(many, "job", 0)
    assert len(list((tmp_path / "t").glob("topic=*/**/*.parquet"))) == 5
    assert topics.read(spark, "t3", False).count() == 400


def test_sql_view_over_a_topic(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"))
    topics.put(records(spark, ("f", '{"sku_id":7,"create_time":"2024-01-01 10:00:01"}')), "seed")
    topics.view(spark, "f", "favors", FAVOR_INFO, streaming=False,
                computed={"rowtime": "to_timestamp(create_time)"},
                watermark=("rowtime", "2 seconds"))
    out = spark.sql("SELECT sku_id, date_format(window(rowtime, '2 seconds').start, 'ss') AS s FROM favors")
    assert rows(out) == [(7, "00")]


def test_a_job_needs_a_named_checkpoint_root(spark, tmp_path):
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default))
    with pytest.raises(ValueError, match="checkpoint root"):
        Topics(root=str(tmp_path)).checkpoint(unset, "job")
    assert Topics(root=str(tmp_path), checkpoints="/c").checkpoint(spark, "job") == "/c/job"


def test_a_topic_can_be_read_before_it_is_written(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"), checkpoints=str(tmp_path / "c"))
    assert topics.read(spark, "later", streaming=False).count() == 0
    finish(topics.write(topics.read(spark, "later").select("value"), "copy", "copier"))
    topics.put(records(spark, ("later", "1")), "job", 1)
    finish(topics.write(topics.read(spark, "later").select("value"), "copy", "copier"))
    assert rows(topics.read(spark, "copy", False), "value") == [("1",)]


def test_kafka_options():
    topics = Topics(bootstrap="host:1", options={"kafka.security.protocol": "SSL"})
    opts = topics.read_options("a", True)
    assert opts["subscribe"] == "a" and opts["startingOffsets"] == "latest"
    assert "startingOffsets" not in topics.read_options("a", False)
    with pytest.raises(ValueError):
        Topics()
    with pytest.raises(ValueError):
        Topics(root="x", bootstrap="y")


def test_jdbc_sink_binds_by_name():
    sent = {}

    class Writer:
        def __getattr__(self, name):
            return lambda *a, **k: sent.update({name: a or k}) or self

    class Batch:
        write = Writer()

        def select(self, *columns):
            sent["columns"] = columns
            return self

    jdbc_sink("jdbc:x", "t", ["a", "b"], user="u")(Batch(), 0)
    assert sent["columns"] == ("a", "b") and sent["mode"] == ("append",)
    assert sent["options"] == jdbc_options("jdbc:x", "t", user="u")


def test_raw_log_ingest(spark, tmp_path):
    landing, raw, cp = (str(tmp_path / n) for n in ("landing", "raw", "cp"))
    spark.createDataFrame([('{"a":1}',), ("second",)], "value STRING").write.text(landing)
    finish(ingest_lines(spark, landing, raw, cp))
    finish(ingest_lines(spark, landing, raw, cp))
    read = spark.read.parquet(raw)
    assert rows(read, "value") == [("second",), ('{"a":1}',)]
    assert "ingest_day" in read.columns


def test_repeated_statistics_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "s")
    sink = stats_sink(path, ["stt", "n"])
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 2)], "stt STRING, n INT")
    for batch in (0, 0, 1):
        sink(df, batch)
    assert spark.read.parquet(path).count() == 4


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or shared_dir(spark)).rstrip("/")
