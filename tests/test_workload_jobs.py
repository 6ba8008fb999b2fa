"""What the registered job queries rest on: pruned days, dirty records, totals across restarts."""

import datetime as dt
import json
from zoneinfo import ZoneInfo

from conftest import rows
from pyspark.sql import functions as F

from streammart.functions.times import today_number
from streammart.plans import reports
from streammart.schemas import STATS
from streammart.sources.dim_table import DimTable, dim_schema, keyed_sink
from streammart.sources.tables import read_stats, write_stats
from streammart.sources.topics import Topics
from streammart.streaming.jobs import Warehouse, unique_visit, user_jump


def test_a_report_reads_one_day(spark, tmp_path):
    data = [(f"2024-01-0{d} 00:00:00", d, 1.5 * d) for d in range(1, 8)]
    stats = spark.createDataFrame(data, "stt STRING, province_id BIGINT, order_amount DOUBLE")
    whole = [F.col(f.name).cast(f.dataType) if f.name in stats.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STATS["province_stats"]]
    path = str(tmp_path / "province_stats")
    write_stats(stats.select(*whole), path)
    day = read_stats(spark, "province_stats", path, 20240103)
    assert len(day.inputFiles()) == 1 and "dt=2024-01-03" in day.inputFiles()[0]
    assert rows(reports.by_province(day, 20240103), "order_amount")[0][0] == 4.5
    assert rows(reports.by_province(read_stats(spark, "province_stats", path), 20240103)) == rows(reports.by_province(day, 20240103))
    assert reports.by_province(read_stats(spark, "province_stats", path, 20250101), 20250101).count() == 0


def test_today_is_that_of_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("Pacific/Kiritimati", "Etc/GMT+12"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert today_number() == int(dt.datetime.now(ZoneInfo(name)).strftime("%Y%m%d"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_jobs_set_unusable_records_aside(spark, tmp_path):
    base = 1704103200000
    page = lambda mid, second, **more: json.dumps({"common": {"mid": mid, "is_new": "0"}, "page": {"page_id": "p", **more}, "ts": base + 1000 * second})
    good = [page("a", 0), page("a", 1, last_page_id="p"), page("b", 2), page("end", 80000, last_page_id="p")]
    bad = ["not json", json.dumps({"page": {"page_id": "p"}, "ts": base}), json.dumps({"common": {"mid": "c"}, "page": {"page_id": "p"}}), "[1]"]
    topics = Topics(root=str(tmp_path / "t"), checkpoints=str(tmp_path / "c"))
    wh = Warehouse(topics, str(tmp_path / "s"), str(tmp_path / "d"), trigger={"availableNow": True})
    topics.put(spark.createDataFrame([("dwd_page_log", v) for v in good + bad], "topic STRING, value STRING").coalesce(1), "seed")
    for job, topic, found in ((unique_visit, "dwm_unique_visit", ["a", "b"]), (user_jump, "dwm_user_jump_detail", ["b"])):
        query = job(spark, wh)
        query.awaitTermination(120)
        assert query.exception() is None
        out = [json.loads(r["value"])["common"]["mid"] for r in topics.read(spark, topic, False).collect()]
        assert sorted(out) == found
        assert rows(topics.read(spark, f"{topic}_dirty", False), "value") == sorted((v,) for v in bad)
    assert all("src=unique_visit." in f or "src=user_jump." in f for t in ("dwm_unique_visit", "dwm_user_jump_detail") for f in topics.read(spark, t, False).inputFiles())
    assert not any("src=unique_visit./" in f for f in topics.read(spark, "dwm_unique_visit", False).inputFiles()), "the checkpoint is named"


def test_totals_in_a_keyed_table(spark, tmp_path):
    totals = DimTable(str(tmp_path / "t"), dim_schema("key,a,b,n", "key"))
    batch = lambda *data: spark.createDataFrame(list(data), "a STRING, b STRING, n BIGINT")
    write = keyed_sink(totals, ["a", "b"], "job/one")
    write(batch(("x", None, 1), ("x", "y", 2)), 0)
    write(batch(("x", None, 5)), 1)
    write(batch(("x", None, 99)), 1)
    assert rows(totals.read(spark), "a", "b", "n") == [("x", "y", "2"), ("x", None, "5")]
