"""All streaming jobs, chained through topics as in production."""

import json

import pytest
from conftest import rows

from streammart.plans.order_wide import Dims
from streammart.sources.dim_table import DimTable, dim_schema
from streammart.sources.topics import Topics
from streammart.streaming.jobs import JOBS, Warehouse, rules_from_feed

BASE = 1704103200000  # 2024-01-01 10:00:00


def page(mid, second, new="1", **fields):
    displays = fields.pop("displays", None)
    record = {
        "common": {"mid": mid, "vc": "v", "ch": "c", "ar": "a", "is_new": new},
        "page": {"page_id": "home", "during_time": 1000, **fields},
        "ts": BASE + int(second * 1000),
    }
    if displays:
        record["displays"] = displays
    return json.dumps(record)


LOG = [
    page("m", 0, displays=[{"item": "7", "item_type": "sku_id"}]),
    page("m", 1, page_id="good_detail", last_page_id="home", item="7", item_type="sku_id"),
    page("n", 1, item="red plate", item_type="keyword"),
    page("m", 30, "0"),
    json.dumps({"common": {"mid": "m", "is_new": "1"}, "start": {"entry": "icon"}, "ts": BASE + 500}),
    "not json",
    page("end", 80000, "0", last_page_id="x", item="end", item_type="keyword"),
]

RULE_ROWS = [
    ("order_info", "insert", "kafka", "dwd_order_info", None),
    ("order_detail", "insert", "kafka", "dwd_order_detail", None),
    ("payment_info", "insert", "kafka", "dwd_payment_info", None),
    ("sku_info", "insert", "hbase", "dim_sku_info",
     "id,sku_name,price,spu_id,tm_id,category3_id"),
    ("sku_info", "update", "hbase", "dim_sku_info",
     "id,sku_name,price,spu_id,tm_id,category3_id"),
]
COLUMNS = {
    "order_info": "id,province_id,order_status,user_id,total_amount,create_time",
    "order_detail": "id,order_id,sku_id,order_price,sku_num,sku_name,create_time,split_total_amount",
    "payment_info": "id,order_id,user_id,total_amount,subject,payment_type,create_time",
}


def change(table, kind="insert", **data):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": 1, "data": data})


def at(second):
    return f"2024-01-01 10:00:{second:02d}"


CHANGES = [
    change("sku_info", "bootstrap-insert", id=7, sku_name="old", price=9.5, spu_id=70, tm_id=71,
           category3_id=72, secret="x"),
    change("sku_info", "update", id=7, sku_name="plate", price=9.9, spu_id=70, tm_id=71,
           category3_id=72, secret="x"),
    change("order_info", id=1, province_id=11, order_status="1001", user_id=3, total_amount=30.5,
           create_time=at(0), junk=1),
    change("order_detail", id=10, order_id=1, sku_id=7, order_price=10, sku_num=1, sku_name="raw",
           create_time=at(2), split_total_amount=10.25),
    change("order_detail", id=11, order_id=1, sku_id=8, order_price=20, sku_num=2, sku_name="raw",
           create_time=at(4), split_total_amount=20.25),
    change("payment_info", id=5, order_id=1, user_id=3, total_amount=30.5, subject="s",
           payment_type="1101", create_time=at(9)),
    change("comment_info", id=1),
    change("order_info", id=2, province_id=11, user_id=3, total_amount=1,
           create_time="2024-01-02 10:00:00"),
    change("order_detail", id=12, order_id=2, sku_id=7, sku_num=1, split_total_amount=1,
           create_time="2024-01-02 10:00:00"),
    change("payment_info", id=6, order_id=2, total_amount=1, create_time="2024-01-02 10:00:00"),
]


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    topics = Topics(root=str(root / "topics"), checkpoints=str(root / "checkpoints"))
    sku = DimTable(str(root / "dims/dim_sku_info"), dim_schema(RULE_ROWS[3][4]))

    def table(spark, schema, *data):
        return spark.createDataFrame(list(data), schema)

    def dims(spark):
        return Dims(
            user=table(spark, "id STRING, birthday STRING, gender STRING", ("3", "1990-06-01", "F")),
            province=table(
                spark, "id STRING, name STRING, area_code STRING, iso_code STRING, iso_3166_2 STRING",
                ("11", "North", "010", "CN-11", "CN-BJ")),
            sku=sku.read(spark),
            spu=table(spark, "id STRING, spu_name STRING", ("70", "plates")),
            trademark=table(spark, "id STRING, tm_name STRING", ("71", "acme")),
            category3=table(spark, "id STRING, name STRING", ("72", "kitchen")),
        )

    feed = [
        json.dumps({"op": "r", "after": {
            "source_table": t, "operate_type": op, "sink_type": kind, "sink_table": sink,
            "sink_columns": columns or COLUMNS[t]}})
        for t, op, kind, sink, columns in RULE_ROWS
    ]
    wh = Warehouse(
        topics=topics,
        stats_root=str(root / "stats"),
        dim_root=str(root / "dims"),
        rules=rules_from_feed(topics, "s.conf.table_process"),
        dims=dims,
        trigger={"availableNow": True},
    )
    seeds = {
        "s.conf.table_process": feed,
        "ods_base_log": LOG,
        "ods_base_db_m": CHANGES,
        "dwd_favor_info": [json.dumps({"sku_id": 7, "create_time": at(0)})],
        "dwd_cart_info": [json.dumps({"sku_id": 7, "create_time": at(0)})],
        "dwd_order_refund_info": [
            json.dumps({"sku_id": 7, "order_id": 1, "refund_amount": 1.5, "create_time": at(0)})],
        "dwd_comment_info": [json.dumps({"sku_id": 7, "appraise": "1203", "create_time": at(0)})],
    }
    data = [(topic, value) for topic, values in seeds.items() for value in values]
    topics.put(spark.createDataFrame(data, "topic STRING, value STRING").coalesce(1), "seed")
    for job in JOBS.values():
        query = job(spark, wh)
        query.awaitTermination(180)
        assert query.exception() is None and not query.isActive
    return spark, wh, sku


def values(done, topic):
    spark, wh, _ = done
    return [json.loads(r["value"]) for r in wh.topics.read(spark, topic, False).collect()]


def stats(done, name, *columns):
    spark, wh, _ = done
    return rows(spark.read.parquet(f"{wh.stats_root}/{name}"), *columns)


def test_log_is_split_and_repaired(done):
    flags = sorted((v["common"]["mid"], v["ts"] - BASE, v["common"]["is_new"])
                   for v in values(done, "dwd_page_log"))
    assert flags == [("end", 80000000, "0"), ("m", 0, "1"), ("m", 1000, "0"), ("m", 30000, "0"),
                     ("n", 1000, "1")]
    (start,) = values(done, "dwd_start_log")
    assert start["start"] == {"entry": "icon"} and start["common"]["is_new"] == "0"
    assert values(done, "dwd_display_log") == [
        {"item": "7", "item_type": "sku_id", "page_id": "home"}]
    spark, wh, _ = done
    assert rows(wh.topics.read(spark, "ods_base_log_dirty", False), "value") == [("not json",)]


def test_visits(done):
    assert sorted(v["common"]["mid"] for v in values(done, "dwm_unique_visit")) == ["m", "n"]
    bounced = sorted((v["common"]["mid"], v["ts"] - BASE)
                     for v in values(done, "dwm_user_jump_detail"))
    assert bounced == [("m", 30000), ("n", 1000)]


def test_changes_are_routed(done):
    orders = values(done, "dwd_order_info")
    assert sorted(o["id"] for o in orders) == [1, 2] and "junk" not in orders[0]
    spark, _, sku = done
    assert rows(sku.read(spark), "id", "sku_name", "price") == [("7", "plate", "9.9")]
    (other,) = values(done, "ods_base_db_unrouted")
    assert other["table"] == "comment_info"


def test_wide_rows(done):
    wide = {v["detail_id"]: v for v in values(done, "dwm_order_wide")}
    assert set(wide) == {10, 11, 12}
    assert wide[10]["sku_name"] == "plate" and wide[10]["category3_name"] == "kitchen"
    assert wide[11]["sku_name"] == "raw" and "spu_id" not in wide[11]
    paid = {v["detail_id"]: v for v in values(done, "dwm_payment_wide")}
    assert set(paid) == {10, 11, 12} and paid[10]["payment_id"] == 5


def test_statistics(done):
    assert stats(done, "visitor_stats", "stt", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct",
                 "dur_sum") == [
        (at(0), "0", 0, 1, 0, 0, 1000), (at(0), "1", 2, 2, 2, 1, 2000), (at(30), "0", 0, 1, 1, 1, 1000)
    ]
    assert stats(done, "keyword_stats", "keyword", "ct", "source") == [
        ("plate", 1, "SEARCH"), ("red", 1, "SEARCH")]
    assert [(str(a), n) for a, n in stats(done, "province_stats", "order_amount", "order_count")] == [
        ("30.50", 2)]
    product = stats(done, "product_stats", "stt", "sku_id", "sku_name", "display_ct", "click_ct",
                    "favor_ct", "order_ct", "order_amount", "paid_order_ct", "refund_order_ct",
                    "good_comment_ct")
    found = [(*r[:7], str(r[7]), *r[8:]) for r in product]
    assert found == [
        (at(0), 7, "plate", 1, 1, 1, 1, "30.50", 0, 1, 1),
        (at(0), 8, None, 0, 0, 0, 1, "30.50", 0, 0, 0),
        (at(8), 7, "plate", 0, 0, 0, 0, "0.00", 1, 0, 0),
        (at(8), 8, None, 0, 0, 0, 0, "0.00", 1, 0, 0),
    ]
