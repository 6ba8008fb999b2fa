import json

import pytest
from conftest import rows

from streammart.functions.jsons import as_value, camel_case, split_dirty
from streammart.operators import logs
from streammart.operators.visits import daily_unique_visits, repair_is_new
from streammart.plans.product_stats import page_rows

COMMON = {"mid": "m1", "vc": "v1", "ch": "app", "ar": "11", "is_new": "1"}
LINES = [
    json.dumps({
        "common": COMMON, "page": {"page_id": "home", "during_time": 4000},
        "displays": [{"item": "7", "item_type": "sku_id", "pos": 2},
                     {"item": "3", "item_type": "activity_id"}],
        "ts": 1704038401000, "extra": {"a": [1, 2.50]},
    }),
    json.dumps({"common": COMMON, "start": {"entry": "icon"}, "ts": 1704038402000}),
    json.dumps({
        "common": COMMON,
        "page": {"page_id": "good_detail", "last_page_id": "home", "item": "7",
                 "item_type": "sku_id", "during_time": "9000"},
        "ts": 1704038405000,
    }),
    json.dumps({
        "common": {**COMMON, "mid": "m2", "ch": "web", "is_new": "0"},
        "page": {"page_id": "good_list", "last_page_id": "", "item": "red plate",
                 "item_type": "keyword", "during_time": 1000},
        "ts": 1704038406000,
    }),
    "not json",
    "17",
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(list(enumerate(LINES)), "n INT, value STRING").select("value", "n")


@pytest.fixture()
def log(raw):
    return split_dirty(logs.parse_app_log(raw))[0]


def test_dirty_rows_are_kept_aside(raw):
    good, dirty = split_dirty(logs.parse_app_log(raw))
    assert rows(dirty, "n") == [(4,), (5,)]
    assert good.count() == 4
    assert rows(good.filter("n = 2"), "during_time") == [(9000,)]


def test_bad_row_can_stop_the_job(raw):
    with pytest.raises(Exception, match="not a JSON record"):
        logs.parse_app_log(raw, on_error="fail").collect()


def test_each_record_is_parsed_once(raw):
    good = logs.page_log(split_dirty(logs.parse_app_log(raw))[0])
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_split(log):
    assert rows(logs.start_log(log), "n", "start") == [(1, '{"entry":"icon"}')]
    assert rows(logs.page_log(log), "n") == [(0,), (2,), (3,)]
    shown = logs.display_log(log, carry=("n",))
    assert rows(shown, "n", "page_id", "item", "item_type") == [
        (0, "home", "3", "activity_id"), (0, "home", "7", "sku_id")
    ]
    values = [json.loads(r["value"]) for r in shown.orderBy("display_no").collect()]
    assert values[0] == {"item": "7", "item_type": "sku_id", "pos": 2, "page_id": "home"}


def test_empty_start_object_is_a_start_record(spark):
    df = spark.createDataFrame([('{"common":{"mid":"a"},"start":{},"ts":1}',)], "value STRING")
    log = split_dirty(logs.parse_app_log(df))[0]
    assert logs.start_log(log).count() == 1 and logs.page_log(log).count() == 0


def test_repair_and_topic_records(log):
    fixed = repair_is_new(log, ["ts", "n"])
    assert rows(fixed, "n", "is_new") == [(0, "1"), (1, "0"), (2, "0"), (3, "0")]
    records = rows(logs.split_records(fixed))
    assert [topic for topic, _ in records] == [
        "dwd_display_log", "dwd_display_log", "dwd_page_log", "dwd_page_log", "dwd_page_log",
        "dwd_start_log",
    ]
    pages = [json.loads(v) for t, v in records if t == "dwd_page_log"]
    whole = next(p for p in pages if "extra" in p)
    assert whole == json.loads(LINES[0])
    detail = next(p for p in pages if p["page"]["page_id"] == "good_detail")
    assert detail["common"]["is_new"] == "0"


def test_unique_visits_and_product_rows(log):
    pages = logs.page_log(log)
    assert rows(daily_unique_visits(pages, ["n"]), "n") == [(0,), (3,)]
    clicks, shown = page_rows(pages, logs.display_log(pages, carry=("event_time",)))
    assert rows(clicks[0], "sku_id") == [(7,)]
    assert rows(shown[0], "sku_id") == [(7,)]


def test_encoding_and_names(spark):
    df = spark.createDataFrame([(1, "a")], "order_id INT, sink_table STRING")
    assert rows(as_value(df, "order_id")) == [(1, '{"sink_table":"a"}')]
    assert camel_case(df).columns == ["orderId", "sinkTable"]
