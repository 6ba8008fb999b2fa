import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.functions.times import (
    age_years, day_number, from_millis, interval, parse_time, seconds, whole_seconds,
    with_create_parts,
)
from streammart.operators.windows import split_null_keys, stamped, tumbling_agg
from streammart.plans import order_wide as ow
from streammart.plans.keyword_stats import keyword_stats, searches
from streammart.plans.product_stats import product_measures, sources, with_product_dims
from streammart.plans.province_stats import province_stats
from streammart.plans.visitor_stats import visitor_stats, visitor_totals
from streammart.schemas import ORDER_DETAIL, ORDER_INFO, PAYMENT_INFO

T0 = dt.datetime(2024, 1, 1, 10)


def test_windows_are_aligned_to_the_epoch(spark):
    df = spark.createDataFrame([(0,), (1999,), (2000,)], "ms BIGINT")
    df = df.select(from_millis("ms").alias("event_time"))
    out = tumbling_agg(df, [], {"n": F.count(F.lit(1))})
    assert rows(out) == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:02", 2),
        ("1970-01-01 00:00:02", "1970-01-01 00:00:04", 1),
    ]


def test_times(spark):
    df = spark.createDataFrame([("1990-06-01", "2024-01-31 23:59:58", 1999)], "b STRING, t STRING, ms BIGINT")
    as_of = F.lit("2024-06-01").cast("timestamp")
    out = df.select(
        age_years("b", as_of),
        day_number(parse_time("t")),
        F.unix_millis(whole_seconds("ms")),
        F.unix_millis(from_millis("ms")),
        F.unix_seconds(parse_time("t") + interval("-3 seconds")),
    )
    assert rows(out) == [(34, 20240131, 1000, 1999, 1706745595)]
    parts = with_create_parts(df.withColumnRenamed("t", "create_time"))
    assert rows(parts, "create_date", "create_hour", "create_hh") == [
        ("2024-01-31", "23:59:58", "23")
    ]
    assert seconds("6 hours") == 21600 and seconds("1 day") == 86400
    with pytest.raises(ValueError):
        seconds("2 fortnights")


def test_null_keys_and_stamp(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k INT, v STRING")
    good, bad = split_null_keys(df, ["k"])
    assert rows(good, "v") == [("a",)] and rows(bad, "v") == [("b",)]
    assert stamped(df).filter(F.col("ts") > 1_700_000_000_000).count() == 2


def feed(spark, schema, *data):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), *rest) for s, *rest in data],
        f"event_time TIMESTAMP, {schema}",
    )


@pytest.fixture()
def feeds(spark):
    order = "sku_id BIGINT, order_id BIGINT, sku_num BIGINT, total_amount DECIMAL(16,2), split_total_amount DECIMAL(16,2)"
    wide = feed(spark, order,
                (0, 7, 5, 1, Decimal(30), Decimal(10)), (1, 7, 5, 2, Decimal(30), Decimal(20)),
                (1, 7, 6, 1, Decimal(1), Decimal(1)), (2, 7, 9, 1, Decimal(2), Decimal(2)))
    return sources(
        pages=feed(spark, "page_id STRING, item STRING",
                   (0, "good_detail", "7"), (0, "home", "7"), (0, "good_detail", "x")),
        displays=feed(spark, "item STRING, item_type STRING", (1, "7", "sku_id"), (1, "7", "other")),
        favors=feed(spark, "sku_id BIGINT", (0, 7), (0, None)),
        carts=feed(spark, "sku_id BIGINT", (0, 8)),
        order_wide=wide,
        payment_wide=wide.filter("order_id = 5"),
        refunds=feed(spark, "sku_id BIGINT, order_id BIGINT, refund_amount DECIMAL(16,2)",
                     (0, 7, 5, Decimal("2.50"))),
        comments=feed(spark, "sku_id BIGINT, appraise STRING", (0, 7, "1203"), (0, 7, "1201")),
    )


def test_product_measures(spark, feeds):
    out = {(r["stt"][-2:], r["sku_id"]): r for r in product_measures(feeds).collect()}
    assert set(out) == {("00", 7), ("00", 8), ("02", 7)}
    row = out["00", 7]
    assert (row["click_ct"], row["display_ct"], row["favor_ct"], row["cart_ct"]) == (1, 1, 1, 0)
    assert (row["order_ct"], row["order_sku_num"], row["order_amount"]) == (2, 4, Decimal("61.00"))
    assert (row["paid_order_ct"], row["payment_amount"]) == (1, Decimal("30.00"))
    assert (row["refund_order_ct"], row["refund_amount"]) == (1, Decimal("2.50"))
    assert (row["comment_ct"], row["good_comment_ct"]) == (2, 1)
    assert out["02", 7]["order_ct"] == 1
    quirk = {(r["stt"][-2:], r["sku_id"]): r
             for r in product_measures(feeds, single_row_zero=True).collect()}
    assert quirk["02", 7]["order_ct"] == 0 and quirk["00", 7]["order_ct"] == 2


def dims(spark):
    def table(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return ow.Dims(
        user=table("id STRING, birthday STRING, gender STRING", ("3", "1990-06-01", "F")),
        province=table("id STRING, name STRING, area_code STRING, iso_code STRING, iso_3166_2 STRING",
                       ("11", "North", "010", "CN-11", "CN-BJ")),
        sku=table("id STRING, sku_name STRING, price STRING, spu_id STRING, tm_id STRING, category3_id STRING",
                  ("7", "plate", "9.90", "70", "71", "72")),
        spu=table("id STRING, spu_name STRING", ("70", "plates")),
        trademark=table("id STRING, tm_name STRING", ("71", "acme")),
        category3=table("id STRING, name STRING", ("72", "kitchen")),
    )


def test_product_dims(spark, feeds):
    named = with_product_dims(product_measures(feeds), dims(spark))
    assert rows(named.filter("sku_id = 7").limit(1), "sku_name", "sku_price", "spu_name", "tm_name",
                "category3_name") == [("plate", Decimal("9.90"), "plates", "acme", "kitchen")]
    assert rows(named.filter("sku_id = 8"), "sku_name", "tm_id") == [(None, None)]


def orders(spark):
    created = "2024-01-01 10:00:00"
    none = None
    order = spark.createDataFrame(
        [(1, 11, "1001", 3, Decimal(30), none, none, none, none, none, created, none)], ORDER_INFO
    )
    lines = spark.createDataFrame(
        [(i, 1, sku, Decimal(5), 2, "own name", t, Decimal(10), none, none)
         for i, (sku, t) in enumerate([(7, "2024-01-01 10:00:05"), (99, "2024-01-01 09:59:55"),
                                       (7, "2024-01-01 10:00:06")])],
        ORDER_DETAIL,
    )
    paid = spark.createDataFrame(
        [(50, 1, 4, Decimal(29), "goods", "1101", t, none)
         for t in ("2024-01-01 10:15:00", "2024-01-01 10:15:01", "2024-01-01 09:59:59")],
        PAYMENT_INFO,
    )
    timed = lines.withColumn("event_time", parse_time("create_time"))
    return with_create_parts(order), timed, paid.withColumn("event_time", parse_time("create_time"))


def test_order_and_payment_wide(spark):
    order, lines, paid = orders(spark)
    wide = ow.join_order_lines(order, lines)
    full = ow.with_dimensions(wide, dims(spark), F.lit("2024-06-01").cast("timestamp"))
    out = {r["detail_id"]: r for r in full.collect()}
    assert set(out) == {0, 1}
    row = out[0]
    assert (row["sku_name"], row["spu_name"], row["tm_name"], row["category3_name"]) == (
        "plate", "plates", "acme", "kitchen")
    assert (row["user_age"], row["user_gender"], row["province_3166_2_code"]) == (34, "F", "CN-BJ")
    assert (row["create_date"], row["create_hour"]) == ("2024-01-01", "10:00:00")
    assert row["expire_time"] is None and row["split_feight_fee"] is None
    assert (out[1]["sku_name"], out[1]["spu_id"]) == ("own name", None)
    payments = ow.join_payments(paid, full)
    assert rows(payments, "detail_id", "payment_create_time") == [
        (0, "2024-01-01 10:15:00"), (1, "2024-01-01 10:15:00")
    ]
    one = payments.filter("detail_id = 0").first()
    assert (one["user_id"], one["total_amount"]) == (4, Decimal("29.00"))
    assert (one["order_create_time"], one["split_total_amount"]) == (
        "2024-01-01 10:00:00", Decimal("10.00"))


def test_province_counts_lines_or_orders(spark):
    order, lines, _ = orders(spark)
    wide = ow.with_province(ow.join_order_lines(order, lines), dims(spark).province)
    assert rows(province_stats(wide), "province_name", "order_amount", "order_count") == [
        ("North", Decimal("20.00"), 2)
    ]
    assert rows(province_stats(wide, distinct_orders=True), "order_count") == [(1,)]


def test_merge_wide(spark):
    left = spark.createDataFrame([(1, None, "a"), (2, "x", None)], "detail_id INT, p STRING, q STRING")
    right = spark.createDataFrame([(1, "r", "b")], "detail_id INT, p STRING, q STRING")
    assert rows(ow.merge_wide(left, right)) == [(1, "r", "a"), (2, "x", None)]


def test_visitors(spark):
    schema = "vc STRING, ch STRING, ar STRING, is_new STRING, last_page_id STRING, during_time BIGINT"
    pages = feed(spark, schema, (0, "v", "c", "a", "1", None, 100), (1, "v", "c", "a", "1", "p", 50),
                 (5, "v", "c", "a", "0", "", None))
    uniques, bounces = pages.filter("is_new = '1' AND last_page_id IS NULL"), pages.limit(0)
    out = visitor_stats(pages, uniques, bounces)
    assert rows(out.select("is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")) == [
        ("0", 0, 1, 1, 0, 0), ("1", 1, 2, 1, 0, 150)
    ]
    totals = visitor_totals(pages, uniques, pages)
    assert rows(totals.select("is_new", "pv_ct", "uj_ct")) == [("0", 1, 1), ("1", 2, 2)]


def test_keywords(spark):
    pages = spark.createDataFrame(
        [("keyword", "Red plate red", 1704103200999), ("keyword", None, 1704103200000),
         ("sku_id", "red", 1704103200000), ("keyword", "!!", 1704103200000)],
        "item_type STRING, item STRING, ts BIGINT",
    )
    assert rows(keyword_stats(searches(pages)), "keyword", "ct", "source", "stt") == [
        ("plate", 1, "SEARCH", "2024-01-01 10:00:00"), ("red", 2, "SEARCH", "2024-01-01 10:00:00")
    ]
